"""Letters and distances that several operators share."""

from __future__ import annotations

import re
import unicodedata

# fixed values: the consonant of each row of eight in the Ethiopic block, from U+1200, as this data romanises it
ETHIOPIC_ROWS = (
    "h", "l", "h", "m", "s", "r", "s", "sh", "q", "q", "q", "q", "b", "v", "t", "ch", "h", "h", "n", "ny", "", "k", "k", "k", "k",
    "w", "", "z", "zh", "y", "d", "d", "j", "g", "g", "g", "t", "ch", "p", "ts", "ts", "f", "p",
)
ETHIOPIC_VOWELS = ("e", "u", "i", "a", "e", "", "o", "wa")


def _romanise() -> dict[int, str]:
    out = {0x1200 + 8 * i + j: c + v for i, c in enumerate(ETHIOPIC_ROWS) for j, v in enumerate(ETHIOPIC_VOWELS)}
    out |= {0x1361: " ", **{c: " " for c in range(0x1362, 0x1369)}}
    return out


_ROMAN = _romanise()
# fixed values: words of places and kinds in the other script
LOCAL_WORDS = {
    "ሰሜን": "north", "ደቡብ": "south", "ምሥራቅ": "east", "ምስራቅ": "east", "ምዕራብ": "west", "ዞን": "zone", "ክልል": "region", "ከተማ": "town", "ወረዳ": "woreda",
    "ጤና ጣቢያ": "health center", "ጤና ኬላ": "health post", "መድኃኒት መደብር": "drug store", "መድኃኒት ቤት": "pharmacy", "ፋርማሲ": "pharmacy",
    "የመጀመሪያ ደረጃ ሆስፒታል": "primary hospital", "አጠቃላይ ሆስፒታል": "general hospital", "ሪፈራል ሆስፒታል": "referral hospital", "ሆስፒታል": "hospital",
    "መካከለኛ ክሊኒክ": "medium clinic", "የመጀመሪያ ደረጃ ክሊኒክ": "primary clinic", "የጥርስ ክሊኒክ": "dental clinic", "ክሊኒክ": "clinic",
}
_LOCAL = re.compile("|".join(map(re.escape, sorted(LOCAL_WORDS, key=len, reverse=True))))
_ETHIOPIC = re.compile("[ሀ-፿]")


def latin(s: str) -> str:
    """Lower-case Latin letters, digits and signs; Ethiopic words of kinds and directions translated, the rest romanised."""
    if "@" in s:
        s = s.replace("@", "a")
    if s.isascii():
        return s.lower()
    if _ETHIOPIC.search(s):
        s = _LOCAL.sub(lambda m: f" {LOCAL_WORDS[m[0]]} ", s).translate(_ROMAN)
    s = unicodedata.normalize("NFKD", s)
    return "".join(c for c in s if not unicodedata.combining(c)).lower()


VOWELS = frozenset("aeiou")
# fixed values: the rows of a typewriter keyboard
_KEYS = {c: (i, j) for i, row in enumerate(("qwertyuiop", "asdfghjkl", "zxcvbnm")) for j, c in enumerate(row)}


def beside(a: str, b: str) -> bool:
    p, q = _KEYS.get(a), _KEYS.get(b)
    return p is not None and q is not None and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _gaps(s: str) -> list[float]:
    """What it costs to leave out each letter."""
    n = len(s)
    return [0.6 if (i and s[i - 1] == c) or (i + 1 < n and s[i + 1] == c) else 0.7 if c in "hyw" else 0.85 if c in VOWELS else 1.0 for i, c in enumerate(s)]


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SWAPS = {x: {y: 0.0 if x == y else 0.8 if (x in VOWELS and y in VOWELS) or beside(x, y) else 1.0 for y in _LETTERS} for x in _LETTERS}


def damerau(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein: an edit costs 1, one that ear or hand often makes (a doubled letter, a silent h, y or
    w, one vowel for another, a neighbouring key, two letters turned round) a little less; above `most`, infinite."""
    if a == b:
        return 0.0
    n, m = len(a), len(b)
    if abs(n - m) > most * 1.6:
        return float("inf")
    ga, gb = _gaps(a), _gaps(b)
    before, last = [], [0.0]
    for g in gb:
        last.append(last[-1] + g)
    for i, x in enumerate(a):
        g, swaps = ga[i], _SWAPS.get(x, {})
        c = last[0] + g
        row = [c]
        for j, y in enumerate(b):
            c += gb[j]
            d = last[j] + swaps.get(y, 0.0 if x == y else 1.0)
            if d < c:
                c = d
            d = last[j + 1] + g
            if d < c:
                c = d
            if i and j and x == b[j - 1] and a[i - 1] == y:
                d = before[j - 1] + 0.8
                if d < c:
                    c = d
            row.append(c)
        before, last = last, row
        if min(row) > most and min(before) > most:
            return float("inf")
    return last[-1] if last[-1] <= most else float("inf")


def plain_edits(a: str, b: str, most: int) -> int:
    """Unweighted (restricted) Damerau-Levenshtein, most + 1 if above `most`."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a):
        c = i + 1
        row = [c]
        for j, y in enumerate(b):
            c = (c if c < last[j + 1] else last[j + 1]) + 1
            d = last[j] if x == y else last[j] + 1
            if d < c:
                c = d
            if i and j and x == b[j - 1] and a[i - 1] == y and before[j - 1] + 1 < c:
                c = before[j - 1] + 1
            row.append(c)
        before, last = last, row
        if min(row) > most and min(before) > most:
            return most + 1
    return min(last[-1], most + 1)


def deletes(s: str, most: int) -> set[str]:
    """s and every string that is s less at most so many letters."""
    out = level = {s}
    for _ in range(most):
        level = {x[:i] + x[i + 1 :] for x in level for i in range(len(x))}
        out = out | level
    return out
