"""Sentence boundaries across languages and scripts, by a pushdown automaton.

The automaton reads the marks of a text in order. Its stack holds the quotations and brackets that are open and the
list that is being read; a terminator ends a unit only when the stack holds no quotation or bracket. Full stops are
looked up backwards in a trie of abbreviations that says whether one can stand at a sentence's end. Marks that open
but never close within their paragraph, and closing ones without an opening, are passed over.

Blank lines end units, and so do the starts of list items; headings and list items are units. In Thai, units are what
stands between white space. Offsets count Unicode characters from 0, the end exclusive, without white space at the
ends. A null, empty or blank text has no units. Texts are read whole; each unit of a document comes out once, and a
document delivered twice gives its rows twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER, MAYBE, MONTH = 1, 2, 3

# fixed values: abbreviations after which the sentence goes on
GOES_ON = (
    "Mr Mrs Ms Mme Mlle Dr Sr Prof St Eng Rev Hon Gen Ref Prim Med Capt Col Lt Sgt Fr Br No Nos no nos Nr p pp Fig fig Figs sect Sect sec ch Ch vol Vol ed "
    "wk wks approx ca max min cf Cf vs e.g i.e incl excl esp env ex fkn kg Lakk lakk M MM W w/ro Ob Ad resp art Art al tel Tel viz ዓ.ም ዓ.ዓ ኪ.ግ ኪ.ሜ ሴ.ሜ ሜ ዶ/ር د أ م ص"
).split()
# fixed values: abbreviations that also stand at a sentence's end
MAY_END = "etc a.m p.m Hosp H.C H.P H.Q H.O R.H.B Z.H.D Co Ltd Inc Jr U.N U.S U.K N.G.O Dept dept hrs hr mins Ave Rd km cm mm ml mg lb oz St".split()
MONTHS = "Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec janv févr avr juil déc".split()
# words after which a single capital is a name's own end, not an initial
BEFORE_LETTER = frozenset(("vitamin", "vitamine", "hepatitis", "type", "grade", "group", "block", "ward", "room", "annex", "form", "plan", "part", "option", "°"))
# words that open a sentence in small letters
SMALL_STARTS = re.compile(r"(?:e-mail|e-health|e-learning|i-|m-health|iPhone)")

PAIRS = {"«": "»", "“": "”", "„": "“", "「": "」", "『": "』", "(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "《": "》", "〈": "〉"}
CLOSERS = {v: k for k, v in PAIRS.items() if k != "„"}
QUOTES = frozenset('"«“「『')
ENDS = ".!?…。！？｡؟۔።፧፨"

EVENT = re.compile(r"[.!?…。！？｡؟۔።፧፨\"«»“”„「」『』()\[\]{}（）【】《》]|::|፡፡")
MARKS = re.compile(r"[\"«»“”„「」『』()\[\]{}（）【】《》]")
BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+|[ \f]+")
ITEM = re.compile(r"[^\S\n]*(?:([-*•–▪◦‣·])|\(?(\d{1,3}(?=[.)])|[a-zA-Z](?=\))|[ivxIVX]{2,5}(?=\)))([.)])|(\d{1,3})[、．])[^\S\n]+(?=\S)")
THAI = re.compile(r"[฀-๿]")
THAI_SPLIT = re.compile(r"(?<=[฀-๿])\s+|\s+(?=[฀-๿])")
WORD = re.compile(r"\w")


def _trie() -> dict:
    root: dict = {}
    for words, kind in ((GOES_ON, NEVER), (MAY_END, MAYBE), (MONTHS, MONTH)):
        for w in words:
            node = root
            for c in reversed(w):
                node = node.setdefault(c, {})
            node.setdefault("", kind)
    return root


TRIE = _trie()


def _abbreviation(text: str, dot: int, start: int) -> int:
    """The kind of the longest abbreviation that ends at the full stop, 0 if none."""
    node, i, kind = TRIE, dot - 1, 0
    while i >= start and (node := node.get(text[i])):
        if "" in node and (i == start or not (text[i - 1].isalnum() or text[i - 1] in "./'’")):
            kind = node[""]
        i -= 1
    return kind


def _next(text: str, i: int, end: int) -> str:
    """What comes next after white space: end, Upper, lower, digit, caseless letter, quote, bracket, other."""
    while i < end and text[i].isspace():
        i += 1
    if i >= end:
        return "end"
    c = text[i]
    if c in QUOTES:
        j = i + 1
        while j < end and text[j].isspace():
            j += 1
        return "lower" if j < end and text[j].islower() else "quote"
    if c.isdigit():
        return "digit"
    if c.isupper() or c.istitle():
        return "Upper"
    if c.islower():
        return "Upper" if SMALL_STARTS.match(text, i) else "lower"
    if c.isalpha():
        return "caseless"
    return "bracket" if c in "([（【" else "other"


def _pairs(text: str, start: int, end: int) -> dict[int, int]:
    """opening -> closing and closing -> opening position of the marks that match."""
    stack: list[tuple[str, int]] = []
    out: dict[int, int] = {}
    for m in MARKS.finditer(text, start, end):
        c, i = m[0], m.start()
        if c == '"':
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
            if at is None:
                stack.append((c, i))
                continue
        elif c in CLOSERS and (at := next((k for k in range(len(stack) - 1, -1, -1) if PAIRS.get(stack[k][0]) == c), None)) is not None:
            pass
        elif c in PAIRS:
            stack.append((c, i))
            continue
        else:
            continue
        out[stack[at][1]], out[i] = i, stack[at][1]
        del stack[at:]
    return out


def _stops(text: str, start: int, end: int) -> Iterator[int]:
    """The ends of the sentences of a stretch without blank lines and list items."""
    pairs = _pairs(text, start, end) if MARKS.search(text, start, end) else {}
    depth, unit, i = 0, start, start
    while m := EVENT.search(text, i, end):
        at, c = m.start(), m[0]
        i = m.end()
        if at in pairs:
            other = pairs[at]
            if other > at:
                depth += 1
                continue
            depth -= 1
            if depth:
                continue
            # a quotation or bracket has closed; it ends the unit if its own last sentence does and nothing goes on
            k = at - 1
            while k > other and text[k].isspace():
                k -= 1
            if text[k] not in ENDS:
                continue
            before = other - 1
            while before >= unit and text[before].isspace():
                before -= 1
            led = before >= unit and text[before] in ":："
            first = before < unit
            follows = _next(text, i, end)
            if c in QUOTES or c in "»”」』":
                stop = follows in ("Upper", "quote", "digit", "end") or (follows == "caseless" and led)
            else:
                stop = first and follows in ("Upper", "quote", "digit", "end", "caseless")
            if stop:
                yield i
                unit = i
            continue
        if depth or c in CLOSERS or c in PAIRS or c == '"':
            continue
        while i < end and text[i] in ENDS:
            i += 1
        run = text[at:i]
        # closing marks without an opening one, and those that stand just behind, stay with the unit
        while i < end and text[i] in "\"”»’')]）】" and i not in pairs and not (i + 1 < end and WORD.match(text[i + 1])):
            i += 1
        if set(run) <= {".", "…"} and (len(run) > 1 or run == "…"):
            follows = _next(text, i, end)
            cjk = at > start and "　" <= text[at - 1] <= "鿿"
            if follows in ("Upper", "quote", "end", "digit") or follows == "caseless" and not cjk:
                yield i
                unit = i
            continue
        if run == ".":
            nxt = text[i] if i < end else " "
            glued = not nxt.isspace()
            kind = _abbreviation(text, at, unit)
            prev = text[at - 1] if at > unit else " "
            if glued:
                if not (nxt.isupper() or (nxt.isalpha() and not nxt.islower()) or (i in pairs and pairs[i] > i and nxt in QUOTES)):
                    continue
                if kind == NEVER or kind == MONTH or not (prev.isalnum() or prev in ")]\"»”°%'’"):
                    continue
                if prev.isalpha() and (at - 2 < unit or not (text[at - 2].isalnum() or text[at - 2] in "°'’")) and kind != MAYBE:
                    continue  # a single letter: an initial or a part of an abbreviation
                yield i
                unit = i
                continue
            if kind == NEVER:
                # at the end of all text there is nothing it could go on with
                if _next(text, i, end) == "end":
                    yield i
                    unit = i
                elif prev == "M" and _after(text, at, unit) in BEFORE_LETTER:
                    yield i
                    unit = i
                continue
            if kind:
                follows = _next(text, i, end)
                if follows in ("Upper", "quote", "caseless", "end") or (follows == "digit" and kind == MAYBE):
                    yield i
                    unit = i
                continue
            if prev.isupper() and (at - 2 < unit or not (text[at - 2].isalnum() or text[at - 2] in "'’-/&")):
                # a single capital is an initial, unless the word before it takes a letter
                word = "°" if at - 2 >= unit and text[at - 2] == "°" else _after(text, at, unit)
                if word not in BEFORE_LETTER and _next(text, i, end) in ("Upper", "lower"):
                    if not (at - 2 >= unit and text[at - 2] == "."):
                        continue
                    if _next(text, i, end) == "lower":
                        continue
        yield i
        unit = i


def _after(text: str, dot: int, unit: int) -> str:
    """The word before the single letter that stands before the full stop."""
    k = dot - 2
    while k >= unit and text[k].isspace():
        k -= 1
    e = k + 1
    while k >= unit and (text[k].isalpha()):
        k -= 1
    return text[k + 1 : e].lower()


def _segments(text: str, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
    """A paragraph's stretches (start, end, is a list item)."""
    if "\n" not in text[start:end] and not ITEM.match(text, start, end):
        yield start, end, False
        return
    levels: list[tuple[str, int]] = []  # the lists that are open: marker style and last number
    seg, item, at, lead = start, False, start, True
    while at < end:
        nl = text.find("\n", at, end)
        stop = end if nl < 0 else nl
        m = ITEM.match(text, at, stop)
        if m:
            number = m[2] or m[4]
            style = m[1] or ("9" if number.isdigit() else "a") + (m[3] or "、")
            n = int(number) if number and number.isdigit() else 0
            known = next((k for k in range(len(levels) - 1, -1, -1) if levels[k][0] == style), None)
            goes = known is not None and (not n or n == levels[known][1] + 1)
            if goes or lead and (n <= 1 or at == start):
                if at > seg:
                    yield seg, at, item
                seg, item = at, True
                levels = levels[: known + 1] if goes else levels + [(style, n)]
                levels[-1] = (style, n)
        lead = text[at:stop].rstrip()[-1:] in (":", "：", "፡", "፦") or item
        at = stop + 1
    yield seg, end, item


def units(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of every unit of a text."""
    out: list[tuple[int, int]] = []
    if not text:
        return out

    def emit(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b))

    thai = THAI.search(text) is not None
    a, edges = 0, [(m.start(), m.end()) for m in BLANK.finditer(text)] + [(len(text), len(text))]
    for b, c in edges:
        for s, e, item in _segments(text, a, b):
            if item:
                emit(s, e)
                continue
            parts = [(s, e)]
            if thai:
                parts, k = [], s
                for m in THAI_SPLIT.finditer(text, s, e):
                    parts.append((k, m.start()))
                    k = m.end()
                parts.append((k, e))
            for s2, e2 in parts:
                k = s2
                if not (thai and THAI.search(text, s2, e2)):
                    for stop in _stops(text, s2, e2):
                        emit(k, stop)
                        k = stop
                emit(k, e2)
        a = c
    return out


def sentence_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start_char, end_char): every unit of every document; no shuffle, documents stay where they are read."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            ids, a, b = [], [], []
            for i, t in zip(pdf["id"], pdf["text"]):
                for s, e in units(t):
                    ids.append(i)
                    a.append(s)
                    b.append(e)
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype=pdf["id"].dtype), "start_char": pd.Series(a, dtype="int32"), "end_char": pd.Series(b, dtype="int32")})

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null and text <> ''")
    return rows.mapInPandas(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, start_char int, end_char int")
