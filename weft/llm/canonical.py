"""Mapping free-entered values to a canonical list by a symmetric-delete dictionary.

Every spelling of an entry (its name, short name, and the orders and words its parts are written in) is stored under
all strings that are left when up to `edits` letters are taken out of it. A value is looked up under its own such
strings, so any entry within that edit distance meets it without a scan of the list. The meetings are ranked by weighted
Damerau-Levenshtein distance, then by the entry's frequency in the reference; two different entries that rank alike are
no answer. The dictionary is broadcast while its strings, counted before anything is built, number at most
BROADCAST_STRINGS (so its size is known); a larger one is joined on the same strings, with the same answers.

Nulls and blanks mean no entry and give no row. Spellings and values are taken whole, however long; a value longer than
the longest spelling plus the edits cannot meet one and isn't cut up. Repeated values cost one look-up per batch.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.textkit import damerau, deletes, latin, plain_edits

BROADCAST_STRINGS = 2_000_000  # about 200 MB in a worker

# fixed values: words that name the level or the office, not the place
LEVEL_WORDS = {
    "region", "regional", "reg", "state", "national", "rs", "health", "bureau", "rhb", "city", "administration", "admin", "ca",
    "zone", "zonal", "zn", "zhd", "department", "dept", "hd", "office", "zo",
}
OTHER_LEVEL = {"region": {"zone", "zonal", "zn", "zhd"}, "zone": {"region", "regional", "reg", "rhb", "bureau", "state"}}
DIRECTIONS = {"north": ("semien",), "south": ("debub",), "east": ("misraq",), "west": ("mirab",)}
_SIGNS = re.compile(r"[^a-z0-9]+")


def tokens(value: str) -> list[str]:
    s = latin(value)
    # an abbreviation written with points is one word
    s = re.sub(r"\b(?:[a-z]\.){2,}[a-z]?\b\.?", lambda m: m[0].replace(".", ""), s)
    return [t for t in _SIGNS.split(s) if t]


def squeeze(value: str) -> str:
    """The value as looked up: its words but those of level and office, without space."""
    ts = tokens(value)
    kept = [t for t in ts if t not in LEVEL_WORDS]
    return "".join(kept)


def forms(s: str) -> list[str]:
    """A squeezed value as it stands and, where vowels are written by their English sound, with those undone."""
    sound = s.replace("oo", "u").replace("ee", "i").replace("ou", "u")
    return [s] if sound == s else [s, sound]


def spellings(name: str, short: str | None) -> set[str]:
    """How an entry is written: directions in full, in the local word, as a letter, before or after."""
    ts = tokens(name)
    dirs = [t for t in ts if t in DIRECTIONS]
    rest = "".join(t for t in ts if t not in DIRECTIONS)
    out = {"".join(ts)}
    if dirs and rest:
        full = "".join(dirs)
        heads = {full, "".join(d[0] for d in dirs), dirs[0][0] + "".join(dirs[1:]), "".join(dirs[:-1]) + dirs[-1][0]}
        heads |= {"".join(w) for w in ([DIRECTIONS[dirs[0]][0], *dirs[1:]], [DIRECTIONS[d][0] for d in dirs])}
        out |= {x for h in heads for x in (h + rest, rest + h)}
    if short:
        out.add("".join(tokens(short)))
    return out


class Dictionary:
    def __init__(self, entries: list[tuple[int, str, str | None, float]], edits: int = 2):
        """entries: id, name, short name, frequency."""
        self.edits, self.freq = edits, {e: f for e, _, _, f in entries}
        self.terms: dict[str, set[int]] = {}
        for e, name, short, _ in entries:
            for t in spellings(name, short):
                self.terms.setdefault(t, set()).add(e)
        self.under: dict[str, list[str]] = {}
        self.longest = max(map(len, self.terms), default=0)
        for t in self.terms:
            for d in deletes(t, self.allowed(t)):
                self.under.setdefault(d, []).append(t)
        self.seen: dict[str, int] = {}

    def allowed(self, term: str) -> int:
        return allowed(term, self.edits)

    def meet(self, s: str) -> set[str]:
        if len(s) > self.longest + self.edits:
            return set()
        return {t for f in forms(s) for d in deletes(f, self.edits) for t in self.under.get(d, ())}

    def look_up(self, value: str, level: str | None = None) -> int:
        """The entry meant, 0 if none."""
        s = squeeze(value)
        if not s:
            return 0
        if s not in self.seen:
            if len(self.seen) > 1 << 18:
                self.seen.clear()
            self.seen[s] = rank(s, [(t, e, self.freq[e]) for t in self.meet(s) for e in self.terms[t]], self.allowed)
        return self.seen[s]


def rank(s: str, met: list[tuple[str, int, float]], allowed) -> int:
    best: dict[int, tuple[float, float]] = {}
    for t, e, f in met:
        k = allowed(t)
        near = [damerau(x, t, k + 0.01) for x in forms(s) if plain_edits(x, t, k) <= k]
        if not near:
            continue
        score = (min(near), -f)
        if score[0] < float("inf") and (e not in best or score < best[e]):
            best[e] = score
    order = sorted((v, e) for e, v in best.items())
    if not order or len(order) > 1 and order[0][0] == order[1][0]:
        return 0
    return order[0][1]


def allowed(term: str, edits: int) -> int:
    """Short forms are taken as written, short names with one edit."""
    return min(edits, 0 if len(term) <= 3 else 1 if len(term) <= 4 else 2)


def strings_of(name: str, short: str | None, edits: int) -> int:
    """How many strings an entry has in the dictionary, at most."""
    return sum(sum(math.comb(len(t), k) for k in range(allowed(t, edits) + 1)) for t in spellings(name, short))


def entries_of(reference: DataFrame, id_col: str, name_col: str, short_col: str, freq_col: str | None = None) -> DataFrame:
    return reference.select(
        F.col(id_col).cast("int").alias("id"), F.col(name_col).alias("name"), F.col(short_col).alias("short"), (F.col(freq_col).cast("double") if freq_col else F.lit(1.0)).alias("freq")
    ).where("id is not null and name is not null")


def dictionary_strings(entries: DataFrame, edits: int = 2) -> int:
    """The number of strings the dictionary of the entries holds, counted where the entries are."""

    @F.pandas_udf("bigint")
    def strings(names: pd.Series, shorts: pd.Series) -> pd.Series:
        return pd.Series([strings_of(n, s, edits) for n, s in zip(names, shorts)], dtype="int64")

    return entries.select(strings("name", "short").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def typed_frequencies(values: DataFrame, value: str, entries: DataFrame) -> DataFrame:
    """The entries with, as their frequency, how often their name or short name was typed as it stands, whatever its case."""
    plain = lambda c: F.lower(F.trim(c))
    typed = values.where(F.col(value).isNotNull()).groupBy(plain(F.col(value)).alias("t")).agg(F.count("*").alias("n"))
    ways = entries.select("id", F.explode(F.array_distinct(F.array(plain(F.col("name")), plain(F.coalesce("short", "name"))))).alias("t"))
    # the entries are the short side; the adaptive plan broadcasts them where they are small
    n = ways.join(typed, "t").groupBy("id").agg(F.sum("n").cast("double").alias("freq"))
    return entries.drop("freq").join(n, "id", "left").select("id", "name", "short", F.coalesce("freq", F.lit(0.0)).alias("freq"))


def map_values(values: DataFrame, value: str, entries: DataFrame, *, edits: int = 2, out: str = "entry_id") -> DataFrame:
    """values with `out`: the id of the entry each value means, 0 for none, no row for null or blank values."""
    rows = values.where(F.length(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)\s", "")) > 0)
    if dictionary_strings(entries, edits) > BROADCAST_STRINGS:
        return _map_by_join(rows, value, entries, edits, out)
    known = Dictionary([(r["id"], r["name"], r["short"], r["freq"]) for r in entries.toLocalIterator()], edits)
    held = values.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("int")
    def entry(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        d = held.value
        for s in it:
            codes, uniq = pd.factorize(s)
            yield pd.Series([d.look_up(u) for u in uniq], dtype="int32").iloc[codes].reset_index(drop=True) if len(s) else pd.Series([], dtype="int32")

    return rows.withColumn(out, entry(F.col(value)))


def _map_by_join(rows: DataFrame, value: str, entries: DataFrame, edits: int, out: str) -> DataFrame:
    """The same for lists of any length: both sides' strings meet in an equal join, over distinct values only."""
    probe = Dictionary([], edits)

    @F.pandas_udf("array<string>")
    def spelt(names: pd.Series, shorts: pd.Series) -> pd.Series:
        return pd.Series([sorted(spellings(n, s)) for n, s in zip(names, shorts)])

    @F.pandas_udf("array<string>")
    def under(terms: pd.Series) -> pd.Series:
        return pd.Series([sorted(deletes(t, probe.allowed(t))) for t in terms])

    @F.pandas_udf("string")
    def squeezed(v: pd.Series) -> pd.Series:
        return v.map(squeeze)

    @F.pandas_udf("array<string>")
    def looked(v: pd.Series) -> pd.Series:
        return pd.Series([sorted({d for f in forms(s) for d in deletes(f, edits)}) if len(s) <= longest + edits else [] for s in v])

    @F.pandas_udf("int")
    def best(s: pd.Series, met: pd.Series) -> pd.Series:
        return pd.Series([rank(a, [(x["term"], x["id"], x["freq"]) for x in m], probe.allowed) for a, m in zip(s, met)], dtype="int32")

    terms = entries.select("id", "freq", F.explode(spelt("name", "short")).alias("term"))
    # one number: the length of the longest spelling, which a value may exceed by the edits
    longest = terms.agg(F.coalesce(F.max(F.length("term")), F.lit(0))).first()[0]
    terms = terms.select("id", "freq", "term", F.explode(under("term")).alias("d"))
    distinct = rows.select(F.col(value).alias("v")).distinct().withColumn("s", squeezed("v"))
    met = distinct.select("s").distinct().withColumn("d", F.explode(looked("s"))).join(terms, "d").select("s", "id", "freq", "term").distinct()
    chosen = met.groupBy("s").agg(F.collect_list(F.struct("term", "id", "freq")).alias("met")).select("s", best("s", "met").alias(out))
    named = distinct.join(chosen, "s", "left").select(F.col("v").alias(value), F.coalesce(out, F.lit(0)).cast("int").alias(out))
    return rows.join(named, value)


def misses(mapped: DataFrame, value: Column, out: str = "entry_id") -> DataFrame:
    """(value, n): the values without an entry, as typed, and how often each came."""
    return mapped.where(F.col(out) == 0).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
