"""Best representative of each duplicate group, by bundles of fields that belong together.

A bundle (say the parts of an address) is taken whole from one record. For each group and bundle the candidates are
the distinct bundle values, each with the most trusted, then latest record that carries it. The relaxed problem, every
bundle's own best, is solved by one aggregation for all groups; it is the root of the search and also its bound, so a
group whose bests agree with the functional dependencies is settled there. The others are searched by branch and
bound: bundles in turn, candidates by falling trust, a branch is left when its trust so far plus the bests of the
bundles still open cannot beat the best whole choice, or when it breaks a dependency.

Nulls: a field says nothing if it is null, blank or a filler word; a bundle says something if any field does, or else
is no candidate. A missing trust rank is the worst, a missing time the earliest. Ties fall to the smallest record
number, so repeated rows change nothing. A group in which no choice keeps all dependencies takes its bests and is
marked inconsistent. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.keys import strip

# fixed values: words for "not known", lower case, without the signs around them
FILLERS = [
    "unknown", "not known", "unspecified", "not specified", "not stated", "no data", "to be filled", "to be confirmed", "tbd", "tbc", "n/a", "na",
    "null", "none", "nil", "nan", "missing", "not available", "not applicable", "pending", "አይታወቅም", "የለም",
]


def says(c: Column) -> Column:
    """Whether a value says something: it has a letter or digit and is no word for "not known"."""
    word = F.lower(F.regexp_replace(c, r"(?U)^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.coalesce((word != "") & ~F.regexp_replace(word, r"(?U)\s+", " ").isin(FILLERS), F.lit(False))


@dataclass(frozen=True)
class Dependency:
    """The value of `lhs` (bundle, field) determines that of `rhs`: `table` has lhs_value and the rhs_value it implies."""

    lhs: tuple[str, str]
    rhs: tuple[str, str]
    table: DataFrame | None = None


def plain(c: Column) -> Column:
    return F.lower(strip(c))


_WORST = 1 << 30


def _order(record: str) -> Column:
    # the smallest is the most trusted: rank, then the latest time, then the smallest number
    return F.struct(
        F.coalesce(F.col("__rank"), F.lit(_WORST)).cast("int").alias("rank"),
        (-F.coalesce(F.unix_micros(F.col("__at")), F.lit(-(1 << 62)))).alias("age"),
        F.col(record).alias("record"),
    )


def best_by_field(rows: DataFrame, key: str, record: str, fields: list[str], *, rank: str, at: str) -> DataFrame:
    """(key, column_name, record): for groups of at least two records, each field's surviving record; bundles of one
    field and no dependency, for which the root of the search is its end."""
    best = survivors(rows, key, record, {f: [f] for f in fields}, rank=rank, at=at)
    return best.select("key", F.col("bundle").alias("column_name"), "record")


def _search(bundles: list[str], cands: dict[str, list[tuple]], n_deps: int) -> dict[str, tuple] | None:
    """The consistent choice of the least total (rank, age), or none. A candidate: rank, age, record, implies, has."""
    lists = [sorted(cands[b], key=lambda c: c[:3]) for b in bundles]
    floor = [(0, 0)]  # the least that the bundles from i on can cost
    for own in reversed(lists):
        floor.append((floor[-1][0] + own[0][0], floor[-1][1] + own[0][1]))
    floor.reverse()
    best: tuple | None = None
    pick: list[tuple] = []

    def fits(c: tuple) -> bool:
        for other in pick:
            for i in range(n_deps):
                for a, b in ((c, other), (other, c)):
                    if a[3][i] is not None and b[4][i] is not None and a[3][i] != b[4][i]:
                        return False
        return all(c[3][i] is None or c[4][i] is None or c[3][i] == c[4][i] for i in range(n_deps))

    def go(i: int, rank: int, age: int) -> None:
        nonlocal best
        if i == len(lists):
            whole = (rank, age, tuple(c[2] for c in pick))
            if best is None or whole < best[0]:
                best = (whole, list(pick))
            return
        for c in lists[i]:
            least = (rank + c[0] + floor[i + 1][0], age + c[1] + floor[i + 1][1])
            if best is not None and least > best[0][:2]:
                if rank + c[0] + floor[i + 1][0] > best[0][0]:
                    break
                continue
            if fits(c):
                pick.append(c)
                go(i + 1, rank + c[0], age + c[1])
                pick.pop()

    go(0, 0, 0)
    return None if best is None else dict(zip(bundles, best[1]))


def survivors(rows: DataFrame, key: str, record: str, bundles: dict[str, list[str]], *, rank: str, at: str, dependencies: list[Dependency] = ()) -> DataFrame:
    """(key, bundle, record, values, consistent) for every group of at least two records."""
    deps = list(dependencies)
    base = rows.where(F.col(key).isNotNull() & F.col(record).isNotNull()).select(
        F.col(key).alias("key"), F.col(record).alias("__record"), F.col(rank).alias("__rank"), F.col(at).cast("timestamp").alias("__at"), *{f: None for b in bundles.values() for f in b}
    )
    value = lambda fs: F.array(*[F.when(says(F.col(f)), F.col(f)) for f in fs])
    long = base.select(
        "key", _order("__record").alias("o"), F.explode(F.array(*[F.struct(F.lit(b).alias("bundle"), F.concat(value(fs), *[F.array(F.lit(None).cast("string"))] * (max(map(len, bundles.values())) - len(fs))).alias("values")) for b, fs in bundles.items()])).alias("e")
    ).select("key", "o", "e.*")
    several = base.groupBy("key").agg(F.min("__record").alias("lo"), F.max("__record").alias("hi")).where("lo <> hi").select("key")
    cand = long.where(F.exists("values", lambda v: v.isNotNull())).groupBy("key", "bundle", "values").agg(F.min("o").alias("o"))
    implies, has = [], []
    for i, d in enumerate(deps):
        at_l, at_r = bundles[d.lhs[0]].index(d.lhs[1]), bundles[d.rhs[0]].index(d.rhs[1])
        cand = cand.withColumn(f"l{i}", F.when(F.col("bundle") == d.lhs[0], plain(F.col("values")[at_l])))
        t = d.table.groupBy(plain(F.col("lhs_value")).alias(f"l{i}")).agg(F.min(plain(F.col("rhs_value"))).alias(f"implies{i}"))
        cand = cand.join(t, f"l{i}", "left").drop(f"l{i}")
        implies.append(F.col(f"implies{i}"))
        has.append(F.when(F.col("bundle") == d.rhs[0], plain(F.col("values")[at_r])))
    strings = lambda cs, name: F.array(*cs).cast("array<string>").alias(name)
    cand = cand.select("key", "bundle", "values", "o", strings(implies, "implies"), strings(has, "has")).join(several, "key", "left_semi")
    # candidates of a bundle that imply and hold the same are equal to every dependency: only the best of them can be
    # chosen, so a group sends no more of them to the search than a dependency has values
    cand = cand.groupBy("key", "bundle", "implies", "has").agg(F.min_by(F.struct("values", "o"), "o").alias("c")).select("key", "bundle", "c.values", "c.o", "implies", "has")
    # the root: every bundle's best, and whether these agree
    root = cand.groupBy("key", "bundle").agg(F.min_by(F.struct("values", "o", "implies", "has"), "o").alias("c"))
    agree = F.lit(True)
    for i in range(len(deps)):
        agree = agree & (F.coalesce(F.max(F.col("c.implies")[i]) == F.max(F.col("c.has")[i]), F.lit(True)))
    open_keys = root.groupBy("key").agg(agree.alias("agree"))
    names, n = list(bundles), len(deps)

    def branch(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for k, cs in zip(pdf["key"], pdf["cands"]):
                by: dict[str, list[tuple]] = {}
                shown = {}
                for c in cs:
                    o = c["o"]
                    by.setdefault(c["bundle"], []).append((int(o["rank"]), int(o["age"]), int(o["record"]), list(c["implies"]), list(c["has"])))
                    shown[c["bundle"], int(o["record"])] = list(c["values"])
                own = [b for b in names if b in by]
                found = _search(own, by, n)
                ok = found is not None
                found = found or {b: min(by[b], key=lambda c: c[:3]) for b in own}
                out += [(k, b, c[2], shown[b, c[2]], ok) for b, c in found.items()]
            yield pd.DataFrame(out, columns=["key", "bundle", "record", "values", "consistent"]).astype({"record": "int64", "consistent": bool})

    settled = root.join(open_keys.where("agree"), "key", "left_semi").select("key", "bundle", F.col("c.o.record").alias("record"), F.col("c.values").alias("values"), F.lit(True).alias("consistent"))
    searched = (
        cand.join(open_keys.where("not agree"), "key", "left_semi")
        .groupBy("key")
        .agg(F.collect_list(F.struct("bundle", "values", "o", "implies", "has")).alias("cands"))
        .mapInPandas(branch, "key string, bundle string, record bigint, values array<string>, consistent boolean")
    )
    return settled.unionByName(searched)
