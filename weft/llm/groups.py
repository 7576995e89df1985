"""Consolidating pairwise matches into groups by low-diameter decomposition.

Every vertex draws an exponentially distributed shift. A cluster grows from each vertex, started the earlier the larger
its shift; a vertex joins the cluster that reaches it first, that is, the centre of least distance minus shift. The
shifts are cut off at the number of growth steps, so the growth of a level is a fixed chain of message passing over the
edges. Clusters then become the vertices of the next, smaller graph, whose edges are those between clusters, until
none are left, however many levels that takes; the last few hundred edges go through theirs in one task, where a shuffle a
step would cost more than the work, by the same steps and to the same groups. The assignments of the levels are composed from the last to the first, and each group is named by its
smallest key.

Messages to a vertex are combined before the shuffle, so a key with a third of all links costs no task more than its
share; on its sending side the adaptive skew join splits it. Nulls: a link with a null end is no link. A link of a key to
itself makes a group of one. Repeated and turned links count once. No links, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.session import cut

#: growth steps and rate of the shifts by level; the last holds for all later ones
SCHEDULE = ((4, 0.5), (5, 0.4), (8, 0.2))
#: a contracted graph of at most so many edges goes through its last levels in one task
ONE_TASK = 1 << 9


def _shift(v: Column, level: int, steps: int, rate: float) -> Column:
    u = (F.pmod(F.xxhash64(v, F.lit(level)), F.lit(1 << 52)) + 1).cast("double") / float(1 << 52)
    jitter = F.pmod(F.xxhash64(v, F.lit(-1 - level)), F.lit(1 << 20)).cast("double") / float(1 << 20)
    return F.least(-F.log(u) / rate, F.lit(float(steps)) - jitter)


def _grow(edges: DataFrame, level: int) -> DataFrame:
    """(v, c): each vertex of the edges (u < v) and the centre of its cluster."""
    steps, rate = SCHEDULE[min(level, len(SCHEDULE) - 1)]
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    own = both.select("u").distinct()
    at = own.select("u", F.struct((-_shift(F.col("u"), level, steps, rate)).alias("t"), F.col("u").alias("c")).alias("s"))
    # with an edge to itself a vertex keeps what it has, and the chain of steps stays a single line of plans
    both = both.unionByName(own.select("u", F.col("u").alias("v")))
    for _ in range(steps):
        sent = F.struct((F.col("s.t") + (F.col("u") != F.col("v")).cast("int")).alias("t"), F.col("s.c").alias("c"))
        at = both.join(at.hint("merge"), "u").select("v", sent.alias("s")).groupBy(F.col("v").alias("u")).agg(F.min("s").alias("s"))
    at = at.withColumnRenamed("u", "v")
    return at.select("v", F.col("s.c").alias("c"))


def _contract(edges: DataFrame, to: DataFrame) -> DataFrame:
    e = edges.join(to.select(F.col("v").alias("u"), F.col("c").alias("cu")).hint("merge"), "u").join(to.select("v", F.col("c").alias("cv")).hint("merge"), "v")
    return e.where("cu <> cv").select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct()


def _last_levels(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same decomposition, level by level to the end, over the few edges of one task: (v, c) with c the last centre."""
    pdf = pd.concat(list(it), ignore_index=True)
    codes, names = pd.factorize(pd.concat([pdf["u"], pdf["v"]], ignore_index=True))
    u, v = codes[: len(pdf)], codes[len(pdf) :]
    root, level = np.arange(len(names)), 0
    while len(u):
        steps, rate = SCHEDULE[-1]
        draw = np.random.default_rng(level).random((2, len(names)))
        t = -np.minimum(-np.log1p(-draw[0]) / rate, steps - draw[1])
        c = np.arange(len(names))
        both_u, both_v = np.r_[u, v], np.r_[v, u]
        for _ in range(steps):
            # every message once, the best to each vertex first
            to, at, by = np.r_[both_v, np.arange(len(names))], np.r_[t[both_u] + 1, t], np.r_[c[both_u], c]
            order = np.lexsort((by, at, to))
            first = order[np.r_[True, np.diff(to[order]) != 0]]
            t, c = at[first], by[first]
        root = c[root]
        u, v = c[u], c[v]
        lo, hi = np.minimum(u, v)[u != v], np.maximum(u, v)[u != v]
        u, v = np.unique(np.stack([lo, hi]), axis=1) if len(lo) else (lo, hi)
        level += 1
    names = np.asarray(names, dtype=object)
    yield pd.DataFrame({"v": names, "c": names[root]})


def connected_groups(links: DataFrame, a: str, b: str) -> DataFrame:
    """(group_key, member_key): every key of any link once, group_key being the smallest of its group as a string."""
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
    links = cut(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    edges, levels = links.where("u <> v"), []
    while n := edges.count():
        if n <= ONE_TASK:
            levels.append(cut(edges.coalesce(1).mapInPandas(_last_levels, "v string, c string"), "clusters"))
            break
        levels.append(cut(_grow(edges, len(levels)), "clusters"))
        edges = cut(_contract(edges, levels[-1]), "contracted")
    alone = links.where("u = v").select(F.col("u").alias("v"))
    if not levels:
        return alone.select(F.col("v").alias("group_key"), F.col("v").alias("member_key"))
    root = levels[-1]
    for to in reversed(levels[:-1]):
        up = root.select(F.col("v").alias("c"), F.col("c").alias("r"))
        root = to.join(up, "c", "left").select("v", F.coalesce("r", "c").alias("c"))
    root = root.unionByName(alone.select("v", F.col("v").alias("c")).join(root.select("v"), "v", "left_anti"))
    root = cut(root, "groups")
    least = root.groupBy("c").agg(F.min("v").alias("group_key"))
    return root.join(least, "c").select("group_key", F.col("v").alias("member_key"))


def group_sizes(groups: DataFrame) -> DataFrame:
    """(size, groups): how many groups have so many members."""
    return groups.groupBy("group_key").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))
