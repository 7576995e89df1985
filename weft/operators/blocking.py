"""Candidate pairs by blocking and by sorted neighbourhood, both as equal joins.

Pairs of records carry only the two ids (a_rid, b_rid). Null block keys never pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.session import cut


def block(left: DataFrame, right: DataFrame, keys: list[str], a_id: str, b_id: str) -> DataFrame:
    """Pairs that agree in all keys."""
    a = left.select(F.col(a_id).alias("a_rid"), *[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
    b = right.select(F.col(b_id).alias("b_rid"), *[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
    return a.join(b, [f"__{i}" for i in range(len(keys))]).select("a_rid", "b_rid")


def global_rank(keys: DataFrame, key: str, *, parts: int | None = None) -> DataFrame:
    """(key, rank): dense rank of the distinct non-null keys. Ranges (as many as shuffle partitions) are ranked apart and
    shifted by the sizes of those before them, so no single task sorts all keys; the offsets are one row for each range."""
    parts = parts or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = keys.where(F.col(key).isNotNull()).select(key).distinct()
    d = cut(d.repartitionByRange(parts, key).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = d.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__part", before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    return d.withColumn("__r", inside).join(F.broadcast(sizes), "__part").select(key, (F.col("__before") + F.col("__r")).cast("int").alias("rank"))


def sorted_neighbourhood(
    left: DataFrame, right: DataFrame, sort_key: str, a_id: str, b_id: str, *, window: int = 3, block_keys: list[str] = (), rank_parts: int | None = None
) -> DataFrame:
    """Pairs whose sort keys lie at most (window - 1) / 2 apart in the order of all distinct keys, inside equal blocks.

    The band is no theta join: each left row is put at every rank it reaches and meets the right rows by equality.
    """
    reach = (window - 1) // 2
    ranks = global_rank(left.select(F.col(sort_key).alias("__k")).unionByName(right.select(F.col(sort_key).alias("__k"))), "__k", parts=rank_parts)
    blocks = [F.col(k).alias(f"__b{i}") for i, k in enumerate(block_keys)]
    names = [f"__b{i}" for i in range(len(block_keys))]
    a = left.select(F.col(a_id).alias("a_rid"), F.col(sort_key).alias("__k"), *blocks).join(ranks, "__k")
    a = a.select("a_rid", *names, F.explode(F.sequence(F.col("rank") - reach, F.col("rank") + reach)).alias("rank"))
    b = right.select(F.col(b_id).alias("b_rid"), F.col(sort_key).alias("__k"), *blocks).join(ranks, "__k").select("b_rid", *names, "rank")
    return a.join(b, ["rank", *names]).select("a_rid", "b_rid")


def union_pairs(*pairs: DataFrame) -> DataFrame:
    """All pairs once."""
    return reduce(DataFrame.unionByName, pairs).distinct()


#: names of one block and side that are not dealt further
PART = 512
#: cells for each task that the pairs of all blocks are dealt in, by a block's share of them, and parts of one side at most:
#: a name is shuffled so often at most, however large the blocks are
WAVES, GRID = 4, 8


def _dealt(a: DataFrame, b: DataFrame, on: list[str], part: int, tasks: int, grid: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cell (__x, __y) in which names of one block meet: a name is in one part of its own side and meets
    every part of the other. Blocks of more than their share of a task's pairs are dealt, at most WAVES * tasks of them."""
    size = a.groupBy(*on).agg(F.count("*").alias("__n")).join(b.groupBy(*on).agg(F.count("*").alias("__m")), on)
    size = cut(size.select(*on, F.col("__n").cast("double").alias("__n"), F.col("__m").cast("double").alias("__m")), "blocks")
    total = size.agg(F.sum(F.col("__n") * F.col("__m")).alias("__all"))
    share = F.ceil(F.sqrt(WAVES * tasks * F.col("__n") * F.col("__m") / F.col("__all")))
    parts = lambda n: F.least(F.ceil(n / part), share, F.lit(grid)).cast("int")
    crowded = size.crossJoin(F.broadcast(total)).where(share > 1).select(*on, parts(F.col("__n")).alias("__of_x"), parts(F.col("__m")).alias("__of_y")).where("__of_x > 1 or __of_y > 1")
    of = {s: F.coalesce(f"__of_{s}", F.lit(1)) for s in "xy"}

    def side(df: DataFrame, name: str, own: str, other: str) -> DataFrame:
        df = df.join(F.broadcast(crowded), on, "left").withColumn(f"__{own}", F.pmod(F.xxhash64(name), of[own]).cast("int"))
        return df.withColumn(f"__{other}", F.explode(F.sequence(F.lit(0), of[other] - 1))).drop("__of_x", "__of_y").repartition(tasks, *on, "__x", "__y")

    # a fixed number of partitions: the little that is shuffled says nothing of the pairs it makes
    return side(a, "name_a", "x", "y"), side(b, "name_b", "y", "x")


def _bearers(df: DataFrame, i: str, *, phonetic: str, region: str | None, name: str, columns: list[str], side: str) -> DataFrame:
    """(__block, __sound, name_<side>, __rows_<side>): each distinct name with the records that bear it, none without a name."""
    row = F.struct(F.col(i).alias(f"{side}_rid"), *[F.col(c).alias(f"{c}_{side}") for c in columns if c in df.columns and c != name])
    keys = [(F.col(region) if region else F.lit("")).alias("__block"), F.col(phonetic).alias("__sound"), F.col(name).alias(f"name_{side}")]
    # without columns a record is its id, however often and with whatever else it was delivered
    gather = F.collect_list if columns else F.collect_set
    return df.where(F.col(name) != "").groupBy(*keys).agg(gather(row).alias(f"__rows_{side}"))


def name_pairs(left: DataFrame, right: DataFrame, a_id: str, b_id: str, *, phonetic: str, region: str | None, name: str, window: int = 3, columns: list[str] = (), part: int = PART, grid: int = GRID) -> DataFrame:
    """(__block, name_a, name_b, __rows_a, __rows_b): pairs of distinct names, none empty, by compound blocking where both
    registries have a region and by phonetic blocking where not, and by the neighbourhood of the names, with the records
    that bear them. __block is the region, if there is one.

    Only names are shuffled, never pairs, and as often as a grid has parts: a pair of neighbours is left out where blocking has it, so each comes once."""
    own_region = region if region is not None and region in left.columns and region in right.columns else None
    a, b = (cut(_bearers(df, i, phonetic=phonetic, region=own_region, name=name, columns=list(columns), side=s), f"names-{s}") for df, i, s in ((left, a_id, "a"), (right, b_id, "b")))
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = ["__block", "name_a", "name_b", "__rows_a", "__rows_b"]
    on = ["__block", "__sound"]
    x, y = _dealt(a, b, on, part, tasks, grid)
    same = x.join(y, [*on, "__x", "__y"]).select(*out)
    reach = (window - 1) // 2
    ranks = global_rank(a.select(F.col("name_a").alias("__k")).unionByName(b.select(F.col("name_b").alias("__k"))), "__k")
    ranked = lambda df, n: df.join(ranks.withColumnRenamed("__k", n), n)
    # neighbours meet in stretches of ranks; only names near the end of one are in two
    stretch = lambda n: F.floor((F.col("rank") + n) / F.lit(16 * max(1, reach)))
    x = ranked(a, "name_a").withColumn("__at", stretch(0)).withColumnsRenamed({"__sound": "__sound_a", "rank": "__rank_a"})
    y = ranked(b, "name_b").withColumn("__at", F.explode(F.sequence(stretch(-reach), stretch(reach)))).withColumnsRenamed({"__sound": "__sound_b", "rank": "__rank_b"})
    apart = F.abs(F.col("__rank_a") - F.col("__rank_b")) > reach
    near = x.join(y, ["__block", "__at"]).where(~apart & ~F.coalesce(F.col("__sound_a") == F.col("__sound_b"), F.lit(False))).select(*out)
    return same.unionByName(near)


def expand(pairs: DataFrame) -> DataFrame:
    """Pairs of names (name_pairs, and what was added to them) as pairs of records, with both records' columns suffixed _a
    and _b. The name itself is there as name_a and name_b. No pair is shuffled."""
    kept = [c for c in pairs.columns if c not in ("__block", "__rows_a", "__rows_b")]
    each = pairs.select(*kept, F.explode("__rows_a").alias("__a"), "__rows_b")
    return each.select(*kept, "__a", F.explode("__rows_b").alias("__b")).select(*kept, "__a.*", "__b.*")


def candidates(left: DataFrame, right: DataFrame, a_id: str, b_id: str, *, phonetic: str, region: str | None, sort_key: str, window: int = 3) -> DataFrame:
    """Candidate pairs of records whose names are candidates. Names are paired once, however many records bear them; the
    phonetic key depends on the name, and records without a name pair with none."""
    return expand(name_pairs(left, right, a_id, b_id, phonetic=phonetic, region=region, name=sort_key, window=window)).select("a_rid", "b_rid")


def candidates_among(labels: DataFrame, left: DataFrame, right: DataFrame, *, a_key: str, b_key: str, phonetic: str, region: str, name: str, window: int = 3) -> DataFrame:
    """The labels (a_key, b_key) that are candidates: both keys have records with a name in one region whose names sound alike or
    are neighbours. Starts from the labels, so no other candidate is made."""
    ranks = global_rank(left.select(name).unionByName(right.select(name)).where(F.col(name) != ""), name)
    side = lambda df, key, s: df.where(F.col(name) != "").join(ranks, name).select(key, F.col(region).alias("__block"), F.col(phonetic).alias(f"__sound_{s}"), F.col("rank").alias(f"__rank_{s}")).distinct()
    both = labels.join(side(left, a_key, "a"), a_key).join(side(right, b_key, "b"), [b_key, "__block"])
    near = F.abs(F.col("__rank_a") - F.col("__rank_b")) <= (window - 1) // 2
    return both.where((F.col("__sound_a") == F.col("__sound_b")) | near).select(a_key, b_key).distinct()


def candidate_count(pairs: DataFrame) -> DataFrame:
    """(candidate_pairs): how many pairs of records the pairs of names are."""
    n = F.sum(F.size("__rows_a").cast("bigint") * F.size("__rows_b"))
    return pairs.agg(F.coalesce(n, F.lit(0)).alias("candidate_pairs"))


def reduction(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: sizes, pairs possible and kept (pairs: name_pairs), and the share of pairs saved; the product is never made."""
    a, b = (x.agg(F.count("*").alias(n)) for x, n in ((left, "left_rows"), (right, "right_rows")))
    one = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(candidate_count(pairs)))
    possible = F.col("left_rows") * F.col("right_rows")
    return one.select("*", possible.alias("possible_pairs"), F.round(100 * (1 - F.col("candidate_pairs") / possible), 6).alias("reduction_pct"))
