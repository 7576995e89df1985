"""Joins and reports between registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_column(df: DataFrame, names: list[str], default: str | None = None) -> str | None:
    """The first of the names the table has."""
    return next((n for n in names if n in df.columns), default)


def ensure_column(df: DataFrame, name: str, default: str = "Unknown") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def row_number_top(df: DataFrame, by: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group in the order; Catalyst limits groups before the shuffle."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last version of each key. Combined before the shuffle, so a key delivered very often is no burden."""
    return df.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row")).select("__row.*")


def unmatched(df: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the matched; rows without key stay."""
    return df.join(matched.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def group_sizes(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Rows of each non-null value, most first; `top` for a report of so many."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(key))
    return g.limit(top) if top else g


def split_linked(left: DataFrame, right: DataFrame, ref: str, right_key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(linked, left unlinked, right unlinked): left rows whose reference the right registry holds, and the rest of both."""
    keys = right.select(F.col(right_key).alias(ref)).where(F.col(ref).isNotNull()).distinct()
    linked, rest = left.join(keys, ref, "left_semi"), left.join(keys, ref, "left_anti")
    used = linked.select(F.col(ref).alias(right_key)).distinct()
    return linked, rest, right.join(used, right_key, "left_anti")


def already_linked(linked: DataFrame, right: DataFrame, ref: str, right_key: str, take: dict[str, str]) -> DataFrame:
    """Verified pairs with score 1, the right side's columns fetched by one join; the right key must be unique."""
    r = right.select(F.col(right_key).alias(ref), *[F.col(c).alias(n) for c, n in take.items()])
    return linked.join(r, ref).withColumn("score", F.lit(1.0)).withColumn("match_source", F.lit("verified"))


def combine(verified: DataFrame, inferred: DataFrame) -> DataFrame:
    """Both lists of matches under all columns of either."""
    return verified.unionByName(inferred.withColumn("match_source", F.lit("inferred")), allowMissingColumns=True)


def bridge(ab: DataFrame, bc: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Links from the first registry to the third through the second."""
    return ab.join(bc, on).select(*columns)


def with_reasons(left: DataFrame, matched: DataFrame, key: str, defaults: dict[str, str]) -> DataFrame:
    """Every left row, with what was matched or the default reason."""
    out = left.join(matched, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def top_candidates(left: DataFrame, right: DataFrame, on: str, score, order: str, a_id: str, *, k: int = 5) -> DataFrame:
    """The k best right rows of each left row inside equal blocks, equal scores in the right table's order. Scores are taken
    over distinct pairs of texts."""
    pairs = left.join(right, on)
    return row_number_top(score(pairs), [a_id], [F.desc("score"), F.asc(order)], k)


def candidate_lists(cands: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """One JSON list of candidates for each left row, best first; lists hold at most the k of the search before."""
    s = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], F.struct(*columns).alias("c"))))
    return cands.groupBy(key).agg(F.to_json(F.transform(s, lambda x: x["c"])).alias("candidates"))
