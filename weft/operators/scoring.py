"""Features, scores and thresholds of candidate pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from weft.functions import pairs as many
from weft.functions import similarity as sim

EPS = 1e-10
#: scores a pair from its columns; any function of a DataFrame that adds `score` may stand in, such as a model in mapInPandas
Scorer = Callable[[DataFrame], DataFrame]


def hydrate(pairs: DataFrame, left: DataFrame, right: DataFrame, a_id: str, b_id: str, columns: list[str]) -> DataFrame:
    """Both records' columns beside each pair, suffixed _a and _b."""
    a = left.select(F.col(a_id).alias("a_rid"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = right.select(F.col(b_id).alias("b_rid"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.join(a, "a_rid").join(b, "b_rid")


def name_features(pairs: DataFrame, name: str, *, threshold: float = 0.6) -> DataFrame:
    """Exact name, and three string comparisons as 0 or 1 from the threshold up, beside pairs of names or of records."""
    a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
    return pairs.withColumns({
        "name_exact": sim.exact(a, b),
        "name_levenshtein": sim.at_least(sim.levenshtein_similarity(a, b), threshold),
        "name_jaro_winkler": sim.at_least(many.jaro_winkler_similarity(a, b), threshold),
        "name_cosine": sim.at_least(many.bigram_cosine(a, b), threshold),
    })


def features(pairs: DataFrame, name: str, equal: list[str] = (), *, threshold: float = 0.6) -> DataFrame:
    """The pair's features: those of the names, where they are not there yet (name_features), exact places where both
    registries have them, their sum, and their mean taken over the features and the sum."""
    df = pairs if "name_exact" in pairs.columns else name_features(pairs, name, threshold=threshold)
    places = {f"{c}_exact": sim.exact(F.coalesce(f"{c}_a", F.lit("")), F.coalesce(f"{c}_b", F.lit(""))) for c in equal if f"{c}_a" in pairs.columns and f"{c}_b" in pairs.columns}
    out = ["name_exact", "name_levenshtein", "name_jaro_winkler", "name_cosine", *places]
    df = df.withColumns(places)
    total = reduce(add, [F.col(c) for c in out])
    return df.withColumn("feature_sum", total).withColumn("feature_mean", 2 * F.col("feature_sum") / (len(out) + 1))


name_likeness = many.name_likeness


def lexical_score(name: str, places: list[str] = ("woreda", "zone"), *, known: str = "__text") -> Scorer:
    """The score at hand without a model: the mean of three string similarities of the names, and the share of places that
    agree as a fifth of the whole. Fixed range 0 to 1. The likeness of the names is taken from column `known` where the
    pairs have it, such as where names were compared before they were spread to records."""

    def score(pairs: DataFrame) -> DataFrame:
        a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
        got = [sim.exact(F.lower(F.trim(f"{p}_a")), F.lower(F.trim(f"{p}_b"))) for p in places if f"{p}_a" in pairs.columns and f"{p}_b" in pairs.columns]
        agree = reduce(add, got) / len(got) if got else F.lit(0.0)
        if known not in pairs.columns:
            # each distinct pair of names is compared once
            names = pairs.select(a, b).distinct().withColumn(known, name_likeness(a, b))
            pairs = pairs.join(names, [f"{name}_a", f"{name}_b"])
        return pairs.withColumn("score", 0.8 * F.col(known) + 0.2 * agree if got else F.col(known)).drop(known)

    return score


def min_max(df: DataFrame, score: str = "score", out: str | None = None) -> DataFrame:
    """The score over its range in this batch; one row of bounds goes to every task, no global window."""
    bounds = df.agg(F.min(score).alias("__lo"), F.max(score).alias("__hi"))
    value = (F.col(score) - F.col("__lo")) / (F.col("__hi") - F.col("__lo") + EPS)
    return df.crossJoin(F.broadcast(bounds)).withColumn(out or score, value).drop("__lo", "__hi")


BINS = 200_000  # half units of the fifth decimal


def score_stats(df: DataFrame, score: str = "score") -> DataFrame:
    """One row of a score from 0 to 1. Scores are first summed by half units of the fifth decimal, so no more rows than those are
    shuffled. The median is exact where the middle two scores lie in different units, and else the lowest of their unit,
    which has the same first five decimals once rounded."""
    c = F.col(score)
    bins = df.where(c.isNotNull()).groupBy(F.floor(c * BINS).alias("__bin")).agg(F.count("*").alias("k"), F.sum(c).alias("s"), F.sum(c * c).alias("q"), F.min(c).alias("lo"), F.max(c).alias("hi"))
    bins = bins.withColumn("upto", F.sum("k").over(Window.orderBy("__bin")))  # one task, over the units only
    all_ = bins.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.sum("s").alias("__s"), F.sum("q").alias("__q"), F.min("lo").alias("min"), F.max("hi").alias("max"))
    # the middle two, counted from 1: the upper of a unit's own is asked for as its highest, the lower as its lowest
    first, second = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    holds = lambda x: (F.col("upto") - F.col("k") < x) & (F.col("upto") >= x)
    mid = bins.crossJoin(F.broadcast(all_.select("n"))).agg(
        F.max(F.when(holds(first), F.struct("__bin", "lo", "hi"))).alias("x"), F.max(F.when(holds(second), F.struct("__bin", "lo", "hi"))).alias("y")
    )
    median = F.when(F.col("x.__bin") == F.col("y.__bin"), F.col("x.lo")).otherwise((F.col("x.hi") + F.col("y.lo")) / 2)
    spread = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("__q") - F.col("__s") * F.col("__s") / F.col("n"), F.lit(0.0)) / (F.col("n") - 1)))
    return all_.crossJoin(F.broadcast(mid)).select((F.col("__s") / F.col("n")).alias("mean"), median.alias("median"), "min", "max", spread.alias("std"), "n")


def coverage(matches: DataFrame, left_rows: int | Column, right_rows: int | Column, a: str, b: str) -> DataFrame:
    """Matches, distinct records on either side and their share, as shown in a report."""
    d = matches.agg(F.count("*").alias("total"), F.countDistinct(a).alias("left_matched"), F.countDistinct(b).alias("right_matched"))
    pct = lambda n, of: F.format_string("%.1f%%", 100.0 * F.col(n) / of)
    return d.select("*", pct("left_matched", F.lit(left_rows)).alias("left_coverage"), pct("right_matched", F.lit(right_rows)).alias("right_coverage"))


# -- calibration ------------------------------------------------------------------------------------------------------


def confusion(scored: DataFrame, threshold: Column | float, score: str = "score", label: str = "label") -> list[Column]:
    t = F.lit(threshold) if isinstance(threshold, float) else threshold
    hit, yes = F.col(score) >= t, F.col(label) == 1
    return [F.count_if(hit & yes).alias("tp"), F.count_if(hit & ~yes).alias("fp"), F.count_if(~hit & yes).alias("fn"), F.count_if(~hit & ~yes).alias("tn")]


def threshold_sweep(labelled: DataFrame, *, low: float = 0.5, steps: int = 50, step: float = 0.01, score: str = "score") -> DataFrame:
    """Precision, recall and F1 at every threshold of the grid. Labelled scores are first counted by how many thresholds they
    reach, so no more rows than the grid has are shuffled."""
    spark = labelled.sparkSession
    at = lambda k: F.lit(low) + k * (F.lit(low + step) - F.lit(low))
    grid = spark.range(steps).select("id", at(F.col("id")).alias("threshold"))
    nearest = F.round((F.col(score) - F.lit(low)) / F.lit(step)).cast("bigint")
    reached = nearest + (F.col(score) >= at(nearest)).cast("bigint")  # the nearest threshold and all below it, or only those
    counts = labelled.groupBy(reached.alias("__reached")).agg(F.count_if(F.col("label") == 1).alias("__y"), F.count_if(F.col("label") != 1).alias("__n"))
    hit = F.col("__reached") > F.col("id")
    tot = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    m = counts.crossJoin(F.broadcast(grid)).groupBy("threshold").agg(tot("__y", hit).alias("tp"), tot("__n", hit).alias("fp"), tot("__y", ~hit).alias("fn"), tot("__n", ~hit).alias("tn"))
    p, r = F.col("tp") / (F.col("tp") + F.col("fp") + EPS), F.col("tp") / (F.col("tp") + F.col("fn") + EPS)
    m = m.withColumn("precision", p).withColumn("recall", r)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + EPS)
    return m.withColumn("f1", f1).select("threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the highest F1, the lowest threshold among equals."""
    return sweep.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def calibration_document(sweep: DataFrame) -> DataFrame:
    """One row: the sweep, which has no more rows than the grid, and its best threshold as a JSON document."""
    curve = F.sort_array(F.collect_list(F.struct("threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn")))
    best = F.max_by("threshold", F.struct("f1", (-F.col("threshold")).alias("low")))
    return sweep.agg(F.to_json(F.struct(best.alias("optimal_threshold"), curve.alias("all_results"))).alias("document"))


def batched(pairs: DataFrame, scorer: Callable[[list[str], list[str]], list[float]], a: str, b: str, *, batch: int = 64, out: str = "score") -> DataFrame:
    """Pairs with the scores of a model that takes lists of texts, in blocks of at most `batch` pairs of a task, whatever the
    size of the engine's own batches. Nulls are scored as empty texts. Rows keep all their columns."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            x, y = pdf[a].fillna("").tolist(), pdf[b].fillna("").tolist()
            score = [s for k in range(0, len(x), batch) for s in scorer(x[k : k + batch], y[k : k + batch])]
            yield pdf.assign(**{out: pd.Series(score, index=pdf.index, dtype=float)})

    kept = ", ".join(f"`{n}` {k}" for n, k in pairs.drop(out).dtypes)
    return pairs.drop(out).mapInPandas(run, f"{kept}, {out} double")


def progress(scored: DataFrame, name: str = "scored", score: str = "score") -> tuple[DataFrame, Observation]:
    """The same rows and an observation that tells, once an action on them has ended, how many were scored: a counter that
    costs no job of its own."""
    seen = Observation(name)
    return scored.observe(seen, F.count("*").alias("pairs"), F.count(score).alias("scored"), F.max(score).alias("best")), seen
