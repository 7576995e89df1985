"""Column profile by load, with expressions induced by minimum description length.

Every distinct value of a column is written as a string of character classes. Expressions form a ladder from that
string itself over runs and words to "anything"; an expression on a rung replaces those below it where naming it once
and spelling its values costs fewer bits than naming them one by one. The ladder is climbed by group-bys over all
distinct values, so nothing is gathered in one place.

Nulls and blanks are counted apart and take no part in the induction. An empty table gives an empty profile. Repeated
rows count as often as they come. Very long values count by their characters like any other.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.functions.keys import strip
from weft.session import cut

NAME_BITS = 8.0  # a character of an expression
DIGIT, UPPER, LETTER, WORD, ANY = 3.33, 4.71, 4.71, 6.0, 7.0  # a character of its class
RUN_BITS = 4.0  # the length of a run
PLUS, STAR = "\ue000", "\ue001"  # for + and * as typed, of the block for private use


@dataclass(frozen=True)
class ColumnRule:
    """What counts as a valid value. kind: number (digits only, at most `most`) or text (matches `pattern`)."""

    column: str
    kind: str = "text"
    most: int | None = None
    pattern: str | None = None

    def shaped(self, v: Column) -> Column:
        """Whether a value has a valid shape."""
        return F.coalesce(v.rlike(r"^\p{Nd}+$" if self.kind == "number" else self.pattern or ""), F.lit(False))

    def bounded(self, v: Column) -> Column:
        """Whether a value of valid shape is valid: what no expression can tell, a number's size and its digits' script."""
        if self.kind != "number":
            return F.lit(True)
        ok = v.rlike("^[0-9]+$")
        if self.most is not None:
            ok = ok & (F.regexp_replace(v, "^0+(?=.)", "").try_cast("decimal(38,0)") <= self.most)
        return F.coalesce(ok, F.lit(False))


@dataclass(frozen=True)
class ProfileSpec:
    load: str
    rules: list[ColumnRule] = field(default_factory=list)


def value_counts(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """(column_name, load_no, value, n): one row per distinct stripped value, null for null or blank."""
    pairs = F.array(*[F.struct(F.lit(r.column).alias("column_name"), F.col(r.column).cast("string").alias("raw")) for r in spec.rules])
    long = df.select(F.col(spec.load).alias("load_no"), F.explode(pairs).alias("p")).select("load_no", "p.*")
    # counted as delivered first: the regex engine then sees each distinct value once
    raw = long.groupBy("column_name", "load_no", "raw").agg(F.count("*").alias("n"))
    v = strip(F.col("raw"))
    return raw.select("column_name", "load_no", F.when(v != "", v).alias("value"), "n").groupBy("column_name", "load_no", "value").agg(F.sum("n").alias("n"))


def _classes(v: Column) -> Column:
    # letters first, so that the letters that stand for the classes mean nothing else; + and * as typed stand aside
    c = F.regexp_replace(F.translate(v, "+*", PLUS + STAR), r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]", "a")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\p{M}", "m"), r"\p{Lu}", "A"), r"\p{Nd}", "0")


def _squeeze(c: Column) -> Column:
    for k in ("0", "A", "a", "m", " "):
        c = F.regexp_replace(c, f"{k}{k}+", f"{k}+") if k != " " else F.regexp_replace(c, " +", " ")
    return c


def induce(values: DataFrame) -> DataFrame:
    """(column_name, value, expression, rung) for distinct (column_name, value): the cheapest cover of each column."""
    v = values.where("value is not null").select("column_name", "value").distinct()
    exact = _classes(F.col("value"))
    v = v.select("column_name", "value", exact.alias("exact"))
    v = v.select("*", _squeeze(F.col("exact")).alias("runs"))
    v = v.select("*", F.regexp_replace(F.regexp_replace("runs", r"(A\+?|a\+?)+", "w+"), r"w\+( w\+)+", "w+( w+)*").alias("words"))
    count = lambda k: F.length("exact") - F.length(F.regexp_replace("exact", k, ""))
    digits, upper, lower, size = count("0"), count("A"), count("a") + count("m"), F.length("exact")
    runs = F.length(F.regexp_replace("runs", r"[^+]", ""))
    base = digits * DIGIT + upper * UPPER + lower * LETTER
    v = v.select(
        "*",
        base.alias("b0"),
        (base + runs * RUN_BITS).alias("b1"),
        (digits * DIGIT + (upper + lower) * WORD + (runs + 1) * RUN_BITS).alias("b2"),
        (size * ANY + RUN_BITS).alias("b3"),
    )
    own = lambda rung, bits: F.least(F.length(rung) * F.lit(NAME_BITS) + F.sum(bits), F.sum("below"))
    keep = lambda rung, bits: (F.length(rung) * F.lit(NAME_BITS) + F.sum(bits) <= F.sum("below")).alias("own")
    n0 = v.groupBy("column_name", "exact", "runs", "words").agg(
        (F.length("exact") * NAME_BITS + F.sum("b0")).alias("below"), *[F.sum(b).alias(b) for b in ("b1", "b2", "b3")]
    )
    n1 = n0.groupBy("column_name", "runs", "words").agg(own(F.col("runs"), "b1").alias("cost"), keep(F.col("runs"), "b1"), F.sum("b2").alias("b2"), F.sum("b3").alias("b3"))
    n2 = n1.withColumnRenamed("cost", "below").withColumnRenamed("own", "own1").groupBy("column_name", "words").agg(
        own(F.col("words"), "b2").alias("cost"), keep(F.col("words"), "b2"), F.sum("b3").alias("b3")
    )
    n3 = n2.withColumnRenamed("cost", "below").groupBy("column_name").agg((F.lit(2 * NAME_BITS) + F.sum("b3") <= F.sum("below")).alias("own3"))
    chosen = (
        v.select("column_name", "value", "exact", "runs", "words")
        .join(n1.select("column_name", "runs", F.col("own").alias("own1")), ["column_name", "runs"])
        .join(n2.select("column_name", "words", F.col("own").alias("own2")), ["column_name", "words"])
        .join(n3, ["column_name"])
    )
    rung = F.when(F.col("own3"), "any").when(F.col("own2"), "words").when(F.col("own1"), "runs").otherwise("exact")
    lit = lambda c: F.regexp_replace(c, r"([\\.\[\](){}^$|?])", r"\\$1")
    classes = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "m", r"\\p{M}"), "0", r"\\d"), "A", r"\\p{Lu}"), r"(?<!p\{)a", r"\\p{L}")
    shown = (
        F.when(F.col("own3"), F.lit(".*"))
        .when(F.col("own2"), F.regexp_replace(F.regexp_replace("words", "w", r"\\p{L}"), "0", r"\\d"))
        .when(F.col("own1"), classes(lit(F.col("runs"))))
        .otherwise(classes(lit(F.col("exact"))))
    )
    shown = F.replace(F.replace(shown, F.lit(PLUS), F.lit(r"\+")), F.lit(STAR), F.lit(r"\*"))
    return chosen.select("column_name", "value", shown.alias("expression"), rung.alias("rung"))


def _medians(valid: DataFrame, bucket: int = 1 << 12) -> DataFrame:
    """(column_name, load_no, median): mean of the middle two, by a histogram and then inside its middle buckets only."""
    b = valid.groupBy("column_name", "load_no", F.floor(F.col("number") / bucket).alias("bucket")).agg(F.sum("n").alias("n"))
    over = Window.partitionBy("column_name", "load_no")
    upto = F.sum("n").over(over.orderBy("bucket"))
    b = b.select("*", upto.alias("upto"), F.sum("n").over(over).alias("total"))
    lo, hi = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)  # 0-based ranks of the middle two
    b = b.select("*", (F.col("upto") - F.col("n")).alias("before"), lo.alias("lo"), hi.alias("hi"))
    mid = b.where("(lo >= before and lo < upto) or (hi >= before and hi < upto)").select("column_name", "load_no", "bucket", "before", "lo", "hi")
    v = valid.groupBy("column_name", "load_no", "number").agg(F.sum("n").alias("n")).withColumn("bucket", F.floor(F.col("number") / bucket))
    inside = Window.partitionBy("column_name", "load_no", "bucket").orderBy("number")
    v = v.join(mid, ["column_name", "load_no", "bucket"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))
    v = v.withColumn("from", F.col("upto") - F.col("n"))
    pick = lambda r: F.max(F.when((F.col(r) >= F.col("from")) & (F.col(r) < F.col("upto")), F.col("number")))
    return v.groupBy("column_name", "load_no").agg(((pick("lo") + pick("hi")) / 2).alias("median"))


def profile(df: DataFrame, spec: ProfileSpec, *, common: float = 0.01) -> DataFrame:
    """One row per column and load: counts, null and violation rates, distinct values, range, median, most frequent
    valid value, and the share of rows under the induced expressions that hold at least `common` of a column's values."""
    # read by the induction, the medians and the rates: distinct values, far fewer than rows
    counts = cut(value_counts(df, spec), "values")
    by_column = lambda test: reduce(lambda other, r: F.when(F.col("column_name") == r.column, test(r)).otherwise(other), spec.rules, F.lit(False))
    numeric = F.col("column_name").isin([r.column for r in spec.rules if r.kind == "number"])
    shapes = cut(induce(counts), "expressions")
    # whether an expression conforms to its column's rule is told by one of its values, since all of them have the same
    # classes and signs in it; only of "any" each value is asked
    one = shapes.groupBy("column_name", "expression", "rung").agg(F.min("value").alias("one"))
    conform = one.select("column_name", "expression", F.when(F.col("rung") != "any", by_column(lambda r: r.shaped(F.col("one")))).alias("conforms"))
    counts = counts.join(shapes, ["column_name", "value"], "left").join(conform, ["column_name", "expression"], "left")
    shaped = F.coalesce("conforms", by_column(lambda r: r.shaped(F.col("value"))))
    counts = counts.withColumn("valid", F.col("value").isNotNull() & shaped & by_column(lambda r: r.bounded(F.col("value"))))
    counts = counts.withColumn("number", F.when(numeric & F.col("valid"), F.col("value").try_cast("decimal(38,0)").try_cast("bigint")))
    kept = counts.groupBy("column_name", "expression").agg(F.sum("n").alias("n")).where("expression is not null")
    kept = kept.withColumn("common", F.col("n") >= common * F.sum("n").over(Window.partitionBy("column_name"))).select("column_name", "expression", "common")
    counts = counts.join(kept, ["column_name", "expression"], "left")
    rows = F.sum("n")
    share = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    base = counts.groupBy("column_name", "load_no").agg(
        rows.alias("rows"),
        (share(F.col("value").isNull()) / rows).alias("null_rate"),
        (share(F.col("value").isNotNull() & ~F.col("valid")) / rows).alias("violation_rate"),
        (share(F.col("value").isNotNull() & ~F.coalesce("common", F.lit(False))) / rows).alias("nonconforming_rate"),
        F.count("value").alias("distinct_values"),
        F.countDistinct("expression").alias("expressions"),
        F.min("number").alias("least"),
        F.max("number").alias("most"),
        F.max(F.when(F.col("valid"), F.struct("n", "value"))).alias("top"),
    )
    medians = _medians(counts.where("number is not null"))
    return base.join(medians, ["column_name", "load_no"], "left").select(
        "column_name", "load_no", "rows", "null_rate", "violation_rate", "nonconforming_rate", "distinct_values", "expressions", "least", "most", "median",
        F.col("top.value").alias("top_value"), (F.coalesce("top.n", F.lit(0)) / F.col("rows")).alias("top_share"),
    )


def changes(prof: DataFrame, *, rate: float = 0.1, ratio: float = 1.8, top_columns: list[str] = ()) -> DataFrame:
    """(load_no, column_name, measure) where a load differs from the one before it: rates by more than `rate`, medians
    by more than `ratio` times either way, the top share (of the named columns) by more than `rate`."""
    prof = cut(prof, "profile")
    before = prof.select("column_name", (F.col("load_no") + 1).alias("load_no"), *[F.col(c).alias(f"{c}_0") for c in ("null_rate", "violation_rate", "median", "top_share", "nonconforming_rate")])
    both = prof.join(before, ["column_name", "load_no"])
    far = lambda c: F.abs(F.col(c) - F.col(f"{c}_0")) > rate
    hits = F.array_compact(
        F.array(
            F.when(far("null_rate"), F.lit("null_rate")),
            F.when(far("violation_rate"), F.lit("violation_rate")),
            F.when((F.col("median") > F.col("median_0") * ratio) | (F.col("median_0") > F.col("median") * ratio), F.lit("median")),
            F.when(far("top_share") & F.col("column_name").isin(list(top_columns)), F.lit("top_share")),
            F.when(far("nonconforming_rate"), F.lit("nonconforming_rate")),
        )
    )
    return both.select("load_no", "column_name", F.explode(hits).alias("measure"))
