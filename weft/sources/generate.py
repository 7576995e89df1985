"""Registries made up for demonstrations: seeded by hashes, the same whatever the partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PLACES = ["Adama", "Bahir", "Chiro", "Debre", "Fiche", "Gimbi", "Hosa", "Jima", "Kombo", "Lemi", "Mizan", "Nekem", "Robe", "Sodo"]
TYPES = ["HC", "HP", "Health Center", "Health Post", "Hosp", "Gen Hosp", "Clinic", "Referral Hosp", "Med Clinic"]
REGIONS = ["North", "South", "East", "West"]


def _pick(values: list[str], salt: int, c: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(len(values))) + 1).cast("int"))


def _share(c: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(1 << 20)) / float(1 << 20)


def left_registry(spark: SparkSession, n: int = 500, seed: int = 42) -> DataFrame:
    i = F.col("id")
    return spark.range(1, n + 1).select(
        F.format_string("MFR_%06d", i).alias("facility_id"), F.concat_ws(" ", _pick(PLACES, seed, i), _pick(TYPES, seed + 1, i)).alias("facility_name"),
        _pick(REGIONS, seed + 2, i).alias("region"), F.concat(F.lit("Woreda "), F.pmod(F.xxhash64(i, F.lit(seed + 3)), F.lit(20)) + 1).alias("woreda"),
        F.concat(F.lit("Zone "), F.pmod(F.xxhash64(i, F.lit(seed + 4)), F.lit(5)) + 1).alias("zone"), _pick(TYPES, seed + 1, i).alias("facility_type"),
        (3 + 12 * _share(i, seed + 5)).alias("latitude"), (33 + 15 * _share(i, seed + 6)).alias("longitude"), _pick(["Public", "Private", "NGO"], seed + 7, i).alias("owner_type"),
    )


def right_registry(left: DataFrame, private_ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """Most of the left registry under other ids with noisy names, and private clinics the left does not have."""
    from weft.functions.text import drop_last_letter_of_first_word, expand_abbreviations

    i = F.col("facility_id")
    taken = left.where(_share(i, seed + 20) < 1 - private_ratio)
    u = _share(i, seed + 21)
    noisy = F.when(u < 0.5, expand_abbreviations(F.col("facility_name"))).when(u < 0.65, drop_last_letter_of_first_word(F.col("facility_name"))).otherwise(F.col("facility_name"))
    known = taken.withColumn("facility_name", noisy).withColumn("facility_id", F.replace(i, F.lit("MFR_"), F.lit("DHIS2_")))
    private = left.where(_share(i, seed + 22) < private_ratio).withColumns(
        {"facility_name": F.concat(F.lit("Private Clinic "), F.substring("facility_id", 5, 6)), "facility_id": F.replace(i, F.lit("MFR_"), F.lit("DHIS2_P")), "owner_type": F.lit("Private")}
    )
    return known.unionByName(private)


def labels(left: DataFrame, right: DataFrame, share: float = 0.3, seed: int = 42) -> DataFrame:
    """Pairs that are one facility (1), and pairs of different districts in one zone (0), each left row in at most one of each."""
    a = left.where(_share(F.col("facility_id"), seed + 30) < share)
    same = a.join(right.select(F.replace("facility_id", F.lit("DHIS2_"), F.lit("MFR_")).alias("facility_id"), F.col("facility_id").alias("dhis2_id")), "facility_id")
    yes = same.select(F.col("facility_id").alias("mfr_id"), "dhis2_id", F.lit(1).alias("label"))
    # one right row for each zone stands for the strangers of that zone
    other = right.groupBy("zone").agg(F.min(F.struct("facility_id", "woreda")).alias("o"))
    no = a.join(other, "zone").where(F.col("woreda") != F.col("o.woreda")).select(F.col("facility_id").alias("mfr_id"), F.col("o.facility_id").alias("dhis2_id"), F.lit(0).alias("label"))
    return yes.unionByName(no)


VARIANTS = {
    "left": {"North": "North Region", "South": "South Region", "East": "East Region", "West": "West Region"},
    "right": {"North": "North Regional Health Bureau", "South": "South Regional Health Bureau", "East": "East RHB", "West": "W. Region"},
    "third": {"North": "NORTH", "South": "south", "East": "East", "West": "West "},
}


def _spelt(c: Column, side: str) -> Column:
    return F.create_map(*[F.lit(x) for kv in VARIANTS[side].items() for x in kv])[c]


def three_registries(spark: SparkSession, n: int = 500, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(left, right, third): three registries of the same facilities, each with ids and spellings of the regions of its own;
    the third holds the health posts of the right one and names its ids there (`dhis2_id`)."""
    left = left_registry(spark, n, seed)
    right = right_registry(left, seed=seed)
    post = F.col("facility_type").isin("HP", "Health Post")
    third = right.where(post).select(
        F.replace("facility_id", F.lit("DHIS2_"), F.lit("ECHIS_")).alias("facility_id"), F.concat(F.col("facility_name"), F.lit(" (community)")).alias("facility_name"), _spelt(F.col("region"), "third").alias("region"),
        "woreda", "zone", F.col("facility_id").alias("dhis2_id"),
    )
    return left.withColumn("region", _spelt(F.col("region"), "left")), right.withColumn("region", _spelt(F.col("region"), "right")), third


def positional_labels(left: DataFrame, right: DataFrame, a_id: str, b_id: str, sample: int = 150, seed: int = 42) -> DataFrame:
    """Pairs by position in the order of ids: the first half of the sample (or of the shorter registry) row by row as 1, the
    rest of the sample a right row picked by hash as 0."""
    spark = left.sparkSession
    numbered = lambda df, i, c: df.select(F.col(i).alias(c)).orderBy(c).limit(sample).withColumn("n", F.row_number().over(Window.orderBy(c)))  # noqa: E731 - no more rows than the sample
    a, b = numbered(left, a_id, "mfr_id"), numbered(right, b_id, "dhis2_id")
    held = F.least(F.lit(sample // 2), a.select(F.floor(F.count("*") / 2)).scalar(), b.select(F.floor(F.count("*") / 2)).scalar())
    yes = a.join(b, "n").where(F.col("n") <= held).select("mfr_id", "dhis2_id", F.lit(1).alias("label"))
    size = b.select(F.count("*")).scalar()
    draw = spark.range(1, sample - sample // 2 + 1).select((F.pmod(F.xxhash64("id", F.lit(seed)), F.greatest(size, F.lit(1))) + 1).alias("n"), F.col("id"))
    other = a.where(F.col("n") > held).withColumn("id", (F.col("n") - held).cast("bigint")).drop("n").join(draw, "id").join(b, "n")
    return yes.unionByName(other.select("mfr_id", "dhis2_id", F.lit(0).alias("label")))
