"""Queries of the core operators for dirty tables: orphans, profile, nearness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.keys import strip, uid
from weft.operators import near, orphans
from weft.operators import profile as prof
from weft.queries.quality_sql import ORACLE  # noqa: F401
from weft.session import table

ZONE_PATTERN = r"^(?=.*\p{L})[\p{L}\p{M}\p{Nd} '().,/-]*$"


def _references(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities")
    k = table(spark, d, "facility_linkage")
    ts = lambda c: F.col(c).cast("timestamp")
    return m.select(F.lit("stg_mfr_facilities").alias("ref_table"), F.col("record_no").alias("ref_no"), uid(F.col("existing_dhis2_id")).alias("key"), ts("loaded_at").alias("at")).unionByName(
        k.select(F.lit("facility_linkage").alias("ref_table"), F.col("link_no").alias("ref_no"), uid(F.col("dhis2_uid")).alias("key"), ts("linked_at").alias("at"))
    )


def _orphans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    refs = _references(spark, d)
    parents = table(spark, d, "stg_dhis2_facilities").select(
        uid(F.col("dhis2_uid")).alias("key"), F.col("loaded_at").cast("timestamp").alias("first_at"), F.col("deleted_at").cast("timestamp").alias("gone_at")
    )
    rows = sum(table(spark, d, t).count() for t in ("stg_mfr_facilities", "facility_linkage", "stg_dhis2_facilities"))  # from the files' footers
    return refs, orphans.orphan_references(refs, parents, key_rows=rows)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d)[1].withColumnRenamed("key", "dhis2_uid")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(*_orphans(spark, d))


PROFILE = prof.ProfileSpec(
    "load_no",
    [
        prof.ColumnRule("catchment_population", "number", 10_000_000),
        prof.ColumnRule("number_of_inpatient_beds", "number", 2_000),
        prof.ColumnRule("zone", "text", pattern=ZONE_PATTERN),
    ],
)


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    return prof.profile(table(spark, d, "stg_mfr_facilities"), PROFILE)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = prof.changes(p4_profile(spark, d), top_columns=["zone"])
    return found.where("measure <> 'nonconforming_rate'").select(F.col("load_no").cast("int").alias("load_no"), "column_name", "measure")


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Loads in which the share of rows under a column's usual expressions moved."""
    return prof.changes(p4_profile(spark, d)).where("measure = 'nonconforming_rate'")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "mfr_sample").where("latitude between 3 and 15 and longitude between 33 and 48")
    pts = s.select(strip(F.col("facility_id")).alias("point_id"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    return near.near_pairs(pts, 100.0).select(F.col("id_a").alias("facility_id_a"), F.col("id_b").alias("facility_id_b"))


SECTORS, HOLE = 12, 0.2


def _outlines(pts: DataFrame) -> DataFrame:
    """(region_id, ring, holes): around the middle of each zone's positions a concave outline, in each of twelve directions
    nine tenths as far as its farthest position there, with a hole in the middle."""
    mid = pts.groupBy("zone").agg(F.avg("lon").alias("clon"), F.avg("lat").alias("clat"))
    p = pts.join(mid, "zone").withColumns({"dx": F.col("lon") - F.col("clon"), "dy": F.col("lat") - F.col("clat")})
    p = p.withColumn("sector", F.pmod(F.floor(F.degrees(F.atan2("dy", "dx")) * SECTORS / 360), F.lit(SECTORS)).cast("int"))
    far = p.groupBy("zone", "clon", "clat", "sector").agg(F.max(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))).alias("r"))
    # no more than one entry for each direction
    shape = far.groupBy("zone", "clon", "clat").agg(F.map_from_entries(F.collect_list(F.struct("sector", "r"))).alias("far"), F.when(F.count("*") == SECTORS, F.min("r")).otherwise(0.0).alias("least"))
    out = lambda s: F.greatest(F.coalesce(F.try_element_at("far", s), F.lit(0.0)) * 0.9, F.lit(0.001))
    corner = lambda r, turn: F.array(F.col("clon") + r * F.cos(turn), F.col("clat") + r * F.sin(turn))
    ring = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SECTORS - 1)), lambda s: corner(out(s), F.radians((s + 0.5) * (360 / SECTORS)))))
    inner = F.greatest(F.col("least") * 0.9, F.lit(0.001)) * HOLE
    hole = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: corner(inner, F.radians(s * 90.0))))
    return shape.select(F.col("zone").alias("region_id"), ring.alias("ring"), F.array(hole).alias("holes"))


def p7_regions(spark: SparkSession, d: str) -> DataFrame:
    """How many surveyed facilities lie in the outline of each zone's facilities."""
    s = table(spark, d, "mfr_sample").where("latitude between 3 and 15 and longitude between 33 and 48")
    pts = s.select(strip(F.col("facility_id")).alias("point_id"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"), strip(F.col("zone")).alias("zone")).distinct()
    inside = near.containing_regions(pts, _outlines(pts.where("zone <> ''")))
    return inside.groupBy(F.col("region_id").alias("zone")).agg(F.count("*").alias("facilities"))


QUERIES = {f.__name__: f for f in (p2_found, p2_report, p4_found, p4_profile, p4_coverage, p7_found, p7_regions)}
