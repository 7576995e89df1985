"""Queries of the star schema, projections, aggregates, ranks and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import text as t
from weft.operators import judge, registry
from weft.plans.models import CAPACITY, renamed, star_schema
from weft.session import table
from weft.sources.files import ping, upsert


def _model(name: str):
    return lambda spark, d: star_schema(spark, lambda n: table(spark, d, n)).ref(name)


def p01_staging_rename(spark: SparkSession, d: str) -> DataFrame:
    return renamed(table(spark, d, "facility_linkage"), {"mfr_id": "mfr_id", "mfr_name": "mfr_name", "dhis2_uid": "llm_dhis2_uid", "confidence": "llm_confidence", "reason": "llm_reason"})


def p02_rename_known(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").withColumnsRenamed({"n_name": "name", "n_nationkey": "id", "not_there": "x"}).drop("wereda")


def p05_p06_resolved_columns(spark: SparkSession, d: str) -> DataFrame:
    """The first column a table has of several names, and a default where it has none."""
    u = table(spark, d, "stg_dhis2_facilities")
    district = registry.first_column(u, ["woreda", "wereda", "district"])
    u = registry.ensure_column(u, "kebele")
    return u.select("record_no", F.col(district).alias("woreda"), "kebele")


def p10_any_known(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "facility_linkage").where(F.col("dhis2_uid").isNotNull() | F.col("reason").isNotNull()).select("link_no", "dhis2_uid", "reason")


def p11_p12_filters(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities")
    return m.where(F.col("facility_type").isin("Referral Hospital", "General Hospital") & (F.col("source_system") == "registry_form") & F.col("existing_dhis2_id").isNull()).select("record_no", "facility_name")


def p22_p23_fill_and_complete(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "stg_dhis2_facilities").select("dhis2_name", "regional", "zonal", "wereda")
    filled = u.fillna("unknown", ["regional", "zonal"])
    return u.agg(F.count("*").alias("rows")).crossJoin(u.dropna().agg(F.count("*").alias("complete"))).crossJoin(filled.agg(F.count_if(F.col("regional") == "unknown").alias("unknown_regions")))


def p25_p26_bands(spark: SparkSession, d: str) -> DataFrame:
    """Bands of a score, the id kept only above none; the score is each customer's balance over the largest."""
    c = table(spark, d, "customer")
    c = c.crossJoin(F.broadcast(c.agg(F.max("c_acctbal").alias("top")))).withColumn("score", F.round(F.col("c_acctbal") / F.col("top"), 6))
    c = c.withColumn("band", t.confidence_band(F.col("score")))
    return c.select("c_custkey", "score", "band", F.when(F.col("band") != "none", F.col("c_name")).alias("uid"))


def a01_a02_a15_counts(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities")
    return m.agg(F.count("*").alias("rows"), F.countDistinct("mfr_id").alias("facilities"), F.countDistinct("woreda").alias("woredas"), F.count_if(F.col("existing_dhis2_id").isNull()).alias("no_reference"))


def a03_stats(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    g = table(spark, d, "events").groupBy("event_type").agg(F.avg(v).alias("mean"), F.median(v).alias("median"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev(v).alias("std"))
    return g.select("event_type", *[F.round(c, 6).alias(c) for c in ("mean", "median", "min", "max", "std")])


def a06_top_groups(spark: SparkSession, d: str) -> DataFrame:
    return registry.group_sizes(table(spark, d, "stg_mfr_facilities"), "woreda", 10)


def a07_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return registry.group_sizes(table(spark, d, "stg_mfr_facilities"), "facility_type")


def a08_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return registry.group_sizes(table(spark, d, "facility_linkage"), "confidence")


def a16_coverage(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "facility_linkage")
    n = table(spark, d, "stg_mfr_facilities").agg(F.countDistinct("mfr_id").alias("n"))
    got = k.where(F.col("dhis2_uid").isNotNull()).agg(F.countDistinct("mfr_id").alias("linked"))
    return got.crossJoin(n).select("linked", F.col("n").alias("facilities"), t.percent(F.col("linked"), F.col("n")).alias("coverage"))


def a18_describe(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("value").summary("count", "mean", "min", "max").select("summary", F.round(F.col("value").cast("double"), 6).alias("v"))


def w04_first_row(spark: SparkSession, d: str) -> DataFrame:
    """The first uid under each name, in the order of delivery."""
    u = table(spark, d, "stg_dhis2_facilities").where(F.col("dhis2_name").isNotNull())
    return u.groupBy("dhis2_name").agg(F.min_by("dhis2_uid", F.struct("record_no", "dhis2_uid")).alias("dhis2_uid"))


def w05_latest(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities").select("mfr_id", "record_no", "facility_name", "loaded_at")
    return registry.latest(m, "mfr_id", ["loaded_at", "record_no"])


def snk11_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The loads up to the sixth as the table at hand, the later ones put into it."""
    m = table(spark, d, "stg_mfr_facilities").select("mfr_id", "record_no", "load_no", "region", "loaded_at")
    return upsert(m.where("load_no <= 6"), m.where("load_no > 6"), "mfr_id", "record_no").select("mfr_id", "record_no", "region")


def t01_nlargest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


def t02_nsmallest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy("o_totalprice", "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


def t04_p24_preview(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "facility_linkage").orderBy("link_no").limit(20).select("link_no", "mfr_id", "dhis2_uid")


def u01_union_missing(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True)


def u02_u03_unions(spark: SparkSession, d: str) -> DataFrame:
    """Distinct links of both tables that hold links."""
    a = table(spark, d, "stg_mfr_facilities").select("mfr_id", F.col("existing_dhis2_id").alias("dhis2_uid"))
    return a.unionByName(table(spark, d, "facility_linkage").select("mfr_id", "dhis2_uid")).distinct()


def src07_ping(spark: SparkSession, d: str) -> DataFrame:
    return ping(spark)


def f19_json(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.to_json(F.struct("event_type", "user_id")).alias("j"))


def g08_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts written as JSON and read back, the word null taken as none."""
    k = table(spark, d, "facility_linkage")
    j = F.to_json(F.struct(F.col("dhis2_uid").alias("match_dhis2_uid"), "confidence", "reason"))
    v = k.select("link_no", judge.parse_verdict(j).alias("v"))
    return v.select("link_no", F.when(~F.lower(F.trim("v.match_dhis2_uid")).isin("null", "none", ""), F.col("v.match_dhis2_uid")).alias("uid"), "v.confidence")


def c07_streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Events counted by hour and type, as the stream's windows are."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, d, "events").groupBy(F.window(ts, "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


QUERIES = {
    "p19_p20_fact_linkage_status": _model("fact_facility_capacity"),
    "a04_dim_region": _model("dim_region"),
    "a04_dim_ownership": _model("dim_ownership_type"),
    "a04_dim_triple": _model("dim_zone_woreda"),
    **{
        f.__name__: f
        for f in (
            p01_staging_rename, p02_rename_known, p05_p06_resolved_columns, p10_any_known, p11_p12_filters, p22_p23_fill_and_complete, p25_p26_bands, a01_a02_a15_counts, a03_stats,
            a06_top_groups, a07_group_sizes, a08_value_counts, a16_coverage, a18_describe, w04_first_row, w05_latest, snk11_upsert, t01_nlargest, t02_nsmallest, t04_p24_preview,
            u01_union_missing, u02_u03_unions, src07_ping, f19_json, g08_verdicts, c07_streamed_windows,
        )
    },
}
# the p10_ of problem 10 is another: this one goes by its operator's full name
QUERIES["proj_p10_any_known"] = QUERIES.pop("p10_any_known")

_M = "stg_mfr_facilities"
_TOP = "SELECT {0}, count(*) AS n FROM {1} WHERE {0} IS NOT NULL GROUP BY 1 ORDER BY n DESC, {0}"

ORACLE = {
    "p19_p20_fact_linkage_status": f"""SELECT m.mfr_id, facility_name, facility_type, ownership, region, zone, woreda, {', '.join(CAPACITY)},
        coalesce(nullif(existing_dhis2_id, ''), dhis2_uid) AS dhis2_uid,
        CASE WHEN nullif(existing_dhis2_id, '') IS NOT NULL THEN 'linked_original' WHEN dhis2_uid IS NOT NULL THEN 'linked_llm' ELSE 'unlinked' END AS linkage_status,
        confidence AS llm_confidence, reason AS llm_reason
      FROM {_M} m LEFT JOIN facility_linkage k ON m.mfr_id = k.mfr_id""",
    "a04_dim_region": f"SELECT DISTINCT region FROM {_M} WHERE region IS NOT NULL",
    "a04_dim_ownership": f"SELECT DISTINCT ownership FROM {_M} WHERE ownership IS NOT NULL",
    "a04_dim_triple": f"SELECT DISTINCT region, zone, woreda FROM {_M} WHERE zone IS NOT NULL",
    "p01_staging_rename": "SELECT mfr_id, mfr_name, dhis2_uid AS llm_dhis2_uid, confidence AS llm_confidence, reason AS llm_reason FROM facility_linkage",
    "p02_rename_known": "SELECT n_nationkey AS id, n_name AS name, n_regionkey FROM nation",
    "p05_p06_resolved_columns": "SELECT record_no, wereda AS woreda, 'Unknown' AS kebele FROM stg_dhis2_facilities",
    "proj_p10_any_known": "SELECT link_no, dhis2_uid, reason FROM facility_linkage WHERE dhis2_uid IS NOT NULL OR reason IS NOT NULL",
    "p11_p12_filters": f"SELECT record_no, facility_name FROM {_M} WHERE facility_type IN ('Referral Hospital', 'General Hospital') AND source_system = 'registry_form' AND existing_dhis2_id IS NULL",
    "p22_p23_fill_and_complete": """SELECT count(*) AS rows, count(*) FILTER (dhis2_name IS NOT NULL AND regional IS NOT NULL AND zonal IS NOT NULL AND wereda IS NOT NULL) AS complete,
        count(*) FILTER (coalesce(regional, 'unknown') = 'unknown') AS unknown_regions FROM stg_dhis2_facilities""",
    "p25_p26_bands": """WITH s AS (SELECT c_custkey, c_name, round(c_acctbal / (SELECT max(c_acctbal) FROM customer), 6) AS score FROM customer),
      b AS (SELECT *, CASE WHEN score >= 0.9 THEN 'high' WHEN score >= 0.8 THEN 'medium' WHEN score >= 0.7 THEN 'low' ELSE 'none' END AS band FROM s)
      SELECT c_custkey, score, band, CASE WHEN band <> 'none' THEN c_name END AS uid FROM b""",
    "a01_a02_a15_counts": f"SELECT count(*) AS rows, count(DISTINCT mfr_id) AS facilities, count(DISTINCT woreda) AS woredas, count(*) FILTER (existing_dhis2_id IS NULL) AS no_reference FROM {_M}",
    "a03_stats": "SELECT event_type, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(min(value), 6) AS min, round(max(value), 6) AS max, round(stddev_samp(value), 6) AS std FROM events GROUP BY 1",
    "a06_top_groups": _TOP.format("woreda", _M) + " LIMIT 10",
    "a07_group_sizes": _TOP.format("facility_type", _M),
    "a08_value_counts": _TOP.format("confidence", "facility_linkage"),
    "a16_coverage": f"""SELECT linked, facilities, printf('%.1f%%', CASE WHEN facilities > 0 THEN 100.0 * linked / facilities ELSE 0 END) AS coverage
      FROM (SELECT count(DISTINCT mfr_id) AS linked FROM facility_linkage WHERE dhis2_uid IS NOT NULL), (SELECT count(DISTINCT mfr_id) AS facilities FROM {_M})""",
    "a18_describe": """SELECT 'count' AS summary, count(value)::DOUBLE AS v FROM events UNION ALL SELECT 'mean', round(avg(value), 6) FROM events
      UNION ALL SELECT 'min', round(min(value), 6) FROM events UNION ALL SELECT 'max', round(max(value), 6) FROM events""",
    "w04_first_row": "SELECT dhis2_name, dhis2_uid FROM stg_dhis2_facilities WHERE dhis2_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dhis2_name ORDER BY record_no, dhis2_uid) = 1",
    "w05_latest": f"SELECT DISTINCT mfr_id, record_no, facility_name, loaded_at FROM {_M} QUALIFY row_number() OVER (PARTITION BY mfr_id ORDER BY loaded_at DESC, record_no DESC) = 1",
    "snk11_upsert": f"SELECT mfr_id, record_no, region FROM {_M} QUALIFY row_number() OVER (PARTITION BY mfr_id ORDER BY record_no DESC, load_no > 6 DESC) = 1",
    "t01_nlargest": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "t02_nsmallest": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10",
    "t04_p24_preview": "SELECT link_no, mfr_id, dhis2_uid FROM facility_linkage ORDER BY link_no LIMIT 20",
    "u01_union_missing": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
    "u02_u03_unions": f"SELECT mfr_id, existing_dhis2_id AS dhis2_uid FROM {_M} UNION SELECT mfr_id, dhis2_uid FROM facility_linkage",
    "src07_ping": "SELECT 1 AS ok",
    "f19_json": """SELECT event_id, (props->>'$.k')::BIGINT AS k, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS j FROM events""",
    "g08_verdicts": "SELECT link_no, CASE WHEN lower(trim(dhis2_uid)) NOT IN ('null', 'none', '') THEN dhis2_uid END AS uid, confidence FROM facility_linkage",
    "c07_streamed_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
