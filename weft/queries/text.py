"""Queries of the text functions, over the registries' own names and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions import scripts
from weft.functions import text as t
from weft.session import table

NAMES = ("stg_mfr_facilities", "facility_name"), ("stg_dhis2_facilities", "dhis2_name")


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Every name of both registries as delivered."""
    a, b = (table(spark, d, n).select("record_no", F.lit(n).alias("src"), F.col(c).alias("name")) for n, c in NAMES)
    return a.unionByName(b)


def _of(fn):
    return lambda spark, d: _names(spark, d).select("src", "record_no", fn(F.col("name")).alias("out"))


def _regions(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "stg_mfr_facilities").select(F.lit("stg_mfr_facilities").alias("src"), "record_no", F.col("region").alias("v"))
    return a.unionByName(table(spark, d, "stg_dhis2_facilities").select(F.lit("stg_dhis2_facilities").alias("src"), "record_no", F.col("regional").alias("v")))


def f08_geo(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).select("src", "record_no", t.normalize_geo(F.col("v")).alias("out"))


def f10_region(spark: SparkSession, d: str) -> DataFrame:
    return _regions(spark, d).select("src", "record_no", t.normalize_region(F.col("v")).alias("out"))


def f11_region_map(spark: SparkSession, d: str) -> DataFrame:
    """The distinct regions of both registries under the fixed table of the regions' spellings, null for those it lacks."""
    m, u = table(spark, d, "stg_mfr_facilities").select("region"), table(spark, d, "stg_dhis2_facilities").select(F.col("regional").alias("region"))
    every = m.unionByName(u).unionByName(spark.createDataFrame([(k,) for k in t.REGION_MAP], "region string")).where("region is not null").distinct()
    return every.select("region", t.canonical_region(F.col("region")).alias("mapped"))


def f11_canonical_region(spark: SparkSession, d: str) -> DataFrame:
    known = {f"{r}{e}": k for r, k in (("Tase Fisharu", "tase fisharu"), ("Kechipa", "kechipa"), ("Logida", "logida"), ("Semene", "semene")) for e in (" Region", " Regional Health Bureau")}
    return _regions(spark, d).select("src", "record_no", t.lookup(F.col("v"), known).alias("mapped"), t.lookup_or_self(F.col("v"), known).alias("or_self"))


def f12_pair_text(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities")
    places = {c: F.col(c) for c in ("woreda", "region", "zone")}
    return m.select("record_no", t.pair_text(F.coalesce("facility_name", F.lit("")), places).alias("out"))


def f13_reason_text(spark: SparkSession, d: str) -> DataFrame:
    """Bands and reasons for the score that a judgement's text carries."""
    k = table(spark, d, "facility_linkage")
    score = F.regexp_extract(F.coalesce("reason", F.lit("")), r"([01]\.[0-9]+)", 1).try_cast("double")
    k = k.select("link_no", score.alias("score")).withColumn("band", t.confidence_band(F.col("score")))
    return k.select("link_no", "band", t.reason_text(F.col("score"), F.col("band")).alias("reason_text"))


def f15_padded_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", t.padded_id("MFR_", F.col("c_custkey")).alias("padded"), F.replace(t.padded_id("MFR_", F.col("c_custkey")), F.lit("MFR_"), F.lit("DHIS2_")).alias("other"))


def f20_run_stamp(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"))


def proj_p15_blank_to_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "stg_mfr_facilities").select("record_no", t.blank_to_null(F.col("existing_dhis2_id")).alias("existing_dhis2_id"), t.blank_to_null(F.col("zone")).alias("zone"))


def f07_preprocess(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "stg_mfr_facilities").select("record_no", "facility_name", "region", "zone", "woreda")
    return t.preprocess(m).drop("facility_name", "region", "zone", "woreda")


def f05_metaphone(spark: SparkSession, d: str) -> DataFrame:
    return _names(spark, d).select("src", "record_no", t.metaphone_key()(F.col("name")).alias("out"))


QUERIES = {
    "f01_transliterate": _of(t.transliterate_amharic),
    "f02_expand_abbrev": _of(t.expand_abbreviations),
    "f03_normalize": _of(t.normalize_text),
    "f04_soundex": _of(t.phonetic_key),
    "f06_prefix_key": _of(t.prefix_key),
    "f09_clean_name": _of(t.clean_facility_name),
    "f16_drop_letter": _of(t.drop_last_letter_of_first_word),
    **{f.__name__: f for f in (f05_metaphone, f07_preprocess, f08_geo, f10_region, f11_region_map, f11_canonical_region, f12_pair_text, f13_reason_text, f15_padded_id, f20_run_stamp, proj_p15_blank_to_null)},
}

# -- the same in SQL --------------------------------------------------------------------------------------------------

_NAMES = "(SELECT record_no, 'stg_mfr_facilities' AS src, facility_name AS name FROM stg_mfr_facilities UNION ALL SELECT record_no, 'stg_dhis2_facilities', dhis2_name FROM stg_dhis2_facilities)"
_REGIONS = "(SELECT record_no, 'stg_mfr_facilities' AS src, region AS v FROM stg_mfr_facilities UNION ALL SELECT record_no, 'stg_dhis2_facilities', regional FROM stg_dhis2_facilities)"
WS = r"[\s\x{00A0}\p{Z}]+"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_transliterate(c: str) -> str:
    out = f"coalesce({c}, '')"
    for a, b in t.AMHARIC:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


def sql_expand(c: str) -> str:
    # word boundaries of all scripts, spelt out: RE2 knows those of ASCII only
    out = f"coalesce({c}, '')"
    for a, b in t.ABBREVIATIONS:
        e = a.replace(".", r"\.")
        out = rf"regexp_replace({out}, {q(rf'\b{e}\b')}, {q(b)}, 'gi')"
    return out


def sql_normalize(c: str) -> str:
    out = rf"lower(regexp_replace(coalesce({c}, ''), '{WS}', ' ', 'g'))"
    return rf"trim(regexp_replace(regexp_replace({out}, '[.,\-/():]', ' ', 'g'), '{WS}', ' ', 'g'))"


def sql_romanise(c: str) -> str:
    out = c
    for xs, v in scripts.rows():
        if v:
            out = rf"regexp_replace({out}, '([{xs}])', '\1{v}', 'g')"
    own, consonants, bare = scripts.letters()
    out = f"translate({out}, '{own + bare}', '{consonants}')"
    for one, two in scripts.DOUBLE.items():
        out = f"replace({out}, '{one}', '{two}')"
    return out


def sql_soundex(c: str) -> str:
    """Soundex by rewriting: H and W fall out after the first letter, letters become digits, runs shrink, vowels go."""
    s = rf"regexp_replace(upper({c}), '[^A-Z]', 'A', 'g')"
    first = f"substr({s}, 1, 1)"
    rest = rf"(substr({s}, 1, 1) || regexp_replace(substr({s}, 2), '[HW]', '', 'g'))"
    code = rf"regexp_replace(translate({rest}, 'BFPVCGJKQSXZDTLMNRAEIOUYHW', '11112222222233455600000077'), '[^0-9]', '0', 'g')"
    for k in "1234567":
        code = f"regexp_replace({code}, '{k}+', '{k}', 'g')"
    return rf"rpad(left({first} || regexp_replace(substr({code}, 2), '[^1-6]', '', 'g'), 4), 4, '0')"


def sql_phonetic(c: str) -> str:
    p = f"trim(coalesce({c}, ''))"
    return f"CASE WHEN regexp_matches({p}, '^[A-Za-z]') THEN {sql_soundex(p)} ELSE left({p}, 4) END"


def sql_geo(c: str) -> str:
    words = "|".join(sorted(t.GEO_NOISE, key=len, reverse=True))
    out = rf"regexp_replace(regexp_replace(trim(lower(coalesce({c}, ''))), '\b(?:{words})\b', '', 'gi'), '[\s\p{{Z}}\-]+', '', 'g')"
    for a, b in t.GEO_FIXES:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return f"CASE WHEN {out} = '' THEN 'unknown' ELSE {out} END"


def sql_clean(c: str) -> str:
    out = f"trim(lower(coalesce({c}, '')))"
    for s in t.NAME_SUFFIXES:
        out = rf"regexp_replace({out}, '\b{s}\b', '', 'gi')"
    return rf"trim(regexp_replace({out}, '{WS}', ' ', 'g'))"


def _sel(e: str, src: str = _NAMES) -> str:
    return f"SELECT src, record_no, {e} AS out FROM {src}"


_REGION = "v"
for _e in t.REGION_ENDINGS:
    _REGION = f"replace({_REGION}, {q(_e)}, '')"
_REGION = f"CASE trim({_REGION}) " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in t.REGION_FIXES.items()) + f" ELSE trim({_REGION}) END"
_KNOWN = "CASE " + " ".join(f"WHEN v IN ({q(r + ' Region')}, {q(r + ' Regional Health Bureau')}) THEN {q(r.lower())}" for r in ("Tase Fisharu", "Kechipa", "Logida", "Semene")) + " END"
_SCORE = "try_cast(nullif(regexp_extract(coalesce(reason, ''), '([01]\\.[0-9]+)', 1), '') AS DOUBLE)"
_BAND = "CASE WHEN score >= 0.9 THEN 'high' WHEN score >= 0.8 THEN 'medium' WHEN score >= 0.7 THEN 'low' ELSE 'none' END"

ORACLE = {
    "f01_transliterate": _sel(sql_transliterate("name")),
    "f02_expand_abbrev": _sel(sql_expand("name")),
    "f03_normalize": _sel(sql_normalize("name")),
    "f04_soundex": _sel(sql_phonetic("name")),
    "f06_prefix_key": _sel("left(coalesce(name, ''), 4)"),
    "f08_geo": _sel(sql_geo("v"), _REGIONS),
    "f09_clean_name": _sel(sql_clean("name")),
    "f10_region": _sel(_REGION, _REGIONS),
    "f11_canonical_region": f"SELECT src, record_no, {_KNOWN} AS mapped, coalesce({_KNOWN}, v) AS or_self FROM {_REGIONS}",
    "f12_pair_text": "SELECT record_no, concat_ws(' ', nullif(coalesce(facility_name, ''), ''), 'woreda:' || woreda, 'region:' || region, 'zone:' || zone) AS out FROM stg_mfr_facilities",
    "f13_reason_text": f"""SELECT link_no, {_BAND} AS band, CASE WHEN score IS NULL THEN 'No candidate in the same region'
        WHEN {_BAND} = 'none' THEN 'Best score ' || printf('%.3f', score) || ' is below the lowest band'
        ELSE 'Name similarity ' || printf('%.3f', score) || ' in the same region' END AS reason_text
      FROM (SELECT link_no, {_SCORE} AS score FROM facility_linkage)""",
    "f15_padded_id": "SELECT c_custkey, printf('MFR_%06d', c_custkey) AS padded, printf('DHIS2_%06d', c_custkey) AS other FROM customer",
    "f16_drop_letter": _sel("CASE WHEN name IS NOT NULL THEN array_to_string(list_prepend(left(split(name, ' ')[1], length(split(name, ' ')[1]) - 1), split(name, ' ')[2:]), ' ') END"),
    "f20_run_stamp": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp FROM events",
    "proj_p15_blank_to_null": r"SELECT record_no, CASE WHEN NOT regexp_matches(existing_dhis2_id, '^[\s\p{Z}]*$') THEN existing_dhis2_id END AS existing_dhis2_id, CASE WHEN NOT regexp_matches(zone, '^[\s\p{Z}]*$') THEN zone END AS zone FROM stg_mfr_facilities",
    "f07_preprocess": f"""WITH a AS (SELECT *, {sql_transliterate('facility_name')} AS x FROM stg_mfr_facilities), b AS (SELECT *, {sql_expand('x')} AS e FROM a), c AS (SELECT *, {sql_normalize('e')} AS n FROM b)
      SELECT record_no, x AS facility_amharic_xlat, e AS facility_expanded, n AS facility_normalized, {sql_phonetic('n')} AS facility_phonetic,
        {sql_normalize('region')} AS region_normalized, {sql_normalize('zone')} AS zone_normalized, {sql_normalize('woreda')} AS woreda_normalized FROM c""",
}
_MAP = ", ".join(f"({q(a)}, {q(b)})" for a, b in t.REGION_MAP.items())
ORACLE["f11_region_map"] = f"""WITH map(region, mapped) AS (VALUES {_MAP})
  SELECT region, mapped FROM (SELECT region FROM stg_mfr_facilities UNION SELECT regional FROM stg_dhis2_facilities UNION SELECT region FROM map) LEFT JOIN map USING (region) WHERE region IS NOT NULL"""
