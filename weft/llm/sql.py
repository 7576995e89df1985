"""The same questions in plain SQL, for the check against DuckDB."""

from weft.llm.survivors import FILLERS

STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_WORDS = ", ".join(f"'{w}'" for w in FILLERS)


def strip(c: str) -> str:
    return STRIP.format(c)


def says(c: str) -> str:
    word = rf"lower(regexp_replace({c}, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g'))"
    return rf"coalesce({word}, '') NOT IN ('', {_WORDS})"


def _best(table: str, key: str, column: str) -> str:
    return f"""SELECT '{table}' AS table_name, facility_key, '{column}' AS column_name, record_no FROM (
      SELECT {strip(key)} AS facility_key, record_no,
        row_number() OVER (PARTITION BY {strip(key)} ORDER BY coalesce(trust_rank, 1000000), updated_at DESC NULLS LAST, record_no) AS r
      FROM {table} LEFT JOIN source_trust USING (source_system)
      WHERE {says(column)} AND {strip(key)} IN (SELECT {strip(key)} FROM {table} GROUP BY 1 HAVING count(DISTINCT record_no) > 1))
    WHERE r = 1"""


ORACLE = {
    "p3_found": " UNION ALL ".join(_best(*x) for x in (("stg_mfr_facilities", "mfr_id", "facility_type"), ("stg_mfr_facilities", "mfr_id", "ownership"), ("stg_dhis2_facilities", "dhis2_uid", "facilitytype"))),
}

_GROUPS = rf"""WITH RECURSIVE links AS (SELECT DISTINCT {strip('mfr_id')} AS a, {strip('dhis2_uid')} AS b FROM facility_linkage
    WHERE regexp_matches({strip('dhis2_uid')}, '^[A-Za-z][A-Za-z0-9]{{10}}$') AND lower({strip("coalesce(confidence, '')")}) <> 'none' AND {strip('mfr_id')} <> ''),
  ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
  reach(x, y) AS (SELECT a, a FROM ends UNION SELECT x, b FROM reach JOIN ends ON y = a),
  grouped AS (SELECT min(y) AS group_key, x AS member_key FROM reach GROUP BY x)"""

ORACLE |= {
    "p5_found": f"{_GROUPS} SELECT * FROM grouped",
    "p5_sizes": f"{_GROUPS} SELECT size, count(*) AS groups FROM (SELECT group_key, count(*) AS size FROM grouped GROUP BY 1) GROUP BY 1",
}


def _plain(c: str) -> str:
    return f"lower({strip(c)})"


def _told(c: str) -> str:
    return f"CASE WHEN {says(c)} THEN {c} END AS {c}"


_FIRST = "QUALIFY row_number() OVER (PARTITION BY k{0} ORDER BY rk, age, record_no) = 1"
ORACLE["p3_bundles"] = f"""WITH told AS MATERIALIZED (SELECT {strip('mfr_id')} AS k, record_no, coalesce(trust_rank, 1073741824) AS rk,
    CASE WHEN updated_at IS NULL THEN 4611686018427387904::HUGEINT ELSE -epoch_us(updated_at)::HUGEINT END AS age, {', '.join(map(_told, ('region', 'zone', 'woreda', 'facility_type', 'subtype', 'ownership')))}
    FROM stg_mfr_facilities LEFT JOIN source_trust USING (source_system)),
  v AS (SELECT * FROM told WHERE k IS NOT NULL AND record_no IS NOT NULL AND k IN (SELECT k FROM told GROUP BY 1 HAVING min(record_no) < max(record_no))),
  usual AS (SELECT z, g FROM (SELECT {_plain('zone')} AS z, {_plain('region')} AS g, count(*) AS n FROM told WHERE zone IS NOT NULL AND region IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY z ORDER BY n DESC, g DESC) = 1),
  region AS (SELECT k, record_no, rk, age, region || ' | ' AS value, {_plain('region')} AS has FROM v WHERE region IS NOT NULL {_FIRST.format(', has')}),
  place AS (SELECT k, record_no, rk, age, coalesce(zone, '') || ' | ' || coalesce(woreda, '') AS value, g AS implies FROM v LEFT JOIN usual ON z = {_plain('zone')} WHERE zone IS NOT NULL OR woreda IS NOT NULL {_FIRST.format(', implies')}),
  kind AS (SELECT k, record_no, rk, age, coalesce(facility_type, '') || ' | ' || coalesce(subtype, '') AS value FROM v WHERE facility_type IS NOT NULL OR subtype IS NOT NULL {_FIRST.format('')}),
  owner AS (SELECT k, record_no, rk, age, ownership || ' | ' AS value FROM v WHERE ownership IS NOT NULL {_FIRST.format('')}),
  region1 AS (SELECT * FROM region {_FIRST.format('')}), place1 AS (SELECT * FROM place {_FIRST.format('')}),
  apart AS (SELECT k FROM region1 JOIN place1 USING (k) WHERE implies <> has),
  found AS (SELECT k, region.record_no AS r, region.value AS rv, place.record_no AS p, place.value AS pv FROM apart JOIN region USING (k) JOIN place USING (k) WHERE coalesce(implies = has, true)
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY region.rk + place.rk, region.age + place.age, region.record_no, place.record_no) = 1),
  bad AS (SELECT k FROM apart WHERE k NOT IN (SELECT k FROM found)),
  chosen AS (SELECT k, 'region' AS bundle, coalesce(r, record_no) AS record_no, coalesce(rv, value) AS value FROM region1 LEFT JOIN found USING (k)
    UNION ALL SELECT k, 'place', coalesce(p, record_no), coalesce(pv, value) FROM place1 LEFT JOIN found USING (k)
    UNION ALL SELECT k, 'kind', record_no, value FROM kind UNION ALL SELECT k, 'owner', record_no, value FROM owner)
  SELECT k AS mfr_id, bundle, record_no, value, k NOT IN (SELECT k FROM bad) AS consistent FROM chosen"""
