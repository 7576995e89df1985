"""The same questions in plain SQL, for the check against DuckDB."""

STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
UIDSQL = "regexp_matches({0}, '^[A-Za-z][A-Za-z0-9]{{10}}$')"


def strip(c: str) -> str:
    return STRIP.format(c)


_REFS = f"""
refs AS (
  SELECT 'stg_mfr_facilities' AS ref_table, record_no AS ref_no, {strip('existing_dhis2_id')} AS dhis2_uid, loaded_at AS tm FROM stg_mfr_facilities
  UNION SELECT 'facility_linkage', link_no, {strip('dhis2_uid')}, linked_at FROM facility_linkage),
good AS (SELECT *, strftime(tm, '%Y-%m') AS period FROM refs WHERE {UIDSQL.format('dhis2_uid')} AND tm IS NOT NULL),
parents AS (SELECT {strip('dhis2_uid')} AS uid, min(loaded_at) AS first_at, min(deleted_at) AS gone_at FROM stg_dhis2_facilities GROUP BY 1),
found AS (SELECT ref_table, period, ref_no, good.dhis2_uid FROM good LEFT JOIN parents ON uid = good.dhis2_uid
  WHERE uid IS NULL OR tm < first_at OR tm >= gone_at)
"""

_CHECKED = r"""
long AS (
  SELECT load_no, 'catchment_population' AS column_name, trim(catchment_population) AS v FROM stg_mfr_facilities
  UNION ALL SELECT load_no, 'number_of_inpatient_beds', trim(number_of_inpatient_beds) FROM stg_mfr_facilities
  UNION ALL SELECT load_no, 'zone', trim(zone) FROM stg_mfr_facilities),
judged AS (
  SELECT *, coalesce(v, '') = '' AS blank,
    CASE WHEN column_name = 'zone' THEN regexp_matches(v, '^[\p{L}\p{M}\p{Nd} ''().,/-]*$') AND regexp_matches(v, '\p{L}')
         ELSE regexp_matches(v, '^[0-9]+$') AND coalesce(try_cast(v AS HUGEINT), 99999999999) <= CASE column_name WHEN 'catchment_population' THEN 10000000 ELSE 2000 END END AS ok
  FROM long),
tops AS (SELECT column_name, load_no, max(n) AS top FROM (SELECT column_name, load_no, v, count(*) AS n FROM judged WHERE NOT blank AND ok GROUP BY ALL) GROUP BY ALL),
prof AS (
  SELECT column_name, load_no, count(*) AS n, avg(blank::INT) AS null_rate, avg((NOT blank AND NOT coalesce(ok, false))::INT) AS violation_rate,
    median(CASE WHEN column_name <> 'zone' AND NOT blank AND ok THEN try_cast(v AS BIGINT) END) AS median
  FROM judged GROUP BY ALL),
full_prof AS (SELECT prof.*, coalesce(top, 0) / n AS top_share FROM prof LEFT JOIN tops USING (column_name, load_no)),
pairs AS (SELECT b.load_no, b.column_name, a.null_rate AS n0, b.null_rate AS n1, a.violation_rate AS v0, b.violation_rate AS v1, a.median AS m0, b.median AS m1, a.top_share AS t0, b.top_share AS t1
  FROM full_prof a JOIN full_prof b ON a.column_name = b.column_name AND b.load_no = a.load_no + 1)
"""

ORACLE = {
    "p2_found": f"WITH {_REFS} SELECT DISTINCT * FROM found",
    "p2_report": f"""WITH {_REFS} SELECT ref_table, period, "references", coalesce(orphans, 0) AS orphans, coalesce(missing_keys, 0) AS missing_keys,
      round(coalesce(orphans, 0) / "references", 6) AS orphan_share
      FROM (SELECT ref_table, period, count(*) AS "references" FROM good GROUP BY ALL)
      LEFT JOIN (SELECT ref_table, period, count(*) AS orphans, count(DISTINCT dhis2_uid) AS missing_keys FROM found GROUP BY ALL) USING (ref_table, period)""",
    "p4_found": f"""WITH {_CHECKED}
      SELECT load_no, column_name, 'null_rate' AS measure FROM pairs WHERE abs(n1 - n0) > 0.1
      UNION ALL SELECT load_no, column_name, 'violation_rate' FROM pairs WHERE abs(v1 - v0) > 0.1
      UNION ALL SELECT load_no, column_name, 'median' FROM pairs WHERE m1 > 1.8 * m0 OR m0 > 1.8 * m1
      UNION ALL SELECT load_no, column_name, 'top_share' FROM pairs WHERE column_name = 'zone' AND abs(t1 - t0) > 0.1""",
    "p7_found": """WITH pts AS (SELECT DISTINCT trim(facility_id) AS id, latitude AS lat, longitude AS lon FROM mfr_sample
        WHERE latitude BETWEEN 3 AND 15 AND longitude BETWEEN 33 AND 48),
      cells AS (SELECT *, floor(lat / 0.002)::INT AS cy, floor(lon / 0.002)::INT AS cx FROM pts),
      near AS (SELECT p.id AS a, q.id AS b, p.lat AS la, q.lat AS lb, p.lon AS oa, q.lon AS ob
        FROM (SELECT *, unnest([-1, 0, 1]) AS dx FROM (SELECT *, unnest([-1, 0, 1]) AS dy FROM cells)) p
        JOIN cells q ON q.cy = p.cy + p.dy AND q.cx = p.cx + p.dx AND p.id < q.id)
      SELECT DISTINCT a AS facility_id_a, b AS facility_id_b FROM near
      WHERE 2 * 6371008.8 * asin(sqrt(pow(sin(radians(lb - la) / 2), 2) + cos(radians(la)) * cos(radians(lb)) * pow(sin(radians(ob - oa) / 2), 2))) <= 100""",
}

ORACLE["p7_regions"] = f"""WITH pts AS MATERIALIZED (SELECT DISTINCT {strip('facility_id')} AS id, longitude AS lon, latitude AS lat, {strip('zone')} AS zone FROM mfr_sample
    WHERE latitude BETWEEN 3 AND 15 AND longitude BETWEEN 33 AND 48),
  mid AS (SELECT zone, avg(lon) AS cx, avg(lat) AS cy FROM pts WHERE zone <> '' GROUP BY 1),
  far AS (SELECT zone, cx, cy, ((floor(degrees(atan2(lat - cy, lon - cx)) * 12 / 360)::INT % 12) + 12) % 12 AS s, max(sqrt((lon - cx) * (lon - cx) + (lat - cy) * (lat - cy))) AS r FROM pts JOIN mid USING (zone) GROUP BY ALL),
  least AS (SELECT zone, cx, cy, greatest(CASE WHEN count(*) = 12 THEN min(r) ELSE 0 END * 0.9, 0.001) * 0.2 AS inner_r FROM far GROUP BY ALL),
  corners AS (SELECT zone, k AS s, cx + greatest(coalesce(r, 0) * 0.9, 0.001) * cos(radians((k + 0.5) * 30)) AS x, cy + greatest(coalesce(r, 0) * 0.9, 0.001) * sin(radians((k + 0.5) * 30)) AS y
    FROM (SELECT zone, cx, cy, unnest(range(12)) AS k FROM least) LEFT JOIN (SELECT zone, s AS k, r FROM far) USING (zone, k)),
  inner_corners AS (SELECT zone, 100 + k AS s, cx + inner_r * cos(radians(k * 90.0)) AS x, cy + inner_r * sin(radians(k * 90.0)) AS y FROM (SELECT *, unnest(range(4)) AS k FROM least)),
  sides AS MATERIALIZED (SELECT p.zone, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM corners p JOIN corners q ON p.zone = q.zone AND q.s = (p.s + 1) % 12
    UNION ALL SELECT p.zone, p.x, p.y, q.x, q.y FROM inner_corners p JOIN inner_corners q ON p.zone = q.zone AND q.s = 100 + (p.s - 99) % 4),
  places AS MATERIALIZED (SELECT DISTINCT id, lon, lat FROM pts),
  hits AS (SELECT zone, id, lon, lat FROM places JOIN sides ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1)
  SELECT zone, count(*) AS facilities FROM hits GROUP BY 1"""
