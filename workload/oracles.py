"""SQL twins of the registered queries, independent of the Spark code.

Polygon tests here run edge by edge over all pairs; there is no index.
"""

from __future__ import annotations

from workload import fixtures as fx

AS_OF = fx.AS_OF

_CROSSES = (
    "CASE WHEN (e.y1 > p.LAT) <> (e.y2 > p.LAT)"
    " AND p.LON < (e.x2 - e.x1)*(p.LAT - e.y1)/NULLIF(e.y2 - e.y1, 0) + e.x1 THEN 1 ELSE 0 END"
)
_TOUCHES = (
    "CASE WHEN p.LON BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)"
    " AND p.LAT BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
    " AND (e.x2 - e.x1)*(p.LAT - e.y1) = (e.y2 - e.y1)*(p.LON - e.x1) THEN 1 ELSE 0 END"
)


def _inside(points: str, key: str, edges: str, area: str) -> str:
    return (
        f"SELECT p.{key}, e.{area} FROM {points} p CROSS JOIN {edges} e GROUP BY p.{key}, e.{area}"
        f" HAVING sum({_CROSSES}) % 2 = 1 AND sum({_TOUCHES}) = 0"
    )


def _edges(vertices: str, key: str, x: str = "x", y: str = "y") -> str:
    return (
        f"SELECT * FROM (SELECT {key}, part, ring, {x} AS x1, {y} AS y1,"
        f" lead({x}) OVER w AS x2, lead({y}) OVER w AS y2 FROM {vertices}"
        f" WINDOW w AS (PARTITION BY {key}, part, ring ORDER BY i)) WHERE x2 IS NOT NULL"
    )


def _sqmi(vertices: str, key: str) -> str:
    mx = "6378137.0*radians(x)"
    my = "6378137.0*ln(tan(pi()/4 + radians(y)/2))"
    return (
        f"SELECT {key}, sum(CASE WHEN ring = 0 THEN a ELSE -a END)/2589988 AS sqmi FROM ("
        f"SELECT {key}, part, ring, abs(sum((x1 - ox)*(y2 - oy) - (x2 - ox)*(y1 - oy)))/2 AS a FROM ("
        f"SELECT *, first_value(x1) OVER r AS ox, first_value(y1) OVER r AS oy"
        f" FROM ({_edges(vertices, key + ', i', mx, my).replace(f'PARTITION BY {key}, i,', f'PARTITION BY {key},')})"
        f" WINDOW r AS (PARTITION BY {key}, part, ring ORDER BY i))"
        f" GROUP BY {key}, part, ring) GROUP BY {key}"
    )


def _centroid(edges: str, key: str) -> str:
    # Moments about (-100, 35), near all the data, to keep digits.
    cross = "((x1 + 100)*(y2 - 35) - (x2 + 100)*(y1 - 35))"
    return (
        f"SELECT {key}, round(-100 + sum(s*mx)/(3*sum(s*a)), 6) AS lon,"
        f" round(35 + sum(s*my)/(3*sum(s*a)), 6) AS lat FROM ("
        f"SELECT {key}, part, ring, sum({cross}) AS a, sum((x1 + x2 + 200)*{cross}) AS mx,"
        f" sum((y1 + y2 - 70)*{cross}) AS my,"
        f" CASE WHEN (sum({cross}) >= 0) = (ring = 0) THEN 1.0 ELSE -1.0 END AS s"
        f" FROM {edges} GROUP BY {key}, part, ring) GROUP BY {key}"
    )


def _corners(vertices: str, key: str) -> str:
    """The set of real corners of a shape as text."""
    return (
        f"SELECT {key}, string_agg(ring || ':' || x || ' ' || y, ',' ORDER BY ring, x, y) AS shape"
        f" FROM (SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER f) AS px,"
        f" coalesce(lag(y) OVER w, last_value(y) OVER f) AS py,"
        f" coalesce(lead(x) OVER w, first_value(x) OVER f) AS nx,"
        f" coalesce(lead(y) OVER w, first_value(y) OVER f) AS ny FROM ("
        f"SELECT *, max(i) OVER (PARTITION BY {key}, part, ring) AS last FROM {vertices}) WHERE i < last"
        f" WINDOW w AS (PARTITION BY {key}, part, ring ORDER BY i),"
        f" f AS (PARTITION BY {key}, part, ring ORDER BY i"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
        f" WHERE (x - px)*(ny - y) <> (y - py)*(nx - x) GROUP BY {key}"
    )


def _cells(vertices: str, key: str, side: int = 512) -> str:
    """Cells of a raster whose middle lies within a part, by the upright edges to the right of it."""
    return (
        f"SELECT {key}, part, cx, cy FROM (SELECT *, unnest(range(low, high)) AS cy FROM (SELECT {key}, part,"
        f" unnest(range(CAST(min(x)*{side} AS BIGINT), CAST(max(x)*{side} AS BIGINT))) AS cx,"
        f" CAST(min(y)*{side} AS BIGINT) AS low, CAST(max(y)*{side} AS BIGINT) AS high FROM {vertices} GROUP BY 1, 2))"
        f" JOIN ({_edges(vertices, key)}) USING ({key}, part)"
        f" WHERE x1 = x2 AND x1*{side} > cx + 0.5 AND (y1*{side} > cy + 0.5) <> (y2*{side} > cy + 0.5)"
        f" GROUP BY 1, 2, 3, 4 HAVING count(*) % 2 = 1"
    )


def _number(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"


def _wkt(vertices: str, key: str) -> str:
    return (
        f"SELECT {key}, CASE WHEN count(*) = 1 THEN 'POLYGON ' || string_agg(p, ', ')"
        f" ELSE 'MULTIPOLYGON (' || string_agg(p, ', ' ORDER BY part) || ')' END AS wkt FROM ("
        f"SELECT {key}, part, '(' || string_agg(r, ', ' ORDER BY ring) || ')' AS p FROM ("
        f"SELECT {key}, part, ring,"
        f" '(' || string_agg({_number('x')} || ' ' || {_number('y')}, ', ' ORDER BY i) || ')' AS r"
        f" FROM {vertices} GROUP BY {key}, part, ring) GROUP BY {key}, part) GROUP BY {key}"
    )


def _stats(rows: str, by: str) -> str:
    return (
        f"SELECT {by}, count(*) AS event_count, avg(NULLIF(MAXSIZE, -999)) AS avg_hail_size,"
        f" max(NULLIF(MAXSIZE, -999)) AS max_hail_size, avg(NULLIF(SEVPROB, -999)) AS avg_severe_prob,"
        f" avg(NULLIF(PROB, -999)) AS avg_hail_prob,"
        f" count(*) FILTER (WHERE NULLIF(MAXSIZE, -999) >= 1.0) AS damaging_events,"
        f" count(*) FILTER (WHERE NULLIF(SEVPROB, -999) >= 50) AS high_risk_events"
        f" FROM {rows} WHERE ZTIME >= DATE '{AS_OF}' - INTERVAL 180 DAY GROUP BY {by}"
    )


def _risk(area_type: str, area_id: str, country: str = "'US'") -> str:
    return (
        f"'{area_type}' AS area_type, {area_id} AS area_id, {country} AS country, coalesce(n.event_count, 0) AS event_count,"
        " round(coalesce(n.event_count, 0)/NULLIF(a.sqmi, 0), 4) AS events_per_sqmi,"
        " round(n.avg_hail_size, 4) AS avg_hail_size, n.max_hail_size,"
        " round(n.avg_severe_prob, 4) AS avg_severe_prob, round(n.avg_hail_prob, 4) AS avg_hail_prob,"
        " coalesce(n.damaging_events, 0) AS damaging_events,"
        " round(coalesce(n.damaging_events, 0)/NULLIF(a.sqmi, 0), 4) AS damaging_per_sqmi,"
        " coalesce(n.high_risk_events, 0) AS high_risk_events,"
        " round(coalesce(n.high_risk_events, 0)/NULLIF(a.sqmi, 0), 4) AS high_risk_per_sqmi,"
        " round(a.sqmi, 4) AS area_sqmi"
    )


def _risk_rows(county_stats: str, state_stats: str) -> str:
    return (
        f"SELECT {_risk('county', 'a.postcode')} FROM postcode_areas a"
        f" JOIN states s USING (state_code) LEFT JOIN {county_stats} n ON n.postcode = a.postcode"
        f" UNION ALL SELECT {_risk('state', 'a.state_code')} FROM states a"
        f" JOIN {state_stats} n ON n.state_code = a.state_code"
        " WHERE a.state_code IN (SELECT state_code FROM postcode_areas)"
    )


def _risk_of_countries(county_stats: str, state_stats: str) -> str:
    return (
        f"SELECT {_risk('county', 'a.postcode', 'a.country')} FROM places a"
        f" JOIN all_states s USING (state_code) LEFT JOIN {county_stats} n ON n.postcode = a.postcode AND n.country = a.country"
        f" UNION ALL SELECT {_risk('state', 'a.state_code', _STATE_COUNTRY.format('a'))} FROM all_states a"
        f" JOIN {state_stats} n ON n.state_code = a.state_code"
        " WHERE a.state_code IN (SELECT state_code FROM places)"
    )


_STATE_COUNTRY = "split_part({}.state_code, '-', 1)"


def _premium(comparison: str) -> str:
    ratios = ", ".join(
        f" c.{m}/CASE WHEN s.{m} IS NOT NULL THEN greatest(s.{m}, 1e-10) END AS {n}_ratio"
        for n, m in (
            ("frequency", "events_per_sqmi"), ("size", "avg_hail_size"),
            ("severity", "avg_severe_prob"), ("damaging", "damaging_per_sqmi"),
        )
    )
    return (
        "SELECT *, (risk_score - 1.0)*20 AS premium_modifier_pct,"
        " CASE WHEN (risk_score - 1.0)*20 > 0 THEN 'premium increase recommended'"
        " WHEN (risk_score - 1.0)*20 <= 0 THEN 'discount eligible' END AS recommendation FROM ("
        "SELECT *, CAST(0.25 AS DOUBLE)*frequency_ratio + CAST(0.25 AS DOUBLE)*size_ratio"
        " + CAST(0.25 AS DOUBLE)*severity_ratio + CAST(0.25 AS DOUBLE)*damaging_ratio AS risk_score FROM ("
        f"SELECT c.postcode AS county_id, c.country, s.area_id AS state_id, {ratios}"
        f" FROM {comparison} c JOIN {comparison} s ON c.postcode = s.postcode AND c.country = s.country"
        " WHERE c.area_type = 'county' AND s.area_type = 'state'))"
    )


METRICS = [
    "event_count", "events_per_sqmi", "avg_hail_size", "max_hail_size", "avg_severe_prob",
    "avg_hail_prob", "damaging_events", "damaging_per_sqmi", "high_risk_events",
    "high_risk_per_sqmi", "area_sqmi",
]

_HAIL_COLUMNS = (
    'ZTIME, LON, LAT, WSR_ID, CELL_ID, "RANGE", AZIMUTH, SEVPROB, PROB, MAXSIZE'
)

# Named relations; each may use those above it.
RELATIONS = {
    "hail_revisions": (
        "SELECT rev, event_id, ZTIME, LON, LAT, WSR_ID, CELL_ID, RANGE_NM AS \"RANGE\", AZIMUTH,"
        f" SEVPROB, PROB, MAXSIZE FROM ({fx.duckdb_sql(fx.HAIL)})"
    ),
    "hail": "SELECT * EXCLUDE (rev) FROM hail_revisions WHERE rev = 0",
    "county_vertices": fx.duckdb_sql(fx.COUNTY_VERTICES),
    "state_vertices": fx.duckdb_sql(fx.STATE_VERTICES),
    "parcel_vertices": fx.duckdb_sql(fx.PARCEL_VERTICES),
    "plot_vertices": fx.duckdb_sql(fx.PLOT_VERTICES),
    "cut_vertices": fx.duckdb_sql(fx.CUT_VERTICES),
    **{
        f"{name}_ground": (
            f"SELECT {name}_id, list(DISTINCT (cx, cy) ORDER BY (cx, cy)) AS ground"
            f" FROM ({_cells(f'{name}_vertices', f'{name}_id')}) GROUP BY 1"
        )
        for name in ("parcel", "cut")
    },
    "addresses": fx.duckdb_sql(fx.ADDRESSES),
    "decisions": fx.duckdb_sql(fx.DECISIONS),
    "county_edges": _edges("county_vertices", "area_id"),
    "state_edges": _edges("state_vertices", "state_no"),
    "parcel_edges": _edges("parcel_vertices", "parcel_id"),
    "centres": (
        "SELECT postcode, country, avg(LON) AS LON, avg(LAT) AS LAT FROM"
        " (SELECT DISTINCT postcode, country, LON, LAT FROM addresses) GROUP BY postcode, country"
    ),
    "county_sqmi": _sqmi("county_vertices", "area_id"),
    "state_sqmi": _sqmi("state_vertices", "state_no"),
    "postcode_county": _inside("centres", "postcode", "county_edges", "area_id"),
    "postcode_areas": (
        "SELECT postcode, 'US' AS country, c.area_id,"
        " 'US-S' || CAST(floor(c.area_id/5.0) AS INT) AS state_code, sqmi"
        " FROM postcode_county c JOIN county_sqmi USING (area_id)"
    ),
    "states": (
        "SELECT DISTINCT 's' || state_no AS id, state_no, 'State ' || state_no AS state_name,"
        " 'US-S' || state_no AS state_code, sqmi FROM state_sqmi"
        " WHERE 'US-S' || state_no IN (SELECT country || '-' || level0 FROM addresses)"
    ),
    "in_state": _inside("hail", "event_id", "state_edges", "state_no"),
    "in_county": _inside("hail", "event_id", "county_edges", "area_id"),
    "hail_state": (
        "SELECT h.*, s.state_code FROM hail h JOIN in_state i USING (event_id)"
        " JOIN states s USING (state_no)"
    ),
    "hail_county": (
        "SELECT h.* EXCLUDE (state_code), p.postcode, p.country FROM hail_state h"
        " JOIN in_county c USING (event_id) JOIN postcode_areas p USING (area_id)"
    ),
    "county_stats": _stats("hail_county", "postcode"),
    "state_stats": _stats("hail_state", "state_code"),
    "risk": _risk_rows("county_stats", "state_stats"),
    "mended_state": "SELECT * REPLACE (CASE WHEN event_id % 20 = 0 THEN 100 ELSE PROB END AS PROB) FROM hail_state",
    "mended_county": "SELECT * REPLACE (CASE WHEN event_id % 20 = 0 THEN 100 ELSE PROB END AS PROB) FROM hail_county",
    "mended_county_stats": _stats("mended_county", "postcode"),
    "mended_state_stats": _stats("mended_state", "state_code"),
    "comparison": (
        "SELECT a.postcode, a.country, r.* EXCLUDE (country) FROM postcode_areas a JOIN risk r"
        " ON (r.area_type = 'county' AND r.area_id = a.postcode)"
        " OR (r.area_type = 'state' AND r.area_id ="
        " coalesce(a.state_code, (SELECT min(state_code) FROM states)))"
    ),
    "premium": _premium("comparison"),
    # Two countries: an area is 'c' and its number, or 'x' and that of one of the further counties.
    "more_counties": fx.duckdb_sql(fx.MORE_COUNTIES),
    "more_vertices": fx.duckdb_sql(fx.MORE_VERTICES),
    "more_addresses": fx.duckdb_sql(fx.MORE_ADDRESSES),
    "more_edges": _edges("more_vertices", "k"),
    "more_sqmi": _sqmi("more_vertices", "k"),
    "more_wkt": _wkt("more_vertices", "k"),
    "in_more": _inside("hail", "event_id", "more_edges", "k"),
    "places": (
        "SELECT postcode, country, state_code, 'c' || area_id AS area, sqmi FROM postcode_areas UNION ALL"
        " SELECT DISTINCT a.postcode, a.country, m.region, 'x' || k, q.sqmi FROM more_addresses a"
        " JOIN more_counties m USING (k) JOIN more_sqmi q USING (k)"
    ),
    "all_states": (
        "SELECT state_code, sqmi FROM states UNION ALL"
        " SELECT region, sqmi FROM more_counties JOIN more_sqmi USING (k) WHERE k < 5"
    ),
    "all_hail_state": (
        "SELECT * FROM hail_state UNION ALL SELECT h.*, m.region FROM hail h JOIN in_more USING (event_id)"
        " JOIN more_counties m USING (k) WHERE k < 5"
    ),
    "all_hail_county": (
        "SELECT h.* EXCLUDE (state_code), p.postcode, p.country FROM all_hail_state h JOIN ("
        "SELECT event_id, 'c' || area_id AS area FROM in_county UNION ALL SELECT event_id, 'x' || k FROM in_more)"
        " USING (event_id) JOIN places p USING (area)"
    ),
    "all_county_stats": _stats("all_hail_county", "postcode, country"),
    "all_state_stats": _stats("all_hail_state", "state_code"),
    "all_risk": _risk_of_countries("all_county_stats", "all_state_stats"),
    "all_comparison": (
        "SELECT a.postcode, a.country, r.* EXCLUDE (country) FROM (SELECT * REPLACE ("
        "coalesce(state_code, (SELECT min(state_code) FROM all_states)) AS state_code) FROM places) a JOIN all_risk r"
        " ON (r.area_type = 'county' AND r.area_id = a.postcode AND r.country = a.country)"
        f" OR (r.area_type = 'state' AND r.area_id = a.state_code AND r.country = {_STATE_COUNTRY.format('a')})"
    ),
    # Loaded by the chain: good lines of its two windows, the best copy of each report.
    "chain_hail": (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ZTIME, LON, LAT, WSR_ID, CELL_ID ORDER BY"
        " (SEVPROB = -999)::INT + (PROB = -999)::INT + (MAXSIZE = -999)::INT, SEVPROB DESC, PROB DESC, MAXSIZE DESC) AS rn"
        " FROM hail_revisions WHERE event_id % 89 <> 0 AND event_id % 97 <> 0"
        f" AND ZTIME BETWEEN TIMESTAMP '{fx.START}' AND TIMESTAMP '{fx.END}') WHERE rn = 1"
    ),
    "chain_state": (
        "SELECT h.* FROM all_hail_state s JOIN chain_hail c USING (event_id), LATERAL"
        " (SELECT s.* REPLACE (c.SEVPROB AS SEVPROB, c.PROB AS PROB, c.MAXSIZE AS MAXSIZE)) h"
    ),
    "chain_county": (
        "SELECT h.* FROM all_hail_county s JOIN chain_hail c USING (event_id), LATERAL"
        " (SELECT s.* REPLACE (c.SEVPROB AS SEVPROB, c.PROB AS PROB, c.MAXSIZE AS MAXSIZE)) h"
    ),
    "chain_county_stats": _stats("chain_county", "postcode, country"),
    "chain_state_stats": _stats("chain_state", "state_code"),
    "worst": (
        "SELECT postcode, date, event_count, max_size FROM (SELECT *, row_number() OVER"
        " (PARTITION BY postcode ORDER BY max_size DESC NULLS LAST, event_count DESC, date) AS rn FROM ("
        "SELECT postcode, CAST(ZTIME AS DATE) AS date, count(*) AS event_count,"
        " max(NULLIF(MAXSIZE, -999)) AS max_size FROM hail_county GROUP BY 1, 2)) WHERE rn = 1"
    ),
    "verify": (
        "SELECT count(*) AS total_records, min(ZTIME) AS earliest_date, max(ZTIME) AS latest_date,"
        " count(DISTINCT CAST(ZTIME AS DATE)) AS unique_days, count(DISTINCT WSR_ID) AS unique_stations,"
        " count(*) FILTER (WHERE SEVPROB = -999) AS missing_sevprob,"
        " count(*) FILTER (WHERE PROB = -999) AS missing_prob,"
        " count(*) FILTER (WHERE MAXSIZE = -999) AS missing_maxsize,"
        " round(avg(NULLIF(MAXSIZE, -999)), 3) AS avg_hail_size,"
        " max(NULLIF(MAXSIZE, -999)) AS max_hail_size FROM hail_revisions"
    ),
    "corrections": (
        "SELECT event_id, ZTIME, CASE WHEN event_id % 40 = 0 THEN LON + 0.5 ELSE LON END AS LON,"
        ' LAT, WSR_ID, CELL_ID, "RANGE", AZIMUTH, SEVPROB, PROB, MAXSIZE'
        " FROM hail_revisions WHERE rev = 1"
    ),
    "first_events": (
        "SELECT * EXCLUDE (n) FROM (SELECT *, ZTIME AS timestamp, row_number() OVER"
        " (PARTITION BY ZTIME, WSR_ID, CELL_ID ORDER BY event_id) AS n FROM hail) WHERE n = 1"
    ),
    "hail_lines": (
        "SELECT *, event_id % 53 = 0 AS hidden, event_id % 53 <> 0 AND event_id % 41 <> 0"
        " AND event_id % 43 <> 0 AND event_id % 47 <> 0 AS fine,"
        " CASE WHEN event_id % 47 = 0 THEN six WHEN event_id % 43 = 0 THEN ten || ',7' ELSE ten END AS line FROM ("
        "SELECT *, six || ',' || AZIMUTH || ',' || SEVPROB || ',' || PROB || ',' ||"
        " CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(MAXSIZE AS VARCHAR) END AS ten FROM ("
        "SELECT *, CASE WHEN event_id % 41 = 0 THEN '' WHEN event_id % 89 = 0 THEN '20241350'"
        " ELSE strftime(ZTIME, '%Y%m%d%H%M%S') END || ',' || LON || ',' || LAT || ',' || WSR_ID || ',' ||"
        " CELL_ID || ',' || \"RANGE\" AS six FROM hail_revisions))"
    ),
    "county_wkt": _wkt("county_vertices", "area_id"),
    "state_wkt": _wkt("state_vertices", "state_no"),
    "stations_before": (
        "SELECT 'station' AS area_type, WSR_ID AS area_id, 'US' AS country, count(*) AS event_count,"
        " max(NULLIF(MAXSIZE, -999)) AS max_hail_size FROM hail"
        " WHERE ZTIME < TIMESTAMP '2024-01-10 00:00:00' GROUP BY WSR_ID"
    ),
    "stations_after": (
        "SELECT 'station' AS area_type, CASE WHEN WSR_ID > 'K010' THEN WSR_ID ELSE 'N' || WSR_ID END AS area_id,"
        " 'US' AS country, count(*) AS event_count, max(NULLIF(MAXSIZE, -999)) AS max_hail_size FROM hail"
        " WHERE ZTIME >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY WSR_ID"
    ),
}

_FIRST = (
    "SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY ZTIME, LON, LAT, WSR_ID, CELL_ID"
    " ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
)
_BEST = (
    "(SEVPROB = -999)::INT + (PROB = -999)::INT + (MAXSIZE = -999)::INT, SEVPROB DESC, PROB DESC, MAXSIZE DESC,"
    ' "RANGE", AZIMUTH'
)
_LOADED = "event_id % 89 <> 0 AND event_id % 97 <> 0"

# Half-angle form of a ring's spherical excess, shells minus holes.
_SPHERE = "sum(CASE WHEN ring = 0 THEN e ELSE -e END)*6371008.8*6371008.8"

_METRIC_ROWS = " UNION ALL ".join(
    f"SELECT c.postcode, c.country, '{m}' AS metric, CAST(c.{m} AS DOUBLE) AS county,"
    f" CAST(s.{m} AS DOUBLE) AS state FROM comparison c JOIN comparison s"
    f" ON c.postcode = s.postcode AND c.country = s.country"
    f" WHERE c.area_type = 'county' AND s.area_type = 'state'"
    for m in METRICS
)
_VERIFY_COLUMNS = [
    "total_records", "earliest_date", "latest_date", "unique_days", "unique_stations",
    "missing_sevprob", "missing_prob", "missing_maxsize", "avg_hail_size", "max_hail_size",
]

# Every third report comes anew as another cell; of the others the figures change.
_RELEASED = (
    "SELECT * REPLACE (100 AS PROB, CASE WHEN event_id % 3 = 0 THEN 'new' ELSE CELL_ID END AS CELL_ID) FROM {rows}"
    " UNION ALL SELECT * FROM {rows} WHERE event_id % 3 = 0"
)

FINAL = {
    "load_hail": _FIRST.format(
        columns=_HAIL_COLUMNS,
        order=_BEST,
        source=f"(SELECT * FROM hail_revisions WHERE {_LOADED}"
        f" AND ZTIME BETWEEN TIMESTAMP '{fx.START}' AND TIMESTAMP '{fx.END}')",
    ),
    "load_hail_rejects": (
        "SELECT CASE WHEN event_id % 89 = 0 THEN '20241350'"
        " ELSE strftime(ZTIME, '%Y%m%d%H%M%S') END AS ZTIME,"
        " CAST(LON AS VARCHAR) AS LON, CAST(LAT AS VARCHAR) AS LAT, WSR_ID, CELL_ID,"
        ' CAST("RANGE" AS VARCHAR) AS "RANGE", CAST(AZIMUTH AS VARCHAR) AS AZIMUTH,'
        " CAST(SEVPROB AS VARCHAR) AS SEVPROB, CAST(PROB AS VARCHAR) AS PROB,"
        " CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(MAXSIZE AS VARCHAR) END AS MAXSIZE"
        f" FROM hail_revisions WHERE NOT ({_LOADED})"
    ),
    "load_hail_csv": _FIRST.format(
        columns=_HAIL_COLUMNS,
        order=_BEST,
        source=f"(SELECT * FROM hail_lines WHERE fine AND {_LOADED}"
        f" AND ZTIME BETWEEN TIMESTAMP '{fx.START}' AND TIMESTAMP '{fx.END}')",
    ),
    "load_hail_csv_rejects": f"SELECT line FROM hail_lines WHERE NOT hidden AND NOT (fine AND {_LOADED})",
    "dedup_latest": _FIRST.format(
        columns="rev, event_id, " + _HAIL_COLUMNS, order="rev DESC", source="hail_revisions"
    ),
    "filter_window": (
        f"SELECT * FROM hail WHERE ZTIME BETWEEN TIMESTAMP '{fx.START}' AND TIMESTAMP '{fx.END}'"
    ),
    "filter_day": (
        "SELECT event_id, strftime(ZTIME, '%Y%m%d%H%M%S') AS ZTIME FROM hail"
        " WHERE strftime(ZTIME, '%Y%m%d') = '20240110'"
    ),
    "filter_date": (
        "SELECT event_id, ZTIME FROM hail WHERE CAST(ZTIME AS DATE) = DATE '2024-01-10'"
    ),
    "daily_dates": (
        "SELECT strftime(CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE), '%Y%m%d') AS day"
        " FROM (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events)"
    ),
    "load_windows": (
        "SELECT DISTINCT d AS run_date,"
        " CAST(date_trunc('month', d) - INTERVAL 4 MONTH AS DATE) AS start_date,"
        " CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS end_date"
        " FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)"
    ),
    "verify_hail": "SELECT * FROM verify",
    "verify_hail_approx": "SELECT * FROM verify",
    "distinct_estimates": " UNION ALL ".join(
        f"SELECT '{name}' AS figure, count(DISTINCT {value}) AS exact, true AS near FROM hail"
        for name, value in (
            ("days", "CAST(ZTIME AS DATE)"),
            ("stations", "WSR_ID"),
            ("cells", "(WSR_ID, CELL_ID, date_trunc('month', ZTIME) = DATE '2024-01-01')"),
            ("places", "(LON, LAT)"),
        )
    ),
    "transpose_summary": " UNION ALL ".join(
        f"SELECT '{c}' AS metric, CAST({c} AS VARCHAR) AS value FROM verify" for c in _VERIFY_COLUMNS
    ),
    "daily_counts": (
        "SELECT CAST(ZTIME AS DATE) AS date, count(*) AS events FROM hail GROUP BY 1"
        " ORDER BY date DESC LIMIT 10"
    ),
    "table_counts": (
        "SELECT 'hail_raw' AS table_name, count(*) AS row_count FROM hail UNION ALL"
        " SELECT 'addresses', count(*) FROM addresses UNION ALL"
        " SELECT 'parcel_vertices', count(*) FROM parcel_vertices"
    ),
    "upsert_hail_raw": (
        f"SELECT h.ZTIME, h.LON, h.LAT, h.WSR_ID, h.CELL_ID, h.\"RANGE\", h.AZIMUTH,"
        " CASE WHEN s.event_id IS NULL THEN h.SEVPROB ELSE s.SEVPROB END AS SEVPROB,"
        " CASE WHEN s.event_id IS NULL THEN h.PROB ELSE s.PROB END AS PROB,"
        " CASE WHEN s.event_id IS NULL THEN h.MAXSIZE ELSE s.MAXSIZE END AS MAXSIZE,"
        " CAST(h.event_id AS VARCHAR) AS postcode FROM hail h LEFT JOIN corrections s"
        " ON s.ZTIME = h.ZTIME AND s.LON = h.LON AND s.LAT = h.LAT AND s.WSR_ID = h.WSR_ID"
        " AND s.CELL_ID = h.CELL_ID"
        f" UNION ALL SELECT {_HAIL_COLUMNS}, NULL AS postcode FROM corrections s WHERE NOT EXISTS ("
        " SELECT 1 FROM hail h WHERE s.ZTIME = h.ZTIME AND s.LON = h.LON AND s.LAT = h.LAT"
        " AND s.WSR_ID = h.WSR_ID AND s.CELL_ID = h.CELL_ID)"
    ),
    "upsert_all_columns": (
        "SELECT * FROM stations_after UNION ALL SELECT * FROM stations_before"
        " WHERE area_id NOT IN (SELECT area_id FROM stations_after)"
    ),
    "web_mercator": (
        "SELECT event_id, round(6378137.0*radians(LON), 3) AS x,"
        " round(6378137.0*ln(tan(pi()/4 + radians(LAT)/2)), 3) AS y FROM hail"
    ),
    "point_centroid": (
        "SELECT postcode, country, round(LON, 9) AS LON, round(LAT, 9) AS LAT FROM centres"
    ),
    "area_sqmi": (
        f"SELECT parcel_id, round(sqmi, 6) AS area_sqmi FROM ({_sqmi('parcel_vertices', 'parcel_id')})"
    ),
    "area_sqmi_sphere": (
        f"SELECT parcel_id, round({_SPHERE}/2589988, 6) AS area_sqmi FROM (SELECT parcel_id, part, ring,"
        " abs(sum(2*atan2(tan(radians(x2 - x1)/2)*(tan(radians(y1)/2) + tan(radians(y2)/2)),"
        " 1 + tan(radians(y1)/2)*tan(radians(y2)/2)))) AS e FROM parcel_edges GROUP BY 1, 2, 3) GROUP BY 1"
    ),
    "polygon_centroid": _centroid("parcel_edges", "parcel_id"),
    "points_in_areas": "SELECT event_id, area_id FROM in_county",
    "points_in_areas_shuffled": "SELECT event_id, area_id FROM in_county",
    **dict.fromkeys(
        ("points_in_areas_left", "points_in_areas_left_shuffled"),
        "SELECT h.event_id, CASE WHEN h.event_id % 19 <> 0 THEN h.LON END AS LON, c.area_id FROM hail h"
        " LEFT JOIN in_county c ON c.event_id = h.event_id AND h.event_id % 19 <> 0",
    ),
    "contains": (
        "SELECT p.address_id, count(*) > 0 AS inside FROM (SELECT a.address_id, a.LON, a.LAT,"
        " c.area_id FROM addresses a JOIN postcode_areas c USING (postcode)) p JOIN county_edges e"
        " ON e.area_id = p.area_id GROUP BY p.address_id"
        f" HAVING sum({_CROSSES}) % 2 = 1 AND sum({_TOUCHES}) = 0"
    ),
    "point_lookup_county": (
        "SELECT postcode, country, 'c' || area_id AS county_id, state_code FROM postcode_areas"
    ),
    "match_equal_areas": (
        f"SELECT a.parcel_id, b.plot_id FROM ({_corners('parcel_vertices', 'parcel_id')}) a"
        f" JOIN ({_corners('plot_vertices', 'plot_id')}) b USING (shape)"
    ),
    # Cut parcels cover the same cells of the raster that all corners lie on.
    "match_cut_areas": "SELECT parcel_id, cut_id FROM parcel_ground JOIN cut_ground USING (ground)",
    "export_wkt": _wkt("parcel_vertices", "parcel_id"),
    "ingest_wkt": "SELECT parcel_id, part, ring, i, x, y FROM parcel_vertices WHERE parcel_id % 50 <> 0",
    "ingest_wkt_rejects": (
        "SELECT c_custkey AS parcel_id FROM customer WHERE c_custkey % 50 = 0"
    ),
    "build_state_boundaries": "SELECT id, state_name, state_code FROM states",
    "states_loaded": "SELECT state_name, state_code FROM states",
    "build_postcode_areas": (
        "SELECT postcode, country, state_code, wkt AS area FROM postcode_areas"
        " JOIN county_wkt USING (area_id)"
    ),
    "check_county_area": (
        "SELECT postcode, country, round(sqmi, 4) AS area_sqmi, n_name AS county_name"
        " FROM postcode_areas JOIN nation ON n_nationkey = area_id"
    ),
    "address_count": "SELECT postcode, country, count(*) AS cnt FROM addresses GROUP BY 1, 2",
    "subset_state": "SELECT * FROM hail_state",
    "subset_county": "SELECT * FROM hail_county",
    "hail_counts_by_state": (
        "SELECT state_code, count(*) AS state_hail_count FROM hail_state GROUP BY 1"
    ),
    "hail_count_by_postcode": (
        "SELECT p.postcode, p.country, count(h.event_id) AS hail_count FROM postcode_areas p"
        " LEFT JOIN hail_county h USING (postcode) GROUP BY 1, 2"
    ),
    "risk_comparison": "SELECT * FROM risk",
    "risk_comparison_bulk": "SELECT * FROM risk",
    "risk_comparison_incremental": _risk_rows("mended_county_stats", "mended_state_stats"),
    "fetch_comparison": "SELECT * FROM comparison",
    "comparison_report": _METRIC_ROWS,
    "premium_adjustment": "SELECT * FROM premium",
    "missing_rows": (
        "SELECT p.postcode, p.country, NOT bool_or(r.area_type = 'county') AS county_missing,"
        " NOT bool_or(r.area_type = 'state') AS state_missing"
        " FROM (SELECT DISTINCT postcode, country FROM addresses) p JOIN"
        " (SELECT * FROM comparison WHERE area_type = 'county' OR area_id <> 'US-S2') r"
        " ON p.postcode = r.postcode GROUP BY 1, 2"
        " HAVING NOT bool_or(r.area_type = 'county') OR NOT bool_or(r.area_type = 'state')"
    ),
    "apply_decisions": (
        "SELECT p.*, coalesce(d.decision, 'Confirm') AS decision, coalesce(d.reason, '...') AS reason"
        " FROM premium p LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER"
        " (PARTITION BY postcode ORDER BY decision DESC, reason) AS rn FROM decisions"
        " WHERE decision IN ('Confirm', 'Reject')) WHERE rn = 1) d ON d.postcode = p.county_id"
    ),
    "worst_day": "SELECT postcode, 'US' AS country, date, event_count, max_size FROM worst",
    "worst_day_states": "SELECT postcode, country, state_code, date FROM worst JOIN postcode_areas USING (postcode)",
    "worst_day_layer": (
        "SELECT h.state_code, strftime(h.ZTIME, '%Y-%m-%d %H:%M:%S') AS ZTIME, h.LON, h.LAT, h.MAXSIZE,"
        " h.SEVPROB, h.PROB, strftime(h.ZTIME, '%Y-%m-%d') AS date FROM hail_state h"
        " WHERE (h.state_code, CAST(h.ZTIME AS DATE)) IN"
        " (SELECT (p.state_code, w.date) FROM worst w JOIN postcode_areas p USING (postcode))"
    ),
    "map_features": (
        "SELECT 'selected_county' AS layer, postcode AS name FROM postcode_areas WHERE postcode < '73010'"
        " UNION ALL SELECT 'map_center', state_code FROM states WHERE state_code IN ('US-S0', 'US-S1')"
        " UNION ALL SELECT 'counties', n_name FROM nation WHERE n_nationkey < 10"
    ),
    "upsert_state_boundary": (
        "SELECT id, upper(state_name) AS state_name, state_code, wkt AS geometry FROM states JOIN state_wkt USING (state_no)"
    ),
    "upsert_postcode_areas": (
        "SELECT postcode, country, state_code || 'x' AS state_code, wkt AS area FROM postcode_areas"
        " JOIN county_wkt USING (area_id)"
    ),
    "upsert_hail_state": _RELEASED.format(rows="hail_state"),
    "upsert_hail_county": _RELEASED.format(rows="hail_county"),
    "upsert_hail_events": (
        "SELECT * REPLACE (100 AS PROB, LON + 1 AS LON,"
        " CASE WHEN event_id % 3 = 0 THEN 'new' ELSE CELL_ID END AS CELL_ID) FROM first_events"
        " UNION ALL SELECT * FROM first_events WHERE event_id % 3 = 0"
    ),
    "map_layers_read_back": (
        "SELECT CASE WHEN CAST(postcode AS INT) % 5 = 0 THEN 'rejects' ELSE 'selected_county' END AS layer,"
        " postcode AS name, '' AS time, CAST(NULL AS DOUBLE) AS LON, CAST(NULL AS DOUBLE) AS LAT,"
        " CASE WHEN CAST(postcode AS INT) % 5 <> 0 THEN wkt END AS geometry"
        " FROM postcode_areas JOIN county_wkt USING (area_id)"
        " UNION ALL SELECT 'counties', n_name, '', NULL, NULL, wkt FROM county_wkt JOIN nation ON n_nationkey = area_id"
        " UNION ALL SELECT 'map_center', state_code, '', lon, lat, NULL FROM states JOIN"
        f" ({_centroid('state_edges', 'state_no')}) USING (state_no)"
        " UNION ALL SELECT 'hail', h.state_code, strftime(h.ZTIME, '%Y-%m-%d %H:%M:%S'), round(h.LON, 6), round(h.LAT, 6), NULL"
        " FROM hail_state h WHERE (h.state_code, CAST(h.ZTIME AS DATE)) IN"
        " (SELECT (p.state_code, w.date) FROM worst w JOIN postcode_areas p USING (postcode))"
    ),
    "map_layers_in_box": (
        "SELECT 'hail' AS layer, CAST(event_id AS VARCHAR) AS name, '' AS time, round(LON, 6) AS LON, round(LAT, 6) AS LAT,"
        " NULL AS geometry FROM hail WHERE LON BETWEEN -101.25 AND -98.5 AND LAT BETWEEN 32.0 AND 34.125"
        " UNION ALL SELECT 'counties', n_name, '', NULL, NULL, wkt FROM county_wkt JOIN nation ON n_nationkey = area_id"
        " WHERE area_id IN (SELECT area_id FROM county_vertices GROUP BY 1"
        " HAVING min(x) <= -98.5 AND max(x) >= -101.25 AND min(y) <= 34.125 AND max(y) >= 32.0)"
    ),
    "states_of_countries": (
        "SELECT id, state_name, state_code, wkt AS geometry FROM states JOIN state_wkt USING (state_no)"
        " UNION ALL SELECT 'm' || k, 'region ' || k, region, wkt FROM more_counties JOIN more_wkt USING (k) WHERE k < 5"
    ),
    "postcodes_of_countries": (
        "SELECT postcode, country, state_code, wkt AS area FROM places JOIN (SELECT 'c' || area_id AS area, wkt FROM county_wkt"
        " UNION ALL SELECT 'x' || k, wkt FROM more_wkt) USING (area)"
    ),
    "subset_county_of_countries": "SELECT * FROM all_hail_county",
    "risk_comparison_of_countries": "SELECT * FROM all_risk",
    "fetch_comparison_of_countries": "SELECT * FROM all_comparison",
    "fetch_comparison_named": "SELECT * FROM all_comparison WHERE postcode IN ('73001', '73004', '74005', '74006', '99999')",
    "premium_adjustment_of_countries": _premium("all_comparison"),
    "missing_rows_of_countries": (
        "SELECT p.postcode, p.country, count(r.area_id) FILTER (WHERE r.area_type = 'county') = 0 AS county_missing,"
        " count(r.area_id) FILTER (WHERE r.area_type = 'state') = 0 AS state_missing FROM places p LEFT JOIN all_comparison r"
        " ON r.postcode = p.postcode AND r.country = p.country GROUP BY 1, 2 HAVING county_missing OR state_missing"
    ),
    "worst_day_of_countries": (
        "SELECT postcode, country, date, event_count, max_size FROM (SELECT *, row_number() OVER"
        " (PARTITION BY postcode, country ORDER BY max_size DESC NULLS LAST, event_count DESC, date) AS rn FROM ("
        "SELECT postcode, country, CAST(ZTIME AS DATE) AS date, count(*) AS event_count,"
        " max(NULLIF(MAXSIZE, -999)) AS max_size FROM all_hail_county GROUP BY 1, 2, 3)) WHERE rn = 1"
    ),
    "refreshed_tables": _risk_of_countries("chain_county_stats", "chain_state_stats"),
    "counties_layer": (
        "SELECT n_name AS county_name, wkt AS geometry FROM county_wkt"
        " JOIN nation ON n_nationkey = area_id"
    ),
    "county_label": (
        "SELECT postcode, country, CASE WHEN area_id % 4 = 0 THEN 'County (' || postcode || ')'"
        " ELSE n_name END AS label FROM postcode_areas JOIN nation ON n_nationkey = area_id"
    ),
    "selected_county_layer": (
        "SELECT postcode, wkt AS geometry, 1 AS selected FROM postcode_areas"
        " JOIN county_wkt USING (area_id)"
    ),
    "map_center": (
        "SELECT state_code, lon, lat FROM states JOIN"
        f" ({_centroid('state_edges', 'state_no')}) USING (state_no)"
    ),
    "layer_features": (
        "SELECT '{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\",\"coordinates\":['"
        " || LON || ',' || LAT || ']},\"properties\":{\"event_id\":' || event_id"
        " || ',\"MAXSIZE\":' || MAXSIZE || ',\"timestamp\":\"'"
        " || strftime(ZTIME, '%Y-%m-%d %H:%M:%S') || '\"}}' AS value FROM hail"
    ),
    "assign_batches": (
        "SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ZTIME, event_id) - 1)/1000.0)"
        " AS BIGINT) AS batch_id FROM hail"
    ),
}


def _uses(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", text) is not None


def statement(final: str) -> str:
    """``final`` behind the relations it needs, directly or through others."""
    needed: list[str] = []
    text = final
    for name in reversed(RELATIONS):
        if _uses(text, name):
            needed.insert(0, name)
            text += " " + RELATIONS[name]
    if not needed:
        return final
    ctes = ", ".join(f"{name} AS MATERIALIZED ({RELATIONS[name]})" for name in needed)
    return f"WITH {ctes} {final}"


def oracle_sql() -> dict[str, str]:
    return {name: statement(final) for name, final in FINAL.items()}
