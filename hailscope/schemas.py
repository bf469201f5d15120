"""Column types and table layouts.

A polygon column is a multipolygon in one value: parts, each a list of rings
(ring 0 the shell, the others holes), each a closed list of vertices. A point
is a pair of DOUBLE columns, x = longitude and y = latitude.
"""

from __future__ import annotations

from pyspark.sql import types as T

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(VERTEX)
POLYGON = T.ArrayType(RING)
GEOMETRY = T.ArrayType(POLYGON)

# Field order of the published hail CSV files.
HAIL_CSV_COLUMNS = (
    "ZTIME", "LON", "LAT", "WSR_ID", "CELL_ID", "RANGE", "AZIMUTH", "SEVPROB", "PROB", "MAXSIZE",
)

HAIL_CSV = T.StructType([T.StructField(c, T.StringType()) for c in HAIL_CSV_COLUMNS])

# The whole line of a record with too many or too few fields.
BROKEN_LINE = "broken_line"

HAIL_TYPES = {
    "ZTIME": T.TimestampType(),
    "LON": T.DoubleType(),
    "LAT": T.DoubleType(),
    "WSR_ID": T.StringType(),
    "CELL_ID": T.StringType(),
    "RANGE": T.IntegerType(),
    "AZIMUTH": T.IntegerType(),
    "SEVPROB": T.IntegerType(),
    "PROB": T.IntegerType(),
    "MAXSIZE": T.DoubleType(),
}


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


_HAIL = tuple(HAIL_TYPES.items())

HAIL_RAW = _table(*_HAIL, ("postcode", T.StringType()))
HAIL_COUNTY = _table(*_HAIL, ("postcode", T.StringType()), ("country", T.StringType()))
HAIL_STATE = _table(*_HAIL, ("postcode", T.StringType()), ("state_code", T.StringType()))
HAIL_EVENTS = _table(*_HAIL, ("timestamp", T.TimestampType()))

POSTCODE_AREAS = _table(
    ("postcode", T.StringType()),
    ("country", T.StringType()),
    ("state_code", T.StringType()),
    ("area", GEOMETRY),
    ("created_at", T.TimestampType()),
)

STATE_BOUNDARY = _table(
    ("id", T.StringType()),
    ("state_name", T.StringType()),
    ("state_code", T.StringType()),
    ("geometry", GEOMETRY),
)

RISK_COMPARISON = _table(
    ("area_type", T.StringType()),
    ("area_id", T.StringType()),
    ("country", T.StringType()),
    ("event_count", T.LongType()),
    ("events_per_sqmi", T.DoubleType()),
    ("avg_hail_size", T.DoubleType()),
    ("max_hail_size", T.DoubleType()),
    ("avg_severe_prob", T.DoubleType()),
    ("avg_hail_prob", T.DoubleType()),
    ("damaging_events", T.LongType()),
    ("damaging_per_sqmi", T.DoubleType()),
    ("high_risk_events", T.LongType()),
    ("high_risk_per_sqmi", T.DoubleType()),
    ("area_sqmi", T.DoubleType()),
    ("updated_at", T.TimestampType()),
)

# Sums and counts per area and day, which add up to any window.
HAIL_DAILY = _table(
    ("kind", T.StringType()),
    ("area", T.StringType()),
    ("day", T.DateType()),
    ("events", T.LongType()),
    ("size_sum", T.DoubleType()),
    ("size_n", T.LongType()),
    ("size_max", T.DoubleType()),
    ("severe_sum", T.LongType()),
    ("severe_n", T.LongType()),
    ("prob_sum", T.LongType()),
    ("prob_n", T.LongType()),
    ("damaging", T.LongType()),
    ("high_risk", T.LongType()),
)

TABLES = {
    "hail_raw": HAIL_RAW,
    "hail_state": HAIL_STATE,
    "hail_county": HAIL_COUNTY,
    "hail_events": HAIL_EVENTS,
    "hail_daily": HAIL_DAILY,
    "postcode_areas": POSTCODE_AREAS,
    "state_boundary": STATE_BOUNDARY,
    "risk_comparison": RISK_COMPARISON,
}

# The hail tables grow without end; they are stored by month so that a merge
# rewrites only the months it touches and a time filter skips the rest.
MONTH_PARTITIONED = ("hail_raw", "hail_state", "hail_county", "hail_daily")
MONTH_COLUMN = "event_month"

# Merge keys and the columns a match updates ("*" = every column).
MERGE_KEYS = {
    "hail_raw": ("ZTIME", "LON", "LAT", "WSR_ID", "CELL_ID"),
    # A report may lie in two overlapping areas, and two radars may report one place.
    "hail_state": ("ZTIME", "LON", "LAT", "WSR_ID", "CELL_ID", "state_code"),
    "hail_county": ("ZTIME", "LON", "LAT", "WSR_ID", "CELL_ID", "postcode", "country"),
    "hail_events": ("ZTIME", "WSR_ID", "CELL_ID"),
    "postcode_areas": ("postcode", "country"),
    "state_boundary": ("id",),
    "risk_comparison": ("area_type", "area_id", "country"),
}
MEASUREMENTS = ("SEVPROB", "PROB", "MAXSIZE")
MERGE_UPDATES = {
    "hail_raw": MEASUREMENTS,
    "hail_state": MEASUREMENTS,
    "hail_county": MEASUREMENTS,
    "hail_events": "*",
    "postcode_areas": "*",
    "state_boundary": "*",
    "risk_comparison": "*",
}
# hail_raw fills every column but postcode on insert; the others fill all.
MERGE_INSERTS = {"hail_raw": HAIL_CSV_COLUMNS}
