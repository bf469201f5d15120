"""One query per operator and per product, on data derived from the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailscope.functions import geometry as geo
from hailscope.functions.dates import days_between, month_number, window_bounds
from hailscope.operators.batches import assign_batches
from hailscope.operators.dedup import first_per_key
from hailscope.operators.shapes import match_equal_areas
from hailscope.operators.spatial_join import points_in_areas
from hailscope.operators.upsert import upsert
from hailscope.plans import areas, daily, layers, load, risk, subset, workflow
from hailscope.schemas import BROKEN_LINE, HAIL_CSV_COLUMNS, MEASUREMENTS, MERGE_KEYS
from hailscope.sources import geojson, wkt
from hailscope.sources.hail_csv import read_hail_csv
from hailscope.sources.staging import run_folder, stage
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- inputs shared by several queries ----------------------------------------
# Tables that later steps read more than once are staged, as they are when the
# steps run one after another over stored tables.


def _states(spark, d, division_areas=None):
    shapes = fx.division_areas(spark, d) if division_areas is None else division_areas
    return areas.build_state_boundaries(fx.divisions(spark, d), shapes, fx.addresses(spark, d), "US")


def _postcode_areas(spark, d, division_areas=None):
    shapes = fx.division_areas(spark, d) if division_areas is None else division_areas
    return areas.build_postcode_areas(fx.addresses(spark, d), shapes, "US")


class _Stored:
    """The working tables, each staged when first read."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    @cached_property
    def division_areas(self) -> DataFrame:
        return stage(fx.division_areas(self.spark, self.d), "division_areas")

    @cached_property
    def states(self) -> DataFrame:
        return stage(_states(self.spark, self.d, self.division_areas), "state_boundary")

    @cached_property
    def postcode_areas(self) -> DataFrame:
        return stage(_postcode_areas(self.spark, self.d, self.division_areas), "postcode_areas")

    @cached_property
    def hail_state(self) -> DataFrame:
        return stage(subset.subset_state(fx.hail(self.spark, self.d), self.states), "hail_state")

    @property
    def hail_county(self) -> DataFrame:
        return subset.subset_county(self.hail_state, self.postcode_areas)

    @cached_property
    def risk(self) -> DataFrame:
        rows = risk.risk_comparison_bulk(
            self.hail_state, self.postcode_areas, self.states, fx.AS_OF
        )
        return stage(rows, "risk_comparison")

    @property
    def comparison(self) -> DataFrame:
        return risk.fetch_comparison(self.risk, self.postcode_areas, self.states)


class _BothCountries(_Stored):
    """The working tables of two countries, with a county without hail and a postcode without state."""

    @cached_property
    def inputs(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        divisions, shapes, addresses = fx.both_countries(self.spark, self.d)
        return divisions, stage(shapes, "division_areas"), addresses

    @property
    def division_areas(self) -> DataFrame:
        return self.inputs[1]

    @cached_property
    def states(self) -> DataFrame:
        return stage(areas.build_state_boundaries(*self.inputs), "state_boundary")

    @cached_property
    def postcode_areas(self) -> DataFrame:
        return stage(areas.build_postcode_areas(self.inputs[2], self.inputs[1]), "postcode_areas")


def _text(df: DataFrame, geometry: str) -> DataFrame:
    return df.withColumn(geometry, wkt.polygon_text(geometry))


# -- loading and checking ------------------------------------------------------


@query
def load_hail(spark, d):
    return load.load_hail(fx.hail_csv(spark, d), fx.START, fx.END)[0]


@query
def load_hail_rejects(spark, d):
    return load.load_hail(fx.hail_csv(spark, d), fx.START, fx.END)[1]


def _read_back(spark, d):
    """The lines written to files and read as CSV."""
    lines = stage(fx.hail_lines(spark, d), "hail-lines")
    path = f"{run_folder(spark)}/hail-csv-{uuid.uuid4().hex}"
    lines.write.text(path)
    return read_hail_csv(spark, path)


@query
def load_hail_csv(spark, d):
    return load.load_hail(_read_back(spark, d), fx.START, fx.END)[0]


@query
def load_hail_csv_rejects(spark, d):
    rejects = load.load_hail(_read_back(spark, d), fx.START, fx.END)[1]
    whole = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in HAIL_CSV_COLUMNS])
    return rejects.select(F.coalesce(BROKEN_LINE, whole).alias("line"))


@query
def dedup_latest(spark, d):
    return first_per_key(fx.hail_revisions(spark, d), MERGE_KEYS["hail_raw"], [F.desc("rev")])


@query
def filter_window(spark, d):
    return load.filter_window(fx.hail(spark, d), fx.START, fx.END)


@query
def filter_day(spark, d):
    stamps = fx.hail(spark, d).select(
        "event_id", F.date_format("ZTIME", "yyyyMMddHHmmss").alias("ZTIME")
    )
    return load.filter_day(stamps, "20240110")


@query
def filter_date(spark, d):
    return load.filter_date(fx.hail(spark, d), "2024-01-10").select("event_id", "ZTIME")


@query
def daily_dates(spark, d):
    day = F.to_date("ts")
    span = fx.table(spark, d, "events").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return span.select(F.explode(days_between("a", "b")).alias("day"))


@query
def load_windows(spark, d):
    runs = fx.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    start, end = window_bounds("run_date")
    return runs.select("run_date", start.alias("start_date"), end.alias("end_date"))


@query
def verify_hail(spark, d):
    return load.verify_hail(fx.hail_revisions(spark, d))


@query
def verify_hail_approx(spark, d):
    """By sketches; so few days and stations are still counted exactly."""
    return load.verify_hail(fx.hail_revisions(spark, d), approx=True)


@query
def distinct_estimates(spark, d):
    """Distinct counts from monthly sketches after a correction of one month, held against the exact ones."""
    hail = fx.hail(spark, d)
    corrected = hail.withColumn("CELL_ID", F.when(_in_january(), F.concat("CELL_ID", F.lit("x"))).otherwise(F.col("CELL_ID")))
    stored = stage(load.distinct_sketches(hail), "sketches")
    fresh = load.distinct_sketches(corrected.filter(_in_january()))
    estimates = load.distinct_estimates(load.merge_sketches(stored, fresh))
    exact = corrected.agg(*[F.count_distinct(value()).alias(name) for name, value in load.DISTINCT.items()])
    upright = [
        estimates.select(*[F.col(f"unique_{name}").alias(name) for name in load.DISTINCT]).unpivot([], list(load.DISTINCT), "figure", "estimate"),
        exact.unpivot([], list(load.DISTINCT), "figure", "exact"),
    ]
    near = F.abs(F.col("estimate") - F.col("exact")) <= load.SKETCH_ERROR * F.col("exact")
    return upright[0].join(upright[1], "figure").select("figure", "exact", near.alias("near"))


def _in_january():
    return F.date_trunc("month", "ZTIME") == F.lit("2024-01-01").cast("timestamp")


@query
def transpose_summary(spark, d):
    return load.transpose_summary(load.verify_hail(fx.hail_revisions(spark, d)))


@query
def daily_counts(spark, d):
    return load.daily_counts(fx.hail(spark, d))


@query
def table_counts(spark, d):
    return load.table_counts(
        {
            "hail_raw": fx.hail(spark, d),
            "addresses": fx.addresses(spark, d),
            "parcel_vertices": fx.derive(spark, d, fx.PARCEL_VERTICES),
        }
    )


@query
def assign_batches_(spark, d):
    rows = fx.hail(spark, d).select("event_id", "ZTIME")
    return assign_batches(rows, ["ZTIME", "event_id"], 1000).select("event_id", "batch_id")


_QUERIES["assign_batches"] = _QUERIES.pop("assign_batches_")


# -- merges --------------------------------------------------------------------


@query
def upsert_hail_raw(spark, d):
    target = fx.hail(spark, d).select(
        *HAIL_CSV_COLUMNS, F.col("event_id").cast("string").alias("postcode")
    )
    moved = F.when(F.col("event_id") % 40 == 0, F.col("LON") + 0.5).otherwise(F.col("LON"))
    source = fx.hail(spark, d, rev=1).withColumn("LON", moved)
    return upsert(
        target, source, MERGE_KEYS["hail_raw"], update=MEASUREMENTS, insert=HAIL_CSV_COLUMNS
    )


@query
def upsert_all_columns(spark, d):
    h = fx.hail(spark, d)

    def stations(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col("WSR_ID").alias("area_id")).agg(
            F.count(F.lit(1)).alias("event_count"),
            F.max(F.nullif("MAXSIZE", F.lit(-999))).alias("max_hail_size"),
        ).select(
            F.lit("station").alias("area_type"), "area_id", F.lit("US").alias("country"), "event_count", "max_hail_size"
        )

    split = F.lit("2024-01-10 00:00:00").cast("timestamp")
    moved = F.when(F.col("WSR_ID") > "K010", F.col("WSR_ID")).otherwise(F.concat(F.lit("N"), "WSR_ID"))
    before = stations(h.filter(F.col("ZTIME") < split))
    after = stations(h.filter(F.col("ZTIME") >= split).withColumn("WSR_ID", moved))
    return upsert(before, after, MERGE_KEYS["risk_comparison"])


@query
def upsert_state_boundary(spark, d):
    """States under new names, one of them not stored yet."""
    built = _states(spark, d).select("id", "state_name", "state_code", "geometry")
    merged = upsert(
        built.filter("id <> 's1'"),
        built.withColumn("state_name", F.upper("state_name")),
        MERGE_KEYS["state_boundary"],
    )
    return _text(merged, "geometry")


@query
def upsert_postcode_areas(spark, d):
    """Postcodes with another state code and without a shape before, every fifth not stored yet."""
    built = _postcode_areas(spark, d).select("postcode", "country", "state_code", "area")
    merged = upsert(
        built.filter("int(postcode) % 5 <> 0").withColumn("area", F.slice("area", 1, 0)),
        built.withColumn("state_code", F.concat("state_code", F.lit("x"))),
        MERGE_KEYS["postcode_areas"],
    )
    return _text(merged, "area")


def _more_severe(rows):
    return rows.withColumn("PROB", F.lit(100)).withColumn("CELL_ID", F.when(F.col("event_id") % 3 == 0, F.lit("new")).otherwise(F.col("CELL_ID")))


@query
def upsert_hail_state(spark, d):
    """A second release of every report; every third as a cell of its own."""
    rows = _Stored(spark, d).hail_state
    return upsert(rows, _more_severe(rows), MERGE_KEYS["hail_state"], update=MEASUREMENTS)


@query
def upsert_hail_county(spark, d):
    rows = stage(_Stored(spark, d).hail_county, "hail_county")
    return upsert(rows, _more_severe(rows), MERGE_KEYS["hail_county"], update=MEASUREMENTS)


@query
def upsert_hail_events(spark, d):
    """Keyed by time, radar and cell: the place changes with a match."""
    key = MERGE_KEYS["hail_events"]
    rows = first_per_key(fx.hail(spark, d).withColumn("timestamp", F.col("ZTIME")), key, ["event_id"])
    return upsert(rows, _more_severe(rows).withColumn("LON", F.col("LON") + 1), key)


# -- geometry ------------------------------------------------------------------


@query
def web_mercator(spark, d):
    return fx.hail(spark, d).select(
        "event_id",
        F.round(geo.mercator_x("LON"), 3).alias("x"),
        F.round(geo.mercator_y("LAT"), 3).alias("y"),
    )


@query
def point_centroid(spark, d):
    centres = areas.point_centroid(fx.addresses(spark, d), ["postcode", "country"])
    return centres.select(
        "postcode", "country", F.round("LON", 9).alias("LON"), F.round("LAT", 9).alias("LAT")
    )


@query
def area_sqmi(spark, d):
    return fx.parcels(spark, d).select(
        "parcel_id", F.round(geo.area_sqmi("geometry"), 6).alias("area_sqmi")
    )


@query
def area_sqmi_sphere(spark, d):
    return fx.parcels(spark, d).select(
        "parcel_id", F.round(geo.area_sqmi("geometry", method="sphere"), 6).alias("area_sqmi")
    )


@query
def polygon_centroid(spark, d):
    return fx.parcels(spark, d).select("parcel_id", geo.centroid("geometry").alias("c")).select(
        "parcel_id", F.round("c.x", 6).alias("lon"), F.round("c.y", 6).alias("lat")
    )


@query
def points_in_areas_(spark, d):
    pairs = points_in_areas(fx.hail(spark, d), fx.counties(spark, d), ["area_id"])
    return pairs.select("event_id", "area_id")


_QUERIES["points_in_areas"] = _QUERIES.pop("points_in_areas_")


@query
def points_in_areas_shuffled(spark, d):
    """The way taken when the index is too large to broadcast."""
    pairs = points_in_areas(
        fx.hail(spark, d).select("event_id", "LON", "LAT"),
        fx.counties(spark, d),
        ["area_id"],
        broadcast_bytes=0,
        points_per_task=500,
    )
    return pairs.select("event_id", "area_id")


@query
def points_in_areas_left(spark, d):
    """Points in no area too, once each; every 19th report has no place."""
    pairs = points_in_areas(_some_without_place(spark, d), fx.counties(spark, d), ["area_id"], how="left")
    return pairs.select("event_id", "LON", "area_id")


@query
def points_in_areas_left_shuffled(spark, d):
    """The same when the index is too large to broadcast, with split tiles."""
    pairs = points_in_areas(
        _some_without_place(spark, d), fx.counties(spark, d), ["area_id"],
        how="left", broadcast_bytes=0, points_per_task=20,
    )
    return pairs.select("event_id", "LON", "area_id")


def _some_without_place(spark, d):
    placed = F.when(F.col("event_id") % 19 != 0, F.col("LON")).alias("LON")
    return fx.hail(spark, d).select("event_id", placed, "LAT")


@query
def contains(spark, d):
    held = fx.addresses(spark, d).join(_postcode_areas(spark, d), ["postcode", "country"])
    inside = geo.contains("area", "LON", "LAT")
    return held.select("address_id", inside.alias("inside")).filter("inside")


@query
def point_lookup_county(spark, d):
    return areas.locate_postcodes(fx.addresses(spark, d), fx.division_areas(spark, d), "US")


@query
def match_equal_areas_(spark, d):
    return match_equal_areas(
        fx.parcels(spark, d), fx.plots(spark, d), left_geometry="geometry", right_geometry="plot"
    ).select("parcel_id", "plot_id")


_QUERIES["match_equal_areas"] = _QUERIES.pop("match_equal_areas_")


@query
def match_cut_areas(spark, d):
    """Parcels found again where they are cut in two."""
    return match_equal_areas(
        fx.parcels(spark, d), fx.cuts(spark, d), left_geometry="geometry", right_geometry="cut"
    ).select("parcel_id", "cut_id")


@query
def export_wkt(spark, d):
    return wkt.export_wkt(fx.parcels(spark, d))


def _parcel_texts(spark, d):
    """Every fiftieth text is cut short."""
    cut = F.when(F.col("parcel_id") % 50 == 0, r"\)+$").otherwise("^$")
    texts = wkt.export_wkt(fx.parcels(spark, d))
    return texts.withColumn("wkt", F.regexp_replace("wkt", cut, F.lit("")))


@query
def ingest_wkt(spark, d):
    return wkt.ingest_wkt(_parcel_texts(spark, d), "parcel_id", "wkt")[0]


@query
def ingest_wkt_rejects(spark, d):
    return wkt.ingest_wkt(_parcel_texts(spark, d), "parcel_id", "wkt")[1].select("parcel_id")


# -- areas and subsets ---------------------------------------------------------


@query
def build_state_boundaries(spark, d):
    return _states(spark, d).select("id", "state_name", "state_code")


@query
def states_loaded(spark, d):
    return areas.states_loaded(_states(spark, d))


@query
def build_postcode_areas(spark, d):
    return _text(_postcode_areas(spark, d).drop("created_at"), "area")


@query
def check_county_area(spark, d):
    checked = areas.check_county_area(_postcode_areas(spark, d), fx.division_areas(spark, d))
    return checked.withColumn("area_sqmi", F.round("area_sqmi", 4)).drop("created_at")


@query
def address_count(spark, d):
    return areas.address_count(fx.addresses(spark, d))


@query
def subset_state(spark, d):
    return subset.subset_state(fx.hail(spark, d), _states(spark, d))


@query
def subset_county(spark, d):
    stored = _Stored(spark, d)
    unstored = subset.subset_state(fx.hail(spark, d), stored.states)
    return subset.subset_county(unstored, stored.postcode_areas)


@query
def hail_counts_by_state(spark, d):
    return subset.hail_counts_by_state(subset_state(spark, d))


@query
def hail_count_by_postcode(spark, d):
    stored = _Stored(spark, d)
    return subset.hail_count_bulk(stored.hail_state, stored.postcode_areas)


# -- risk ------------------------------------------------------------------------


@query
def risk_comparison(spark, d):
    stored = _Stored(spark, d)
    return risk.risk_comparison(
        stored.hail_county, stored.hail_state, stored.postcode_areas, stored.states, fx.AS_OF
    ).drop("updated_at")


@query
def risk_comparison_bulk(spark, d):
    stored = _Stored(spark, d)
    return risk.risk_comparison_bulk(
        stored.hail_state, stored.postcode_areas, stored.states, fx.AS_OF
    ).drop("updated_at")


@query
def risk_comparison_incremental(spark, d):
    """Daily sums, brought up to date after a late correction in the months it touches, then compared."""
    stored = _Stored(spark, d)
    before = stage(daily.daily_partials(stored.hail_state, stored.postcode_areas), "hail-daily")
    late = fx.hail(spark, d, rev=1)
    months = [r[0] for r in late.select(month_number(F.col("ZTIME"))).distinct().collect()]
    touched = stored.hail_state.filter(month_number(F.col("ZTIME")).isin(months))
    placed = subset.subset_state(late, stored.states)
    mended = upsert(touched, placed, MERGE_KEYS["hail_state"], update=MEASUREMENTS)
    fresh = daily.daily_partials(stage(mended, "hail-mended"), stored.postcode_areas)
    after = daily.replace_months(before, fresh, months)
    rows = daily.risk_comparison_daily(after, stored.postcode_areas, stored.states, fx.AS_OF)
    return rows.drop("updated_at")


@query
def fetch_comparison(spark, d):
    return _Stored(spark, d).comparison.drop("updated_at")


@query
def comparison_report(spark, d):
    return risk.comparison_report(_Stored(spark, d).comparison)


@query
def premium_adjustment(spark, d):
    return risk.premium_adjustment(_Stored(spark, d).comparison)


@query
def missing_rows(spark, d):
    """One state's rows withheld."""
    stored = _Stored(spark, d)
    partial = stored.comparison.filter("area_type = 'county' OR area_id <> 'US-S2'")
    return risk.missing_rows(partial, stored.postcode_areas)


@query
def apply_decisions(spark, d):
    return risk.apply_decisions(premium_adjustment(spark, d), fx.decisions(spark, d))


# -- map layers --------------------------------------------------------------------


# -- two countries ---------------------------------------------------------------


@query
def states_of_countries(spark, d):
    built = _BothCountries(spark, d).states
    return _text(built.select("id", "state_name", "state_code", "geometry"), "geometry")


@query
def postcodes_of_countries(spark, d):
    """One postcode number may be in both countries, and one postcode has no state."""
    return _text(_BothCountries(spark, d).postcode_areas.drop("created_at"), "area")


@query
def subset_county_of_countries(spark, d):
    return _BothCountries(spark, d).hail_county


@query
def risk_comparison_of_countries(spark, d):
    """Counties without hail have a row of zeros."""
    return _BothCountries(spark, d).risk.drop("updated_at")


@query
def fetch_comparison_of_countries(spark, d):
    """A postcode without state is shown beside the first state."""
    return _BothCountries(spark, d).comparison.drop("updated_at")


@query
def fetch_comparison_named(spark, d):
    """Named postcodes alone, in every country that has them."""
    stored = _BothCountries(spark, d)
    named = ["73001", "73004", "74005", "74006", "99999"]
    return risk.fetch_comparison(stored.risk, stored.postcode_areas, stored.states, named).drop("updated_at")


@query
def premium_adjustment_of_countries(spark, d):
    return risk.premium_adjustment(_BothCountries(spark, d).comparison)


@query
def missing_rows_of_countries(spark, d):
    stored = _BothCountries(spark, d)
    return risk.missing_rows(stored.comparison, stored.postcode_areas)


@query
def worst_day_of_countries(spark, d):
    stored = _BothCountries(spark, d)
    return layers.worst_day_bulk(stored.hail_state, stored.postcode_areas)


@query
def refreshed_tables(spark, d):
    """The whole chain over catalog tables, loaded in two parts, the second with corrections; counts and figures."""
    db = f"hailscope_{uuid.uuid4().hex[:12]}"
    divisions, shapes, addresses = fx.both_countries(spark, d)
    csv = stage(fx.hail_csv(spark, d), "raw")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{run_folder(spark)}/{db}'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # months are cut there
    try:
        for start, end in ((fx.START, "2024-01-14 00:00:00"), ("2024-01-12 00:00:00", fx.END)):
            workflow.refresh_tables(
                spark, db, csv, divisions, shapes, addresses, start=start, end=end, as_of=fx.AS_OF, country=None, only_window=True
            )
        stored = stage(spark.table(f"{db}.risk_comparison").drop("updated_at"), "refreshed")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
        spark.conf.set("spark.sql.session.timeZone", zone)
    return stored


# -- layers ------------------------------------------------------------------------


@query
def worst_day(spark, d):
    stored = _Stored(spark, d)
    return layers.worst_day_bulk(stored.hail_state, stored.postcode_areas)


@query
def worst_day_states(spark, d):
    stored = _Stored(spark, d)
    return layers.worst_day_states(worst_day(spark, d), stored.postcode_areas, stored.states)


@query
def worst_day_layer(spark, d):
    stored = _Stored(spark, d)
    worst = stage(layers.worst_day_bulk(stored.hail_state, stored.postcode_areas), "worst_day")
    return layers.worst_day_layer(
        stored.hail_state, worst, stored.postcode_areas, stored.states
    )


@query
def counties_layer(spark, d):
    return _text(layers.counties_layer(fx.division_areas(spark, d)), "geometry")


@query
def county_label(spark, d):
    """Every fourth county is absent from the division table."""
    known = fx.division_areas(spark, d).filter(
        "subtype <> 'county' OR int(substr(id, 2)) % 4 <> 0"
    )
    return layers.county_label(known, _postcode_areas(spark, d))


@query
def selected_county_layer(spark, d):
    return _text(layers.selected_county_layer(_postcode_areas(spark, d)), "geometry")


@query
def map_center(spark, d):
    return layers.map_center(_states(spark, d)).select(
        "state_code", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


@query
def map_features(spark, d):
    """The map of the first ten postcodes, which lie in two states: all its layers as features."""
    stored = _Stored(spark, d)
    shown = stored.postcode_areas.filter(F.col("postcode") < "73010")
    worst = stage(layers.worst_day_bulk(stored.hail_state, shown), "worst_day")
    got = layers.map_layers(stored.hail_state, worst, stored.division_areas, shown, stored.states)
    names = {"counties": F.col("county_name"), "map_center": F.col("state_code"), "selected_county": F.col("postcode")}
    return reduce(
        DataFrame.unionByName,
        [got[n].select(F.lit(n).alias("layer"), c.alias("name")) for n, c in names.items()],
    )


@query
def map_layers_read_back(spark, d):
    """All layers of the whole map, with their shapes, written as files by tile and read again.

    Every fifth selected county has lost its shape, so it is among the rejects.
    """
    stored = _Stored(spark, d)
    worst = stage(layers.worst_day_bulk(stored.hail_state, stored.postcode_areas), "worst_day")
    got = dict(layers.map_layers(stored.hail_state, worst, stored.division_areas, stored.postcode_areas, stored.states))
    lost = F.when(F.col("postcode").cast("int") % 5 != 0, F.col("geometry")).alias("geometry")
    got["selected_county"] = got["selected_county"].withColumn("geometry", lost)
    path = f"{run_folder(spark)}/layers-{uuid.uuid4().hex}"
    geojson.write_layers(got, path)
    return reduce(DataFrame.unionByName, [_layer_rows(geojson.read_layer(spark, path, n)) for n in (*got, geojson.REJECTS)])


@query
def map_layers_in_box(spark, d):
    """The counties and the hail that a map section shows, from the tiles that it meets."""
    stored = _Stored(spark, d)
    counties = layers.counties_layer(stored.division_areas)
    hail = fx.hail(spark, d).select("event_id", "LON", "LAT")
    path = f"{run_folder(spark)}/layers-{uuid.uuid4().hex}"
    geojson.write_layers({"counties": counties, "hail": hail}, path)
    box = (-101.25, 32.0, -98.5, 34.125)
    return reduce(DataFrame.unionByName, [_layer_rows(geojson.read_layer(spark, path, n, box)) for n in ("counties", "hail")])


def _layer_rows(layer: DataFrame) -> DataFrame:
    """Layer, name and shape of every feature as text."""
    name = F.coalesce(*[F.col("properties")[c] for c in ("postcode", "county_name", "event_id", "state_code")])
    day = F.coalesce(F.col("properties")["ZTIME"], F.lit("")).alias("time")
    place = [F.round(c, 6).alias(c) for c in ("LON", "LAT")]
    return layer.select("layer", name.alias("name"), day, *place, wkt.polygon_text("geometry").alias("geometry"))


@query
def layer_features(spark, d):
    rows = fx.hail(spark, d).select(
        "event_id", "LON", "LAT", "MAXSIZE", F.col("ZTIME").alias("timestamp")
    )
    return geojson.features(rows)
