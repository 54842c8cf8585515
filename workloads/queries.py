"""Every registered query: name -> function of (spark, folder of test tables)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyfare import operators as op
from skyfare.functions import safe_double, safe_int
from skyfare.operators import quality
from skyfare.operators.lookup import BROADCAST_SETTING
from skyfare.plans import (
    Check,
    Sources,
    TableStore,
    build_models,
    ingest_trips,
    ingest_weather,
    model_checks,
    run_checks,
)
from skyfare.plans.checks import ChecksFailed, enforce_checks
from skyfare.plans.ingest import weather_rows
from skyfare.scratch import Held, hold, scratch_path
from skyfare.sinks import (
    above_high_water,
    append,
    append_evolving,
    as_view,
    ensure_table,
    incremental,
    materialize,
    upsert,
)
from skyfare.sources import (
    borough_station,
    file_stats,
    loaded_files,
    new_files,
    parse_weather_lines,
    prune_files,
    read_columns,
    read_weather,
    stations_frame,
)
from skyfare.streaming import stream_trips, stream_weather
from workloads import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIE = 3e-9  # moves an exact tie off the edge, so both engines round it the same way


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps it apart from an operator."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def tidy(df: DataFrame) -> DataFrame:
    """Results in a form two engines agree on: doubles to six places, times as text."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(TIE), 6)
        elif isinstance(f.dataType, (T.TimestampNTZType, T.DateType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def new_table(spark: SparkSession, what: str) -> tuple[str, str]:
    """A table name of its own and a place for it in the shared folder."""
    return f"skyfare_{what}_{uuid.uuid4().hex}", scratch_path(spark, what)


# --- fixture A, model by model -------------------------------------------------------------------


def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return op.stg_yellow_trips(fx.trips_a(spark, sf))


def _mapping(spark: SparkSession, sf: str) -> DataFrame:
    return op.zone_station_mapping(
        fx.taxi_zone(spark, sf), borough_station(spark, fx.BOROUGHS), fx.weather_a(spark, sf)
    )


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    return op.weather_hourly(op.stg_weather_data(fx.weather_a(spark, sf)))


def _lookups(spark: SparkSession, sf: str) -> tuple[Held, Held]:
    return hold(_mapping(spark, sf), "mapping"), hold(_hourly(spark, sf), "hourly")


def _validated(spark: SparkSession, sf: str, lookups: tuple[Held, Held] | None = None) -> DataFrame:
    mapping, hourly = lookups or _lookups(spark, sf)
    return op.trips_validated(_stg(spark, sf), mapping, hourly, fx.A_AS_OF, fx.A_MIN_DATE)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return op.facts(_stg(spark, sf), *_lookups(spark, sf), fx.A_AS_OF, fx.A_MIN_DATE)


@query
def stg_trips(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_stg(spark, sf))


@query
def stg_weather(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.stg_weather_data(fx.weather_a(spark, sf)))


@query
def zone_station_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf)


@query
def latest_per_station(spark: SparkSession, sf: str) -> DataFrame:
    """Stations here are users, and their name and zone change between observations."""
    weather = fx.weather_a(spark, sf)
    changing = fx.table(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("station"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("valid"),
        F.col("event_type").alias("station_name"),
        F.concat(F.lit("z"), (F.col("event_id") % 5).cast("string")).alias("station_zone"),
    )
    fixed = weather.select("station", "valid", "station_name", "station_zone")
    return op.latest_per_station(fixed.unionByName(changing))


@query
def weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_hourly(spark, sf))


@query
def trips_validated(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_validated(spark, sf))


@query
def quality_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf).groupBy("data_quality_check").agg(F.count(F.lit(1)).alias("trips"))


@query
def missing_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf).groupBy("missing_values_flag").agg(F.count(F.lit(1)).alias("trips"))


@query
def valid_date_counts(spark: SparkSession, sf: str) -> DataFrame:
    flags = ("is_valid_pickup_date", "is_valid_dropoff_date")
    return _validated(spark, sf).groupBy(*flags).agg(F.count(F.lit(1)).alias("trips"))


@query
def trips_with_weather(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_fact(spark, sf))


@query
def trips_with_weather_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Stations are renamed between observations, so an hour may be listed twice: both lookups then
    multiply the trip, and the fact table has each of its rows k times k."""
    weather = fx.weather_a(spark, sf)
    renamed = weather.withColumn(
        "station_name", F.concat("station_name", F.when(F.col("tmpf") < 40, " north").otherwise(" south"))
    )
    mapping = op.zone_station_mapping(fx.taxi_zone(spark, sf), borough_station(spark, fx.BOROUGHS), renamed)
    lookups = hold(mapping, "mapping"), hold(op.weather_hourly(op.stg_weather_data(renamed)), "hourly")
    fact = op.facts(_stg(spark, sf), *lookups, fx.A_AS_OF, fx.A_MIN_DATE)
    return tidy(
        fact.groupBy("pickup_date", "weather_station", "station_name", "weather_condition").agg(
            F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fares")
        )
    )


@query
def daily_trips_all(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_trips_all(_validated(spark, sf)))


@query
def daily_trips_valid(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_trips_valid(_validated(spark, sf)))


@query
def daily_data_quality(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_data_quality(_validated(spark, sf)))


@query
def pickup_zone_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.zone_metrics(_validated(spark, sf), "pickup_location_id", "Pickup"))


@query
def dropoff_zone_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.zone_metrics(_validated(spark, sf), "dropoff_location_id", "Dropoff"))


@query
def zone_analysis(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.zone_analysis(fx.taxi_zone(spark, sf), _validated(spark, sf)))


@query
def daily_weather_impact(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_weather_impact(_fact(spark, sf)))


def _shuffled(name: str) -> Query:
    """A query with every lookup joined by shuffle, however small it is."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        before = spark.conf.get(BROADCAST_SETTING, None)
        spark.conf.set(BROADCAST_SETTING, "0")
        try:
            return QUERIES[name](spark, sf)
        finally:
            spark.conf.unset(BROADCAST_SETTING) if before is None else spark.conf.set(BROADCAST_SETTING, before)

    return run


QUERIES["trips_validated_shuffled"] = _shuffled("trips_validated")
QUERIES["daily_weather_impact_shuffled"] = _shuffled("daily_weather_impact")


@query
def zone_weather_performance(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.zone_weather_performance(_fact(spark, sf)))


@query
def model_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole build into tables, as rows per model."""
    run = uuid.uuid4().hex
    store = TableStore(f"skyfare_{run}_", scratch_path(spark, "models"))
    sources = Sources(fx.trips_a(spark, sf), fx.weather_a(spark, sf), fx.taxi_zone(spark, sf))
    models = build_models(spark, sources, fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("model"), "n_rows")
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, counts)


FIRST_AS_OF = dt.date(2024, 3, 22)  # the last settled day is then the 22nd, and later the 28th of January


def second_run_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Trips of two files: the second has the later days and some late trips of the 5th."""
    at = F.col("tpep_pickup_datetime")
    late = (F.to_date(at) == F.lit(dt.date(2024, 1, 5))) & (F.minute(at) < 20)
    second = (at >= F.lit("2024-01-21").cast("timestamp_ntz")) | late
    return fx.trips_a(spark, sf).withColumn("source_file", F.when(second, "second").otherwise("first"))


def second_run_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Weather, of which some of the 10th and all after the 22nd comes late."""
    at = F.col("valid")
    late = (at >= F.lit("2024-01-23").cast("timestamp_ntz")) | ((F.to_date(at) == F.lit(dt.date(2024, 1, 10))) & (F.minute(at) < 30))
    return fx.weather_a(spark, sf).withColumn("late", late)


def _content(model: str, df: DataFrame) -> DataFrame:
    """(model, column, n, total): values that are there, and their sum; of text its length, of days those since 2020."""

    def total(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.length(c)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_diff(c, F.lit(dt.date(2020, 1, 1)))
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.hour(c)
        return F.round(F.sum(c.cast("double")) + F.lit(TIE), 3)

    columns = [f for f in df.schema.fields]
    parts = [F.struct(F.lit(f.name).alias("column"), F.count(f"`{f.name}`").alias("n"), total(f).alias("total")) for f in columns]
    return df.agg(F.array(*parts).alias("c")).select(F.lit(model).alias("model"), F.inline("c"))


@query
def build_models_second_run(spark: SparkSession, sf: str) -> DataFrame:
    """All twelve tables after a second load and build, column by column: late trips, late weather, a later day."""
    run = uuid.uuid4().hex
    store = TableStore(f"skyfare_{run}_", scratch_path(spark, "models"))
    trips, weather, zones = second_run_trips(spark, sf), second_run_weather(spark, sf), fx.taxi_zone(spark, sf)
    first = Sources(trips.where("source_file = 'first'"), weather.where("NOT late"), zones)
    build_models(spark, first, FIRST_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    models = build_models(spark, Sources(trips, weather, zones), fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    return reduce(DataFrame.unionByName, [_content(name, df) for name, df in models.items()])


# --- fixture B: volume ---------------------------------------------------------------------------


def _validated_b(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled by the trip-only rules: every trip is given a station and a weather condition."""
    given = {c: F.lit("given") for c in ("station_id", "station_name", "station_zone", "weather_condition")}
    trips = op.stg_yellow_trips(fx.trips_b(spark, sf)).withColumns(given)
    return op.label_trips(trips, fx.B_AS_OF, fx.B_MIN_DATE)


@query
def quality_label_counts_b(spark: SparkSession, sf: str) -> DataFrame:
    return _validated_b(spark, sf).groupBy("data_quality_check").agg(F.count(F.lit(1)).alias("trips"))


@query
def daily_trips_all_b(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_trips_all(_validated_b(spark, sf)))


@query
def daily_trips_valid_b(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_trips_valid(_validated_b(spark, sf)))


@query
def daily_data_quality_b(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.daily_data_quality(_validated_b(spark, sf)))


@query
def zone_analysis_b(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.zone_analysis(fx.taxi_zone(spark, sf), _validated_b(spark, sf)))


# --- casts and cleaning --------------------------------------------------------------------------


@query
def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    """Half values round away from zero; text that is no number is NULL."""
    events = fx.table(spark, sf, "events").select(
        "event_id",
        ((F.col("event_id") % 41 - 20) / 2).alias("half"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("mixed"),
        F.concat(
            F.col("user_id").cast("string"),
            F.element_at(F.array(*[F.lit(s) for s in ("", "d", ".5f", ".5")]), (F.col("event_id") % 4 + 1).cast("int")),
        ).alias("suffixed"),
    )
    return events.select(
        "event_id",
        safe_int(events, "half").alias("half_as_int"),
        safe_int(events, "mixed").alias("mixed_as_int"),
        safe_double("mixed").alias("mixed_as_double"),
        safe_double("suffixed").alias("suffixed_as_double"),
    )


def _text_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells as a weather file would hold them: numbers, missing-value tokens, junk."""
    tokens = F.array(*[F.lit(t) for t in ("M", "NA", "None", "null", "", "nan", "NaN", "T")])
    which = F.col("event_id") % 10
    events = fx.table(spark, sf, "events")
    return events.select(
        "event_id",
        F.when(which < 8, F.get(tokens, which.cast("int")))
        .otherwise(F.col("value").cast("string"))
        .alias("tmpf"),
        F.when(F.col("event_id") % 4 == 0, F.lit("M"))
        .otherwise(F.substring(F.col("ts").cast("string"), 1, 16))
        .alias("valid"),
    )


@query
def clean_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.clean_numeric(_text_cells(spark, sf), ["tmpf"]).select("event_id", "tmpf"))


@query
def parse_valid(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(op.parse_valid(_text_cells(spark, sf)).select("event_id", "valid"))


@query
def hour_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Trips per hour bucket and weekday."""
    trips = _stg(spark, sf).groupBy("pickup_hour_rounded", "pickup_weekday")
    return tidy(trips.agg(F.count(F.lit(1)).alias("trips")))


@query
def views_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Staged trips and the zone table found by name, each behind a view."""
    trips, zones = (f"skyfare_{what}_{uuid.uuid4().hex}" for what in ("stg", "zones"))
    as_view(_stg(spark, sf), trips)
    as_view(fx.taxi_zone(spark, sf), zones)
    joined = spark.table(trips).join(
        spark.table(zones), F.col("pickup_location_id") == F.col("LocationID")
    )
    return joined.groupBy("Borough").agg(F.count(F.lit(1)).alias("trips"))


@query
def column_subset(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["l_orderkey", "l_linenumber", "l_quantity", "no_such_column"]
    return read_columns(spark, f"{sf}/lineitem.parquet", wanted)


@query
def config_projection(spark: SparkSession, sf: str) -> DataFrame:
    fields = [
        {"name": "o_orderkey"},
        {"name": "order_year", "transformation": "CAST(year(o_orderdate) AS BIGINT)"},
        {"name": "is_urgent", "transformation": "o_orderpriority LIKE '1%'"},
    ]
    return op.project(fx.table(spark, sf, "orders"), fields)


@query
def station_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.weather_a(spark, sf).select(F.col("station").alias("file_station"))
    named = op.station_lookup(rows, stations_frame(spark, fx.STATION_LIST))
    return named.groupBy("file_station", "station_name", "station_zone").agg(
        F.count(F.lit(1)).alias("observations")
    )


# --- files, ledger, coverage ---------------------------------------------------------------------


def _file_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as rows of daily files, `<event type>_<day>.csv`; one type has no day in its name."""
    day = F.date_format("ts", "yyyyMMdd")
    name = F.when(F.col("event_type") == "view", F.lit("view.csv")).otherwise(
        F.concat_ws("_", "event_type", F.concat(day, F.lit(".csv")))
    )
    return fx.table(spark, sf, "events").select("event_id", "ts", name.alias("source_file"))


@query
def loaded_files_(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger of a table that has some of the files, and rows that came from no file."""
    rows = _file_rows(spark, sf)
    name, path = new_table(spark, "ledger")
    some = rows.withColumn("source_file", F.when(F.dayofmonth("ts") <= 10, F.col("source_file")))
    materialize(some.select("event_id", "source_file"), name, path=path)
    return loaded_files(spark, name)


@query
def new_files_(spark: SparkSession, sf: str) -> DataFrame:
    rows = _file_rows(spark, sf)
    loaded = rows.where(F.dayofmonth("ts") <= 10).select("source_file").distinct()
    return new_files(rows.select("source_file").distinct(), loaded)


@query
def prune_files_(spark: SparkSession, sf: str) -> DataFrame:
    files = _file_rows(spark, sf).select("source_file").distinct()
    return prune_files(files, "2024-01-05", "2024-01-20")


@query
def file_stats_(spark: SparkSession, sf: str) -> DataFrame:
    return file_stats(_file_rows(spark, sf))


@query
def coverage_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of January without an observation, per station."""
    weather = fx.weather_a(spark, sf)
    stations = weather.select(F.col("station").alias("id")).distinct()
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31, 23)
    return tidy(op.coverage_gaps(weather, stations, start, end, "hour"))


@query
def missing_weather_files(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly files due from each station since mid-January, less those observed in the months."""
    weather = fx.weather_a(spark, sf)
    stations = weather.select(F.col("station").alias("id")).distinct()
    expected = op.expected_weather_files(stations, dt.date(2024, 1, 15), dt.date(2024, 3, 28))
    listed = weather.select(
        F.concat(F.col("station"), F.date_format("valid", "'_'yyyyMM'15_20240131.csv'")).alias("source_file")
    )
    return tidy(op.missing_files(expected, listed.distinct()))


@query
def missing_trip_files(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly files due since 1994, less the months that have orders."""
    expected = op.expected_trip_files(spark, "orders", 1994, dt.date(2003, 6, 10))
    listed = fx.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "'orders_'yyyy-MM'.parquet'").alias("source_file")
    )
    return op.missing_files(expected, listed.distinct())


# --- ingest --------------------------------------------------------------------------------------


def _weather_text(spark: SparkSession, sf: str) -> DataFrame:
    """Weather of fixture A as the text cells of a weather file."""
    weather = fx.weather_a(spark, sf)
    cells = ["station", "valid", "tmpf", "p01i", "vsby", "sknt", "gust", "lon", "lat", "skyc1", "wxcodes"]
    return weather.select(*[F.coalesce(F.col(c).cast("string"), F.lit("M")).alias(c) for c in cells])


def _write_weather_files(spark: SparkSession, sf: str) -> str:
    """Weather files per station, named after it; two stations have their columns in another order."""
    path = scratch_path(spark, "weather-files")
    text = _weather_text(spark, sf)
    for i, station in enumerate(fx.STATION_IDS):
        columns = text.columns if i % 2 == 0 else text.columns[::-1]
        (
            text.where(F.col("station") == station)
            .select(*columns)
            .write.option("header", True)
            .option("mapreduce.output.basename", f"{station}_20240101_20240131_")
            .mode("append")
            .csv(path)
        )
    return path


def _weather_state(spark: SparkSession, name: str) -> DataFrame:
    loaded = spark.table(name).drop("file_date", "processed_at")
    short = F.substring_index("source_file", "_", 3)
    return tidy(loaded.withColumn("source_file", short))


@query
def ingest_weather_(spark: SparkSession, sf: str) -> DataFrame:
    """Weather files loaded twice: the second time there is nothing new."""
    path = _write_weather_files(spark, sf)
    name, place = new_table(spark, "weather")
    for _ in range(2):
        ingest_weather(
            spark, path, fx.STATION_LIST, name, fx.PROCESSED_AT, end="2024-01-31", table_path=place
        )
    return _weather_state(spark, name)


@query
def stream_weather_(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_weather_files(spark, sf)
    name, place = new_table(spark, "weather")
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        stream_weather(
            spark, path, fx.STATION_LIST, name, checkpoint, fx.PROCESSED_AT, table_path=place
        )
    return _weather_state(spark, name)


@query
def weather_file_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of weather files, as read, to rows of the raw table: one file per station and day,
    files of even days without the gust column."""
    cells = ["station", "valid", "tmpf", "p01i", "vsby", "sknt", "gust"]
    text = _weather_text(spark, sf)
    day = F.translate(F.substring("valid", 1, 10), "-", "")
    even = F.substring("valid", 10, 1).cast("int") % 2 == 0
    rows = text.select(
        F.concat_ws("_", "station", day, F.concat(day, F.lit(".csv"))).alias("source_file"),
        F.when(even, F.concat_ws(",", *cells[:-1])).otherwise(F.concat_ws(",", *cells)).alias("value"),
        F.when(even, F.lit(",".join(cells[:-1]))).otherwise(F.lit(",".join(cells))).alias("header"),
    )
    heads = rows.select("source_file", F.col("header").alias("value")).distinct()
    notes = heads.withColumn("value", F.explode(F.array(*[F.lit(f"#DEBUG: line {i}") for i in range(5)])))
    lines = notes.unionByName(heads).unionByName(rows.drop("header"))
    parsed = parse_weather_lines(lines.withColumn("file_path", F.col("source_file")))
    typed = weather_rows(parsed, stations_frame(spark, fx.STATION_LIST), fx.PROCESSED_AT)
    return tidy(typed.drop("processed_at"))


@query
def weather_file_positional_preamble(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose preamble is free text, one word of it like a station: it ends where the header stands."""
    path = scratch_path(spark, "weather-files")
    text = _weather_text(spark, sf)
    for station in fx.STATION_IDS:
        rows = text.where(F.col("station") == station).select(F.concat_ws(",", *text.columns).alias("value"))
        notes = [f"{station},note {i}" for i in range(5)] + [",".join(text.columns)]
        head = spark.createDataFrame([("\n".join(notes),)], "value string")
        (
            head.coalesce(1).unionByName(rows).coalesce(1)
            .write.option("mapreduce.output.basename", f"{station}_20240101_20240131_")
            .mode("append").text(path)
        )
    parsed = read_weather(spark, path, glob="*.txt", mark=None)
    typed = weather_rows(parsed, stations_frame(spark, fx.STATION_LIST), fx.PROCESSED_AT)
    return tidy(
        typed.drop("file_date", "processed_at").withColumn("source_file", F.substring_index("source_file", "_", 3))
    )


@query
def stream_weather_positional_preamble(spark: SparkSession, sf: str) -> DataFrame:
    """Such files as a stream, one of them from the start and all of them in a second call."""
    path = scratch_path(spark, "weather-files")
    text = _weather_text(spark, sf)
    name, place = new_table(spark, "weather")
    checkpoint = scratch_path(spark, "stream")
    for stations in (fx.STATION_IDS[:1], fx.STATION_IDS[1:]):
        for station in stations:
            rows = text.where(F.col("station") == station).select(F.concat_ws(",", *text.columns).alias("value"))
            notes = [f"{station},note {i}" for i in range(5)] + [",".join(text.columns)]
            head = spark.createDataFrame([(note,) for note in notes], "value string")
            (
                head.coalesce(1).unionByName(rows).coalesce(1)
                .write.option("mapreduce.output.basename", f"{station}_20240101_20240131_")
                .option("sep", "\u0001").option("quote", "").mode("append").csv(path)
            )
        stream_weather(
            spark, path, fx.STATION_LIST, name, checkpoint, fx.PROCESSED_AT, table_path=place, mark=None
        )
    return _weather_state(spark, name)


def _write_trip_files(spark: SparkSession, sf: str) -> str:
    """Trip files per event type; one type is written with whole numbers where others have doubles.

    Files hold ranges of pickup times, the first of which is never empty: Spark writes a file without rows for a
    first partition that has none, as the first split of a large row group has.
    """
    path = scratch_path(spark, "trip-files")
    trips = fx.trips_a(spark, sf)
    for kind in ("click", "purchase", "view"):
        part = trips.where(F.col("source_file") == kind).drop("source_file")
        if kind == "view":
            part = part.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        part = part.repartitionByRange("tpep_pickup_datetime")
        part.write.option("mapreduce.output.basename", f"{kind}_2024").mode("append").parquet(path)
    return path


def _trip_state(spark: SparkSession, name: str) -> DataFrame:
    return tidy(
        spark.table(name).withColumn("source_file", F.substring_index("source_file", "_", 1))
    )


@query
def ingest_trips_(spark: SparkSession, sf: str) -> DataFrame:
    """Trip files loaded twice: the second time there is nothing new."""
    path = _write_trip_files(spark, sf)
    name, place = new_table(spark, "trips")
    for _ in range(2):
        ingest_trips(spark, path, name, table_path=place)
    return _trip_state(spark, name)


@query
def ingest_trips_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Configured fields only, one of them computed."""
    path = _write_trip_files(spark, sf)
    name, place = new_table(spark, "trips")
    fields = [
        {"name": "tpep_pickup_datetime"},
        {"name": "trip_distance"},
        {"name": "PULocationID"},
        {"name": "net_amount", "transformation": "total_amount - tip_amount"},
    ]
    ingest_trips(spark, path, name, fields, table_path=place)
    return _trip_state(spark, name)


@query
def stream_trips_(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "trip-files")
    trips = fx.trips_a(spark, sf)
    for kind in ("click", "purchase", "view"):
        part = trips.where(F.col("source_file") == kind).drop("source_file")
        part.write.option("mapreduce.output.basename", f"{kind}_2024").mode("append").parquet(path)
    name, place = new_table(spark, "trips")
    checkpoint = scratch_path(spark, "stream")
    for _ in range(2):
        stream_trips(spark, path, name, checkpoint, table_path=place)
    return _trip_state(spark, name)


def _write_fee_files(spark: SparkSession, sf: str) -> str:
    """Trip files with a further column: whole in one, with fractions and in other letters in another."""
    path = scratch_path(spark, "trip-files")
    trips = fx.trips_a(spark, sf)
    fees = {
        "click": F.col("payment_type").alias("airport_fee"),
        "purchase": (F.col("fare_amount") / 4).alias("Airport_fee"),
    }
    for kind in ("click", "purchase", "view"):
        part = trips.where(F.col("source_file") == kind).drop("source_file")
        part = part.select("*", fees[kind]) if kind in fees else part
        part.write.option("mapreduce.output.basename", f"{kind}_2024").mode("append").parquet(path)
    return path


@query
def ingest_trips_extra_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_fee_files(spark, sf)
    name, place = new_table(spark, "trips")
    ingest_trips(spark, path, name, table_path=place)
    return _trip_state(spark, name)


@query
def stream_trips_extra_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_fee_files(spark, sf)
    name, place = new_table(spark, "trips")
    stream_trips(spark, path, name, scratch_path(spark, "stream"), files_per_batch=1, table_path=place)
    # the file that comes first decides about letter case
    return _trip_state(spark, name).withColumnRenamed("airport_fee", "Airport_fee")


@query
def ingest_trips_ledger_column(spark: SparkSession, sf: str) -> DataFrame:
    """The file names go to a column of another name; loaded twice, the second time nothing is new."""
    path = _write_trip_files(spark, sf)
    name, place = new_table(spark, "trips")
    for _ in range(2):
        ingest_trips(spark, path, name, table_path=place, ledger_column="loaded_from")
    return tidy(
        spark.table(name).withColumn("loaded_from", F.substring_index("loaded_from", "_", 1))
    )


@query
def ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and outcome per kind of file; one file has no rows."""
    path = _write_trip_files(spark, sf)
    trips = fx.trips_a(spark, sf).drop("source_file").where(F.lit(False)).coalesce(1)
    trips.write.option("mapreduce.output.basename", "none_2024").mode("append").parquet(path)
    name, place = new_table(spark, "trips")
    report = ingest_trips(spark, path, name, table_path=place, detailed=True)
    kind = F.substring_index("source_file", "_", 1).alias("source_file")
    totals = report.groupBy(kind).agg(F.sum("rows").alias("rows"), F.max("reason").alias("reason"))
    outcome = F.when(F.col("rows") > 0, "loaded").otherwise("empty")
    agreed = report.where((F.col("outcome") == "loaded") != (F.col("rows") > 0)).count() == 0
    return totals.select("source_file", "rows", F.when(F.lit(agreed), outcome).alias("outcome"), "reason")


@query
def stream_report(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of a stream: a file that cannot be read fails in the first and is taken in by the second."""
    path = _write_trip_files(spark, sf)
    late = fx.trips_a(spark, sf).where("source_file = 'view'").drop("source_file").coalesce(1)
    good = scratch_path(spark, "late-file")
    late.write.option("mapreduce.output.basename", "late_2024").parquet(good)
    files = spark._jvm.org.apache.hadoop.fs
    store = files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    broken = files.Path(f"{path}/late_2024.parquet")
    out = store.create(broken, True)
    out.writeBytes("not a Parquet file")
    out.close()
    name, place = new_table(spark, "trips")
    checkpoint = scratch_path(spark, "stream")
    first = hold(stream_trips(spark, path, name, checkpoint, table_path=place), "report").df
    store.delete(broken, False)
    made = next(s.getPath() for s in store.listStatus(files.Path(good)) if s.getPath().getName().endswith(".parquet"))
    store.rename(made, broken)
    second = stream_trips(spark, path, name, checkpoint, table_path=place)
    kind = F.substring_index("source_file", "_", 1).alias("source_file")
    of = [r.groupBy(kind, "outcome").agg(F.sum("rows").alias("rows"), F.max(F.col("reason").isNotNull()).alias("has_reason")).select(F.lit(n).alias("run"), "*") for n, r in ((1, first), (2, second))]
    return tidy(of[0].unionByName(of[1]))


# --- tables --------------------------------------------------------------------------------------

FACT_KEYS = ["pickup_datetime", "pickup_location_id", "dropoff_location_id", "vendor_id"]
FACT_LAYOUT = (["pickup_date"], ["pickup_location_id", "dropoff_location_id"])


def _slim(spark: SparkSession, sf: str) -> DataFrame:
    return _stg(spark, sf).select(
        *FACT_KEYS, "pickup_date", "fare_amount", "passenger_count"
    )


def _half_loaded(spark: SparkSession, sf: str, what: str) -> str:
    """Table with the trips of the first half of January."""
    name, place = new_table(spark, what)
    first = _slim(spark, sf).where(F.col("pickup_date") <= dt.date(2024, 1, 15))
    materialize(first, name, "error", *FACT_LAYOUT, path=place)
    return name


@query
def incremental_two_step(spark: SparkSession, sf: str) -> DataFrame:
    """Second load: only rows above the first load's latest date, its late rows left out."""
    name = _half_loaded(spark, sf, "incremental")
    late = _slim(spark, sf).withColumn("fare_amount", F.col("fare_amount") + 1000)
    append(incremental(late, name, "pickup_date"), name, FACT_LAYOUT[1])
    return tidy(spark.table(name))


@query
def high_water_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders")
    settled = orders.where(F.col("o_orderstatus") == "F").where(F.col("o_orderdate") < "2000-01-01")
    return tidy(above_high_water(orders, settled, "o_orderdate").select("o_orderkey", "o_orderdate"))


@query
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Rebuild of a table that already has rows."""
    name, place = new_table(spark, "refresh")
    old = _slim(spark, sf).where(F.col("pickup_date") <= dt.date(2024, 1, 15))
    materialize(old.withColumn("fare_amount", F.lit(-1.0)), name, "error", *FACT_LAYOUT, path=place)
    rows = incremental(_slim(spark, sf), name, "pickup_date", full_refresh=True)
    return tidy(materialize(rows, name, "overwrite", *FACT_LAYOUT, path=place))


@query
def upsert_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Batch that overlaps the table: matching keys replaced, the rest added, twice the same."""
    name = _half_loaded(spark, sf, "upsert")
    batch = (
        _slim(spark, sf)
        .where(F.col("pickup_date") >= dt.date(2024, 1, 12))
        .withColumn("fare_amount", F.col("fare_amount") + 1000)
    )
    for _ in range(2):
        upsert(batch, name, FACT_KEYS, "pickup_date", FACT_LAYOUT[1])
    return tidy(spark.table(name))


@query
def append_evolving_(spark: SparkSession, sf: str) -> DataFrame:
    """Second append brings a column the table did not have."""
    items = fx.table(spark, sf, "lineitem")
    base = items.select("l_orderkey", "l_linenumber", "l_quantity")
    name, place = new_table(spark, "evolve")
    ensure_table(spark, name, base.schema, path=place)
    returned = F.col("l_returnflag") != "N"
    append(items.where(returned).select(*base.columns), name)
    more = items.select("l_linenumber", "l_orderkey", "l_quantity", "l_returnflag")
    append_evolving(more.where(~returned), name)
    return spark.table(name).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_quantity", "l_returnflag"
    )


def _amounts(spark: SparkSession, sf: str, what: str, later_name: str, whole: bool) -> DataFrame:
    """A table of amounts, whole or not, and later ones with fractions under the name `later_name`."""
    items = fx.table(spark, sf, "lineitem")
    name, place = new_table(spark, what)
    settled = F.col("l_returnflag") != "N"
    quantity = F.col("l_quantity").cast("bigint") if whole else F.col("l_quantity")
    base = items.where(settled).select("l_orderkey", quantity.alias("amount"))
    ensure_table(spark, name, base.schema, path=place)
    append(base, name)
    append_evolving(items.where(~settled).select("l_orderkey", F.col("l_extendedprice").alias(later_name)), name)
    return tidy(spark.table(name).select("l_orderkey", "amount"))


@query
def append_wide_integers(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers, then fractions: beyond 2**53 both are kept as text, below it as doubles."""
    name, path = new_table(spark, "wide_integers")
    lines = fx.table(spark, sf, "lineitem")
    far = F.col("l_orderkey") + F.lit(2**53)
    whole = lines.where("l_returnflag <> 'N'").select("l_orderkey", far.alias("far"), F.col("l_orderkey").alias("near"))
    materialize(whole, name, path=path)
    half = (F.col("l_quantity") + 0.5).cast("double")
    append_evolving(lines.where("l_returnflag = 'N'").select("l_orderkey", half.alias("far"), half.alias("near")), name)
    return tidy(spark.table(name))


@query
def append_widening(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts with fractions come to a table of whole ones."""
    return _amounts(spark, sf, "widening", "amount", whole=True)


@query
def append_letter_case(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts come under the same name in other letters."""
    return _amounts(spark, sf, "letters", "AMOUNT", whole=False)


@query
def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in a table partitioned by month and clustered by customer, read back."""
    name, place = new_table(spark, "monthly")
    orders = fx.table(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    table = materialize(orders, name, "error", ["month"], ["o_custkey"], path=place)
    return tidy(table.select("o_orderkey", "o_custkey", "o_totalprice", "month"))


# --- checks --------------------------------------------------------------------------------------


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    failing = quality.not_null(_stg(spark, sf), "passenger_count")
    return tidy(failing.select("vendor_id", "pickup_datetime", "pickup_location_id"))


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique(fx.table(spark, sf, "lineitem"), "l_orderkey")


@query
def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    failing = quality.accepted_values(_stg(spark, sf), "passenger_count", (1, 2, 3))
    return failing


@query
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Trips from zones without a station."""
    stg = _stg(spark, sf).select("pickup_datetime", "vendor_id", "pickup_location_id")
    return tidy(quality.relationships(stg, "pickup_location_id", _mapping(spark, sf), "taxi_zone_id"))


@query
def dq_orphan_values(spark: SparkSession, sf: str) -> DataFrame:
    urgent = fx.table(spark, sf, "orders").where(F.col("o_orderpriority").startswith("1"))
    return quality.orphan_values(fx.table(spark, sf, "lineitem"), "l_orderkey", urgent, "o_orderkey")


@query
def dq_unique_combination(spark: SparkSession, sf: str) -> DataFrame:
    failing = quality.unique_combination(
        fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )
    return failing.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


@query
def dq_expression(spark: SparkSession, sf: str) -> DataFrame:
    failing = quality.expression_is_true(_validated_b(spark, sf), "trip_duration_seconds >= 0")
    return tidy(
        failing.groupBy("vendor_id", "pickup_location_id").agg(F.count(F.lit(1)).alias("failures"))
    )


@query
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All declared checks over the models of fixture A, built into tables."""
    run = uuid.uuid4().hex
    store = TableStore(f"skyfare_{run}_", scratch_path(spark, "models"))
    sources = Sources(fx.trips_a(spark, sf), fx.weather_a(spark, sf), fx.taxi_zone(spark, sf))
    models = build_models(spark, sources, fx.A_AS_OF, fx.A_MIN_DATE, fx.BOROUGHS, store)
    return run_checks(models, model_checks())


@query
def dq_two_expressions_one_column(spark: SparkSession, sf: str) -> DataFrame:
    """Two checks of one kind on one column, both failing, each with a table of its own."""
    models = {"stg": _stg(spark, sf)}
    checks = [Check("expression_is_true", "stg", "fare_amount", (e,)) for e in ("fare_amount >= 0", "fare_amount < 40")]
    prefix, place = new_table(spark, "failures")
    names = []
    try:
        enforce_checks(models, checks, prefix, place)
    except ChecksFailed as failed:
        names = [name for name, _ in failed.failed]
    stored = [
        spark.table(f"{prefix}_{name}").agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("name"), "failures")
        for name in names
    ]
    return reduce(DataFrame.unionByName, stored)


@query
def dq_stored_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Failing rows kept in a table when a check fails."""
    models = {"stg": _stg(spark, sf)}
    check = Check("expression_is_true", "stg", "fare_amount", ("fare_amount >= 0",))
    prefix, place = new_table(spark, "failures")
    try:
        enforce_checks(models, [check], prefix, place)
    except ChecksFailed:
        pass
    stored = spark.table(f"{prefix}_{check.name}")
    return tidy(stored.select("vendor_id", "pickup_datetime", "pickup_location_id", "fare_amount"))
