"""DuckDB SQL giving the same rows as each registered query, from the same test tables."""

from __future__ import annotations

TIE = "3e-9"


def num(expression: str) -> str:
    return f"round({expression} + {TIE}, 6)"


def stamp(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def day(expression: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR)"


def tidy(names: str, numbers: str = "", stamps: str = "", days: str = "") -> str:
    """Select list: plain names, doubles, times and dates, each rendered the agreed way."""
    parts = names.split()
    parts += [f"{num(n)} AS {n}" for n in numbers.split()]
    parts += [f"{stamp(n)} AS {n}" for n in stamps.split()]
    parts += [f"{day(n)} AS {n}" for n in days.split()]
    return ", ".join(parts)


# --- fixtures ------------------------------------------------------------------------------------

RAW = """
e AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           ['JFK', 'LGA', 'NYC', 'EWR'][CAST(user_id % 4 AS INT) + 1] AS code
    FROM events),
zones AS (
    SELECT CAST(n_nationkey AS BIGINT) AS LocationID, r_name AS Borough, n_name AS Zone,
           'S' || CAST(n_nationkey % 3 AS VARCHAR) AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey),
boroughs(borough, station_id) AS (
    VALUES ('AFRICA', 'JFK'), ('AMERICA', 'LGA'), ('ASIA', 'NYC'), ('EUROPE', 'EWR')),
obs AS (
    SELECT code AS station, ts AS valid, -74.0::DOUBLE + user_id % 4 AS lon,
           40.0::DOUBLE + user_id % 4 AS lat, value AS tmpf, k / 500.0::DOUBLE AS p01i,
           CAST(k % 11 AS DOUBLE) AS vsby, CAST(k % 30 AS DOUBLE) AS sknt,
           CAST(nullif(k % 3, 0) AS DOUBLE) AS gust,
           CASE WHEN k % 2 = 0 THEN 'CLR' ELSE 'OVC' END AS skyc1,
           CASE WHEN k % 5 = 0 THEN 'RA' END AS wxcodes,
           code || ' airfield' AS station_name, 'zone of ' || code AS station_zone
    FROM e WHERE event_type IN ('signup', 'error')),
trips_a AS (
    SELECT CAST(user_id % 3 AS VARCHAR) AS vendor, ts AS pu,
           ts + to_seconds(60 * k - 300) AS doff, CAST(nullif(k % 7, 6) AS BIGINT) AS pass,
           CASE WHEN k % 17 = 0 THEN 0.0::DOUBLE ELSE value / 10 END AS dist,
           user_id % 25 AS pu_zone, event_id % 25 AS do_zone, k % 4 AS pay,
           value - 5 AS fare, value / 10 AS tip, value * 1.2::DOUBLE AS total, event_type
    FROM e WHERE event_type IN ('click', 'purchase', 'view')),
trips_b AS (
    SELECT l_returnflag AS vendor, o_orderdate AS pu, l_shipdate AS doff,
           CAST(l_linenumber AS BIGINT) AS pass, l_quantity AS dist,
           CAST(c_nationkey AS BIGINT) AS pu_zone, CAST(s_nationkey AS BIGINT) AS do_zone,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS pay, l_extendedprice AS fare,
           l_extendedprice * l_discount AS tip, l_extendedprice * (1 + l_tax) AS total
    FROM lineitem, orders, customer, supplier
    WHERE o_orderkey = l_orderkey AND c_custkey = o_custkey AND s_suppkey = l_suppkey)"""


def staged(source: str) -> str:
    """Staged trips; the charges the fixtures leave at zero are one column here."""
    return f"""
stg AS (
    SELECT *, CAST(pu AS DATE) AS pu_date, date_trunc('hour', pu) AS pu_hour,
           CAST(datesub('second', pu, doff) AS BIGINT) AS secs
    FROM {source})"""


STG_A = RAW + "," + staged("trips_a")
STG_B = RAW + "," + staged("trips_b")

DIMENSIONS = """,
newest AS (
    SELECT * FROM obs WHERE station IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY station
        ORDER BY valid DESC NULLS LAST, station_name NULLS FIRST, station_zone NULLS FIRST) = 1),
mapping AS (
    SELECT LocationID AS taxi_zone_id, Zone AS taxi_zone_name, z.Borough AS taxi_borough,
           n.station AS station_id, n.station_name, n.station_zone
    FROM zones z JOIN boroughs b ON b.borough = z.Borough JOIN newest n ON n.station = b.station_id),
hourly0 AS (
    SELECT station, station_name, station_zone, date_trunc('hour', valid) AS observation_hour,
           CAST(valid AS DATE) AS observation_date, hour(valid) AS hour_of_day,
           avg(tmpf) AS avg_temperature_f, avg((tmpf - 32) * 5 / 9) AS avg_temperature_c,
           max(p01i) AS precipitation_inches, min(vsby) AS min_visibility_miles,
           avg(sknt) AS avg_wind_speed_knots, max(gust) AS max_wind_gust_knots,
           count(*) AS observation_count
    FROM obs WHERE valid IS NOT NULL GROUP BY ALL),
hourly AS (
    SELECT *, CASE WHEN precipitation_inches > 0.1 THEN 'Rainy'
                   WHEN min_visibility_miles < 3 THEN 'Poor Visibility'
                   WHEN avg_temperature_f < 32 THEN 'Freezing'
                   WHEN avg_temperature_f > 85 THEN 'Hot'
                   ELSE 'Normal' END AS weather_condition
    FROM hourly0)"""


# Rules and their labels, in order; the first rule that holds gives the label.
QUALITY_RULES = [
    ("least(pickup_date, CAST(dropoff_datetime AS DATE)) < DATE '{low}'", "Date trop ancienne"),
    ("greatest(pickup_date, CAST(dropoff_datetime AS DATE)) > DATE '{high}'", "Date future ou trop récente"),
    ("trip_duration_seconds < 0", "Invalid trip duration"),
    ("trip_distance = 0 AND trip_duration_seconds > 60", "Zero distance with duration"),
    ("fare_amount < 0", "Negative fare"),
    ("passenger_count < 1", "Invalid passenger count"),
    ("station_id IS NULL", "Missing station data"),
    ("weather_condition IS NULL", "Missing weather data"),
]
MISSING_RULES = [
    ("pickup_datetime IS NULL OR dropoff_datetime IS NULL", "Missing timestamp"),
    ("trip_distance IS NULL", "Missing trip distance"),
    ("fare_amount IS NULL", "Missing fare amount"),
    ("passenger_count IS NULL", "Missing passenger count"),
    ("station_id IS NULL", "Missing station information"),
    ("station_name IS NULL", "Missing station name"),
    ("station_zone IS NULL", "Missing station zone"),
    ("weather_condition IS NULL", "Missing weather condition"),
]
VALID, COMPLETE = "Valid", "Complete"


def case(rules: list[tuple[str, str]], default: str, **values: str) -> str:
    whens = "\n             ".join(f"WHEN {condition.format(**values)} THEN '{label}'" for condition, label in rules)
    return f"CASE {whens}\n             ELSE '{default}' END"


def labelled(low: str, high: str, source: str) -> str:
    """Labels from the columns as read, under the model's names; then missing numbers are filled."""
    return f"""
named AS (
    SELECT *, pu AS pickup_datetime, pu_date AS pickup_date, doff AS dropoff_datetime,
           secs AS trip_duration_seconds, dist AS trip_distance, fare AS fare_amount,
           pass AS passenger_count
    FROM {source}),
ruled AS (
    SELECT *,
        {case(QUALITY_RULES, VALID, low=low, high=high)} AS data_quality_check,
        {case(MISSING_RULES, COMPLETE)} AS missing_values_flag,
        NOT coalesce(pickup_date < DATE '{low}' OR pickup_date > DATE '{high}', FALSE)
            AS is_valid_pickup_date,
        NOT coalesce(CAST(dropoff_datetime AS DATE) < DATE '{low}'
                     OR CAST(dropoff_datetime AS DATE) > DATE '{high}', FALSE) AS is_valid_dropoff_date
    FROM named),
val AS (
    SELECT * EXCLUDE (pickup_datetime, pickup_date, dropoff_datetime, trip_duration_seconds,
                      trip_distance, fare_amount, passenger_count)
             REPLACE (coalesce(pass, 1) AS pass, coalesce(dist, 0) AS dist,
                      coalesce(fare, 0) AS fare, coalesce(tip, 0) AS tip,
                      coalesce(total, 0) AS total, coalesce(secs, 0) AS secs)
    FROM ruled)"""


VAL_A = (
    STG_A
    + DIMENSIONS
    + """,
located AS (
    SELECT s.*, m.station_id, m.station_name, m.station_zone, h.weather_condition
    FROM stg s LEFT JOIN mapping m ON m.taxi_zone_id = s.pu_zone
    LEFT JOIN hourly h ON h.station = m.station_id AND h.observation_hour = s.pu_hour),"""
    + labelled("2024-01-03", "2024-01-28", "located")
)
VAL_B = (
    STG_B
    + """,
located AS (
    SELECT *, 'given' AS station_id, 'given' AS station_name, 'given' AS station_zone,
           'given' AS weather_condition
    FROM stg),"""
    + labelled("1996-01-01", "2000-01-31", "located")
)
FACT_A = (
    VAL_A
    + """,
fact AS (
    SELECT v.* EXCLUDE (station_id, station_name, station_zone, weather_condition),
           m.station_id AS weather_station, m.station_name, m.station_zone,
           h.avg_temperature_f, h.avg_temperature_c, h.precipitation_inches,
           h.min_visibility_miles, h.avg_wind_speed_knots, h.max_wind_gust_knots,
           h.weather_condition
    FROM val v LEFT JOIN mapping m ON m.taxi_zone_id = v.pu_zone
    LEFT JOIN hourly h ON h.station = m.station_id AND h.observation_hour = v.pu_hour
    WHERE v.data_quality_check = 'Valid')"""
)


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


# Trip columns under their model names.
TRIP_KEYS = "vendor AS vendor_id, pu_zone AS pickup_location_id, do_zone AS dropoff_location_id"
TRIP_COLUMNS = f"""{TRIP_KEYS}, {stamp('pu')} AS pickup_datetime, {stamp('doff')} AS dropoff_datetime,
    pass AS passenger_count, {num('dist')} AS trip_distance, CAST(1 AS BIGINT) AS ratecode_id,
    'N' AS store_and_fwd_flag, pay AS payment_type_id, {num('fare')} AS fare_amount,
    {num('tip')} AS tip_amount, {num('total')} AS total_amount,
    0.0::DOUBLE AS extra, 0.0::DOUBLE AS mta_tax, 0.0::DOUBLE AS tolls_amount,
    0.0::DOUBLE AS improvement_surcharge, 0.0::DOUBLE AS congestion_surcharge,
    {day('pu_date')} AS pickup_date, year(pu) AS pickup_year, month(pu) AS pickup_month,
    day(pu) AS pickup_day, hour(pu) AS pickup_hour, dayofweek(pu) + 1 AS pickup_weekday,
    secs AS trip_duration_seconds"""
HOUR_NUMBERS = """avg_temperature_f avg_temperature_c precipitation_inches min_visibility_miles
    avg_wind_speed_knots max_wind_gust_knots"""
RAW_WEATHER = (
    tidy(
        "station skyc1 wxcodes", "lon lat tmpf p01i vsby sknt gust", "valid"
    )
)
LISTED_NAME = "CASE station WHEN 'JFK' THEN 'John F Kennedy' WHEN 'LGA' THEN 'LaGuardia' WHEN 'NYC' THEN 'Central Park' ELSE 'Unknown' END"
LISTED_ZONE = "CASE station WHEN 'JFK' THEN 'queens' WHEN 'LGA' THEN 'queens' WHEN 'NYC' THEN 'manhattan' ELSE 'Unknown' END"


def daily_all(ctes: str) -> str:
    return sql(ctes, f"""
        SELECT {day('pu_date')} AS trip_date, count(*) AS total_trips,
               count(DISTINCT vendor) AS active_vendors,
               CAST(sum(pass) AS BIGINT) AS total_passengers,
               {num('avg(dist)')} AS avg_distance, {num('avg(secs) / 60')} AS avg_duration_minutes,
               {num('sum(fare)')} AS total_fare, {num('sum(tip)')} AS total_tips,
               {num('sum(total)')} AS total_revenue,
               {num('100 * avg(tip / nullif(fare, 0))')} AS avg_tip_percentage
        FROM val GROUP BY pu_date""")


def daily_valid(ctes: str) -> str:
    return sql(ctes, f"""
        SELECT {day('pu_date')} AS trip_date, count(*) AS total_trips,
               count(DISTINCT vendor) AS active_vendors,
               CAST(sum(pass) AS BIGINT) AS total_passengers,
               {num('avg(pass)')} AS avg_passengers_per_trip,
               {num('avg(dist)')} AS avg_distance, {num('avg(secs) / 60')} AS avg_duration_minutes,
               {num('sum(fare)')} AS total_fare, {num('sum(tip)')} AS total_tips,
               {num('sum(total)')} AS total_revenue,
               {num('100 * avg(tip / nullif(fare, 0))')} AS avg_tip_percentage
        FROM val WHERE data_quality_check = 'Valid' GROUP BY pu_date""")


def daily_quality(ctes: str) -> str:
    return sql(ctes, f"""
        SELECT {day('pu_date')} AS report_date, count(*) AS total_records,
               count(*) FILTER (data_quality_check = 'Valid') AS valid_records,
               count(*) FILTER (data_quality_check <> 'Valid') AS invalid_records,
               count(*) FILTER (data_quality_check = 'Invalid trip duration') AS invalid_duration,
               count(*) FILTER (data_quality_check = 'Zero distance with duration') AS zero_distance,
               count(*) FILTER (data_quality_check = 'Negative fare') AS negative_fare,
               count(*) FILTER (data_quality_check = 'Invalid passenger count') AS invalid_passengers,
               count(*) FILTER (missing_values_flag <> 'Complete') AS incomplete_records,
               {num("round(100.0::DOUBLE * count(*) FILTER (data_quality_check = 'Valid') / count(*), 2)")} AS valid_rate,
               {num("round(100.0::DOUBLE * count(*) FILTER (missing_values_flag = 'Complete') / count(*), 2)")} AS complete_rate
        FROM val GROUP BY pu_date""")


def zones_of(ctes: str) -> str:
    return sql(ctes, f"""
        SELECT LocationID, Borough, Zone, service_zone,
               CASE WHEN p.n > 0 THEN 'Pickup' WHEN d.n > 0 THEN 'Dropoff' END AS primary_zone_role,
               coalesce(p.n, 0) AS pickup_trips, coalesce(d.n, 0) AS dropoff_trips,
               coalesce(p.n, 0) + coalesce(d.n, 0) AS total_trips,
               {num('coalesce(p.fare, 0)')} AS avg_pickup_fare,
               {num('coalesce(d.fare, 0)')} AS avg_dropoff_fare,
               {num('coalesce(p.dist, 0)')} AS avg_pickup_distance,
               {num('coalesce(d.dist, 0)')} AS avg_dropoff_distance,
               {num('coalesce(p.revenue, 0)')} AS pickup_revenue,
               {num('coalesce(d.revenue, 0)')} AS dropoff_revenue
        FROM zones
        LEFT JOIN (SELECT pu_zone AS z, count(*) AS n, avg(fare) AS fare, avg(dist) AS dist,
                          sum(total) AS revenue FROM val WHERE data_quality_check = 'Valid' GROUP BY 1) p
               ON p.z = LocationID
        LEFT JOIN (SELECT do_zone AS z, count(*) AS n, avg(fare) AS fare, avg(dist) AS dist,
                          sum(total) AS revenue FROM val WHERE data_quality_check = 'Valid' GROUP BY 1) d
               ON d.z = LocationID""")


def one_end(column: str, role: str) -> str:
    return sql(VAL_A, f"""
        SELECT {column} AS location_id, '{role}' AS zone_role, count(*) AS trip_count,
               {num('avg(fare)')} AS avg_fare, {num('avg(dist)')} AS avg_distance,
               {num('sum(total)')} AS total_revenue, {num('avg(secs) / 60')} AS avg_duration_minutes
        FROM val WHERE data_quality_check = 'Valid' AND {column} IS NOT NULL GROUP BY ALL""")


WEATHER_IMPACT = f"""
    SELECT pu_date AS pickup_date, weather_condition, count(*) AS trip_count,
           count(DISTINCT pu_zone) AS active_pickup_zones,
           count(DISTINCT do_zone) AS active_dropoff_zones,
           avg(fare) AS avg_fare, avg(total) AS avg_total_amount, avg(tip) AS avg_tip,
           100 * avg(tip / nullif(fare, 0)) AS avg_tip_percentage, avg(dist) AS avg_distance,
           avg(secs) / 60 AS avg_duration_minutes, avg(avg_temperature_f) AS avg_temperature,
           max(precipitation_inches) AS max_precipitation, min(min_visibility_miles) AS min_visibility
    FROM fact GROUP BY ALL"""
IMPACT_NUMBERS = """avg_fare avg_total_amount avg_tip avg_tip_percentage avg_distance
    avg_duration_minutes avg_temperature max_precipitation min_visibility"""
ZONE_WEATHER = """
    SELECT pu_zone AS pickup_location_id, weather_condition, count(*) AS total_trips,
           avg(fare) AS avg_fare, avg(dist) AS avg_distance, sum(total) AS total_revenue,
           avg(dist / nullif(secs / 3600, 0)) AS avg_speed_mph,
           avg(fare / nullif(dist, 0)) AS revenue_per_mile,
           avg(avg_temperature_f) AS avg_temperature, avg(precipitation_inches) AS avg_precipitation,
           avg(min_visibility_miles) AS avg_visibility
    FROM fact WHERE pu_zone IS NOT NULL AND weather_condition IS NOT NULL GROUP BY ALL"""
ZONE_WEATHER_NUMBERS = """avg_fare avg_distance total_revenue avg_speed_mph revenue_per_mile
    avg_temperature avg_precipitation avg_visibility"""

FILE_ROWS = """
files AS (
    SELECT event_id, ts, CASE WHEN event_type = 'view' THEN 'view.csv'
                              ELSE event_type || '_' || strftime(ts, '%Y%m%d') || '.csv' END AS source_file
    FROM events)"""
TOKENS = "['M', 'NA', 'None', 'null', '', 'nan', 'NaN', 'T']"


def raw_trips(charges: str) -> str:
    """Raw trip table of fixture A."""
    return sql(RAW, f"""
        SELECT CAST(vendor AS BIGINT) AS VendorID, {stamp('pu')} AS tpep_pickup_datetime,
               {stamp('doff')} AS tpep_dropoff_datetime, {num('CAST(pass AS DOUBLE)')} AS passenger_count,
               {num('dist')} AS trip_distance, 1.0::DOUBLE AS RatecodeID, 'N' AS store_and_fwd_flag,
               pu_zone AS PULocationID, do_zone AS DOLocationID, pay AS payment_type,
               {num('fare')} AS fare_amount, {num('tip')} AS tip_amount, {num('total')} AS total_amount,
               {", ".join(f"0.0::DOUBLE AS {c}" for c in charges.split())}, event_type AS source_file
        FROM trips_a""")


def extra_trips() -> str:
    """With a fee that one file has in whole numbers, one in fractions under another letter case, and one not at all."""
    fee = num("CASE event_type WHEN 'click' THEN pay WHEN 'purchase' THEN fare / 4 END")
    return raw_trips(CHARGES).replace("event_type AS source_file", f"event_type AS source_file, {fee} AS Airport_fee")


CHARGES = "extra mta_tax tolls_amount improvement_surcharge congestion_surcharge"

WEATHER_TABLE = sql(RAW, f"""
    SELECT {RAW_WEATHER.replace("skyc1, wxcodes", "skyc1, coalesce(wxcodes, 'M') AS wxcodes")},
           {LISTED_NAME} AS station_name, {LISTED_ZONE} AS station_zone,
           station || '_20240101_20240131' AS source_file, {day('valid')} AS valid_date
    FROM obs""")

SLIM = f"""{TRIP_KEYS}, pu AS pickup_datetime, pu_date AS pickup_date, fare AS fare_amount,
    pass AS passenger_count"""
SLIM_OUT = tidy(
    "vendor_id pickup_location_id dropoff_location_id passenger_count",
    "fare_amount", "pickup_datetime", "pickup_date",
)


# The declared checks, kind by kind. What follows a column is what the check needs.
NOT_NULL = {
    "stg_yellow_trips": "pickup_datetime dropoff_datetime trip_duration_seconds trip_distance",
    "stg_zone_to_station_mapping": "taxi_zone_id station_id",
    "int_yellow_trips_validated": "pickup_datetime dropoff_datetime trip_distance",
    "fct_taxi_trips_with_weather": (
        "vendor_id pickup_datetime dropoff_datetime passenger_count trip_distance ratecode_id "
        "store_and_fwd_flag pickup_location_id dropoff_location_id payment_type_id fare_amount "
        "total_amount pickup_date pickup_year pickup_month pickup_day pickup_hour pickup_weekday "
        "trip_duration_seconds data_quality_check missing_values_flag weather_station "
        "avg_temperature_f avg_temperature_c weather_condition"
    ),
    "mart_daily_trips_all": "trip_date",
    "mart_daily_trips_valid": "trip_date",
    "mart_daily_trips_data_quality": "report_date",
    "mart_zone_analysis": (
        "LocationID Borough Zone pickup_trips dropoff_trips total_trips avg_pickup_fare "
        "avg_dropoff_fare avg_pickup_distance avg_dropoff_distance pickup_revenue dropoff_revenue"
    ),
    "mart_daily_weather_impact": (
        "pickup_date weather_condition trip_count active_pickup_zones active_dropoff_zones avg_fare "
        "avg_total_amount avg_tip avg_tip_percentage avg_distance avg_duration_minutes "
        "avg_temperature max_precipitation min_visibility"
    ),
    "mart_zone_weather_performance": (
        "pickup_location_id weather_condition total_trips avg_fare avg_distance total_revenue "
        "avg_speed_mph revenue_per_mile avg_temperature avg_precipitation avg_visibility"
    ),
}
OTHER_CHECKS = [
    ("unique", "stg_zone_to_station_mapping", "taxi_zone_id", ()),
    ("unique", "mart_daily_trips_all", "trip_date", ()),
    ("unique", "mart_daily_trips_valid", "trip_date", ()),
    ("unique", "mart_daily_trips_data_quality", "report_date", ()),
    ("unique", "mart_zone_analysis", "LocationID", ()),
    ("accepted_values", "fct_taxi_trips_with_weather", "passenger_count", (1, 2, 3, 4, 5, 6)),
    ("accepted_values", "fct_taxi_trips_with_weather", "data_quality_check", ("Valid", "Invalid")),
    ("accepted_values", "fct_taxi_trips_with_weather", "missing_values_flag", (0, 1)),
    ("relationships", "fct_taxi_trips_with_weather", "trip_distance", ("int_yellow_trips_validated", "trip_distance")),
    ("relationships", "fct_taxi_trips_with_weather", "pickup_location_id", ("stg_zone_to_station_mapping", "taxi_zone_id")),
    ("relationships", "fct_taxi_trips_with_weather", "pickup_month", ("int_yellow_trips_validated", "pickup_month")),
    ("relationships", "fct_taxi_trips_with_weather", "weather_station", ("int_weather_hourly", "station")),
    ("relationships", "mart_zone_weather_performance", "pickup_location_id", ("fct_taxi_trips_with_weather", "pickup_location_id")),
    ("unique_combination", "mart_daily_weather_impact", "pickup_date_and_weather_condition", ("pickup_date", "weather_condition")),
    ("unique_combination", "mart_zone_weather_performance", "pickup_location_id_and_weather_condition", ("pickup_location_id", "weather_condition")),
    ("expression_is_true", "mart_daily_weather_impact", "trip_count", ("trip_count >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "active_pickup_zones", ("active_pickup_zones >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "active_dropoff_zones", ("active_dropoff_zones >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "avg_fare", ("avg_fare >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "avg_total_amount", ("avg_total_amount >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "avg_tip", ("avg_tip >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "avg_tip_percentage", ("avg_tip_percentage >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "avg_distance", ("avg_distance >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "avg_duration_minutes", ("avg_duration_minutes >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "max_precipitation", ("max_precipitation >= 0",)),
    ("expression_is_true", "mart_daily_weather_impact", "min_visibility", ("min_visibility >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "total_trips", ("total_trips >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "avg_fare", ("avg_fare >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "avg_distance", ("avg_distance >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "total_revenue", ("total_revenue >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "avg_speed_mph", ("avg_speed_mph >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "revenue_per_mile", ("revenue_per_mile >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "avg_precipitation", ("avg_precipitation >= 0",)),
    ("expression_is_true", "mart_zone_weather_performance", "avg_visibility", ("avg_visibility >= 0",)),
]


def oracle_checks() -> str:
    """Failures of each declared check, each counted by a query of its own."""
    lines = []
    expected = [("not_null", m, c, ()) for m, columns in NOT_NULL.items() for c in columns.split()]
    for kind, m, c, args in expected + OTHER_CHECKS:
        label, detail = f"'{kind}', '{m}', '{c}'", ""
        if kind == "not_null":
            count = f"SELECT count(*) FROM {m} WHERE {c} IS NULL"
        elif kind == "unique":
            count = f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        elif kind == "accepted_values":
            values = ", ".join(f"'{v}'" for v in args)
            count = f"SELECT count(DISTINCT {c}) FROM {m} WHERE CAST({c} AS VARCHAR) NOT IN ({values})"
        elif kind == "relationships":
            parent, pc = args
            count = f"SELECT count(*) FROM {m} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{pc} = x.{c})"
        elif kind == "unique_combination":
            columns = ", ".join(args)
            count = f"SELECT count(*) FROM (SELECT {columns} FROM {m} GROUP BY ALL HAVING count(*) > 1)"
        else:
            detail = args[0]
            count = f"SELECT count(*) FROM {m} WHERE NOT ({detail})"
        lines.append(f"SELECT {label}, '{detail}', ({count})")
    union = "\n    UNION ALL ".join(lines)
    return f'SELECT * FROM ({union}) AS t("check", model, "column", detail, failures)'


MODEL_VIEWS = FACT_A + f""",
stg_yellow_trips AS (SELECT {TRIP_COLUMNS} FROM stg),
stg_weather_data AS (SELECT * FROM obs WHERE valid IS NOT NULL),
stg_zone_to_station_mapping AS (SELECT * FROM mapping),
int_weather_hourly AS (SELECT * FROM hourly),
int_yellow_trips_validated AS (SELECT {TRIP_COLUMNS} FROM val),
fct_taxi_trips_with_weather AS (
    SELECT {TRIP_COLUMNS}, data_quality_check, missing_values_flag, weather_station,
           avg_temperature_f, avg_temperature_c, weather_condition
    FROM fact),
mart_daily_trips_all AS (SELECT pu_date AS trip_date FROM val GROUP BY 1),
mart_daily_trips_valid AS (SELECT pu_date AS trip_date FROM val WHERE data_quality_check = 'Valid' GROUP BY 1),
mart_daily_trips_data_quality AS (SELECT pu_date AS report_date FROM val GROUP BY 1),
mart_zone_analysis AS (
    SELECT LocationID, Borough, Zone, 0 AS pickup_trips, 0 AS dropoff_trips, 0 AS total_trips,
           0 AS avg_pickup_fare, 0 AS avg_dropoff_fare, 0 AS avg_pickup_distance,
           0 AS avg_dropoff_distance, 0 AS pickup_revenue, 0 AS dropoff_revenue
    FROM zones),
mart_daily_weather_impact AS ({WEATHER_IMPACT}),
mart_zone_weather_performance AS ({ZONE_WEATHER})"""


# The second build: what its first load had, and the last settled day then.
SECOND_TRIPS = "(pu >= TIMESTAMP '2024-01-21' OR (CAST(pu AS DATE) = DATE '2024-01-05' AND minute(pu) < 20))"
LATE_WEATHER = "(valid >= TIMESTAMP '2024-01-23' OR (CAST(valid AS DATE) = DATE '2024-01-10' AND minute(valid) < 30))"
LOCATED = VAL_A[VAL_A.index("located AS") : VAL_A.index("named AS")]
FACT_ONLY = FACT_A[len(VAL_A) :]
FIRST_FACT = (
    RAW + "," + staged(f"(SELECT * FROM trips_a WHERE NOT {SECOND_TRIPS})")
    + DIMENSIONS.replace("FROM obs", f"FROM (SELECT * FROM obs WHERE NOT {LATE_WEATHER})")
    + "," + LOCATED + labelled("2024-01-03", "2024-01-22", "located").lstrip() + FACT_ONLY
)
SECOND_RUN = (
    VAL_A + FACT_ONLY.replace("fact AS (", "fact_now AS (")
    + f""",
fact_first AS (WITH {FIRST_FACT.strip()} SELECT * FROM fact),
fact AS (
    SELECT * FROM fact_first
    UNION ALL BY NAME
    SELECT * FROM fact_now WHERE pu_date > (SELECT max(pu_date) FROM fact_first))"""
)


def content(model: str, table: str, numbers: str = "", text: str = "", days: str = "", times: str = "") -> str:
    """One row per column: values that are there, and their sum; of text its length, of days those since 2020,
    of times their hours. A column is `name` or `name=expression`."""
    forms = ((numbers, "{}"), (text, "length({})"), (days, "datediff('day', DATE '2020-01-01', CAST({} AS DATE))"), (times, "hour({})"))
    rows = []
    for columns, form in forms:
        for column in filter(None, (c.strip() for c in columns.split(";"))):
            name, _, expression = column.partition("=")
            value = expression or name
            total = f"round(sum(CAST({form.format(value)} AS DOUBLE)) + 3e-9, 3)"
            rows.append(f"""SELECT '{model}' AS model, '{name}' AS "column", count({value}) AS n, {total} AS total FROM {table}""")
    return "\n    UNION ALL ".join(rows)


def second_run() -> str:
    trip = (
        "passenger_count=pass; trip_distance=dist; ratecode_id=1; pickup_location_id=pu_zone; dropoff_location_id=do_zone;"
        "payment_type_id=pay; fare_amount=fare; extra=0; mta_tax=0; tip_amount=tip; tolls_amount=0; improvement_surcharge=0;"
        "total_amount=total; congestion_surcharge=0; pickup_year=year(pu); pickup_month=month(pu); pickup_day=day(pu);"
        "pickup_hour=hour(pu); pickup_weekday=dayofweek(pu) + 1; trip_duration_seconds=secs;"
    )
    words, moments = "vendor_id=vendor; store_and_fwd_flag='N';", "pickup_datetime=pu; dropoff_datetime=doff;"
    hour = "; ".join(HOUR_NUMBERS.split())
    observed = (
        "lat; lon; temperature_f=tmpf; temperature_c=(tmpf - 32) * 5 / 9; precipitation_inches=p01i; visibility_miles=vsby;"
        "wind_speed_knots=sknt; wind_gust_knots=gust; hour_of_day=hour(valid); day_of_week=dayofweek(valid) + 1"
    )
    all_days = "(" + daily_all("x AS (SELECT 1)").split("\n", 1)[1] + ")"
    valid_days = "(" + daily_valid("x AS (SELECT 1)").split("\n", 1)[1] + ")"
    quality_days = "(" + daily_quality("x AS (SELECT 1)").split("\n", 1)[1] + ")"
    zones = "(" + zones_of("x AS (SELECT 1)").split("\n", 1)[1] + ")"
    daily = "total_trips; active_vendors; total_passengers; avg_distance; avg_duration_minutes; total_fare; total_tips; total_revenue; avg_tip_percentage"
    parts = [
        content("stg_yellow_trips", "stg", trip, words, "pickup_date=pu_date", moments + "pickup_hour_rounded=pu_hour"),
        content("stg_weather_data", "obs", observed, "station; station_name; station_zone; sky_condition=skyc1; weather_codes=wxcodes", "observation_date=valid", "observation_time=valid; observation_hour=valid"),
        content("stg_zone_to_station_mapping", "mapping", "taxi_zone_id", "taxi_zone_name; taxi_borough; station_id; station_name; station_zone"),
        content("int_weather_hourly", "hourly", f"{hour}; hour_of_day; observation_count", "station; station_name; station_zone; weather_condition", "observation_date", "observation_hour"),
        content(
            "int_yellow_trips_validated", "val",
            trip + "is_valid_pickup_date=CAST(is_valid_pickup_date AS INTEGER); is_valid_dropoff_date=CAST(is_valid_dropoff_date AS INTEGER)",
            words + "station_id; station_name; station_zone; weather_condition; data_quality_check; missing_values_flag",
            "pickup_date=pu_date", moments + "pickup_hour_rounded=pu_hour",
        ),
        content("fct_taxi_trips_with_weather", "fact", trip + hour, words + "weather_station; station_name; station_zone; weather_condition; data_quality_check; missing_values_flag", "pickup_date=pu_date", moments),
        content("mart_daily_trips_all", all_days, daily, "", "trip_date"),
        content("mart_daily_trips_valid", valid_days, daily + "; avg_passengers_per_trip", "", "trip_date"),
        content("mart_daily_trips_data_quality", quality_days, "total_records; valid_records; invalid_records; invalid_duration; zero_distance; negative_fare; invalid_passengers; incomplete_records; valid_rate; complete_rate", "", "report_date"),
        content("mart_zone_analysis", zones, "LocationID; pickup_trips; dropoff_trips; total_trips; avg_pickup_fare; avg_dropoff_fare; avg_pickup_distance; avg_dropoff_distance; pickup_revenue; dropoff_revenue", "Borough; Zone; service_zone; primary_zone_role"),
        content("mart_daily_weather_impact", f"({WEATHER_IMPACT})", "trip_count; active_pickup_zones; active_dropoff_zones;" + "; ".join(IMPACT_NUMBERS.split()), "weather_condition", "pickup_date"),
        content("mart_zone_weather_performance", f"({ZONE_WEATHER})", "pickup_location_id; total_trips;" + "; ".join(ZONE_WEATHER_NUMBERS.split()), "weather_condition"),
    ]
    return sql(SECOND_RUN, "\n    UNION ALL ".join(parts))


def oracle_sql() -> dict[str, str]:
    queries = {
        "stg_trips": sql(STG_A, f"SELECT {TRIP_COLUMNS}, {stamp('pu_hour')} AS pickup_hour_rounded FROM stg"),
        "stg_weather": sql(RAW, f"""
            SELECT station, {stamp('valid')} AS observation_time, station_name, station_zone,
                   {num('lat')} AS lat, {num('lon')} AS lon, {num('tmpf')} AS temperature_f,
                   {num('(tmpf - 32) * 5 / 9')} AS temperature_c, {num('p01i')} AS precipitation_inches,
                   {num('vsby')} AS visibility_miles, {num('sknt')} AS wind_speed_knots,
                   {num('gust')} AS wind_gust_knots, skyc1 AS sky_condition, wxcodes AS weather_codes,
                   {stamp("date_trunc('hour', valid)")} AS observation_hour,
                   {day('valid')} AS observation_date, hour(valid) AS hour_of_day,
                   dayofweek(valid) + 1 AS day_of_week
            FROM obs WHERE valid IS NOT NULL"""),
        "zone_station_mapping": sql(RAW + DIMENSIONS, "SELECT * FROM mapping"),
        "latest_per_station": sql(RAW, """
            SELECT station AS station_id, station_name, station_zone FROM (
                SELECT station, valid, station_name, station_zone FROM obs
                UNION ALL
                SELECT 'U' || CAST(user_id AS VARCHAR), date_trunc('day', ts), event_type,
                       'z' || CAST(event_id % 5 AS VARCHAR)
                FROM events)
            QUALIFY row_number() OVER (
                PARTITION BY station
                ORDER BY valid DESC NULLS LAST, station_name NULLS FIRST, station_zone NULLS FIRST) = 1"""),
        "weather_hourly": sql(RAW + DIMENSIONS, f"""
            SELECT station, station_name, station_zone, {stamp('observation_hour')} AS observation_hour,
                   {day('observation_date')} AS observation_date, hour_of_day,
                   {tidy("weather_condition observation_count", HOUR_NUMBERS)}
            FROM hourly"""),
        "trips_validated": sql(VAL_A, f"""
            SELECT {TRIP_COLUMNS}, {stamp('pu_hour')} AS pickup_hour_rounded, station_id, station_name,
                   station_zone, weather_condition, data_quality_check, missing_values_flag,
                   is_valid_pickup_date, is_valid_dropoff_date
            FROM val"""),
        "quality_label_counts": sql(VAL_A, "SELECT data_quality_check, count(*) AS trips FROM val GROUP BY 1"),
        "missing_flag_counts": sql(VAL_A, "SELECT missing_values_flag, count(*) AS trips FROM val GROUP BY 1"),
        "valid_date_counts": sql(VAL_A, """
            SELECT is_valid_pickup_date, is_valid_dropoff_date, count(*) AS trips FROM val GROUP BY ALL"""),
        "trips_with_weather": sql(FACT_A, f"""
            SELECT {TRIP_COLUMNS}, data_quality_check, missing_values_flag, weather_station,
                   station_name, station_zone, {tidy("weather_condition", HOUR_NUMBERS)}
            FROM fact"""),
        "daily_trips_all": daily_all(VAL_A),
        "daily_trips_valid": daily_valid(VAL_A),
        "daily_data_quality": daily_quality(VAL_A),
        "pickup_zone_metrics": one_end("pu_zone", "Pickup"),
        "dropoff_zone_metrics": one_end("do_zone", "Dropoff"),
        "zone_analysis": zones_of(VAL_A),
        "daily_weather_impact": sql(FACT_A, f"""
            SELECT {tidy("weather_condition trip_count active_pickup_zones active_dropoff_zones",
                         IMPACT_NUMBERS, "", "pickup_date")}
            FROM ({WEATHER_IMPACT}) ORDER BY pickup_date DESC, weather_condition"""),
        "zone_weather_performance": sql(FACT_A, f"""
            SELECT {tidy("pickup_location_id weather_condition total_trips", ZONE_WEATHER_NUMBERS)}
            FROM ({ZONE_WEATHER})"""),
        "model_row_counts": sql(FACT_A, """
            SELECT 'stg_yellow_trips' AS model, count(*) AS n_rows FROM stg
            UNION ALL SELECT 'stg_weather_data', count(*) FROM obs
            UNION ALL SELECT 'stg_zone_to_station_mapping', count(*) FROM mapping
            UNION ALL SELECT 'int_weather_hourly', count(*) FROM hourly
            UNION ALL SELECT 'int_yellow_trips_validated', count(*) FROM val
            UNION ALL SELECT 'fct_taxi_trips_with_weather', count(*) FROM fact
            UNION ALL SELECT 'mart_daily_trips_all', count(DISTINCT pu_date) FROM val
            UNION ALL SELECT 'mart_daily_trips_valid', count(DISTINCT pu_date) FROM val WHERE data_quality_check = 'Valid'
            UNION ALL SELECT 'mart_daily_trips_data_quality', count(DISTINCT pu_date) FROM val
            UNION ALL SELECT 'mart_zone_analysis', count(*) FROM zones
            UNION ALL SELECT 'mart_daily_weather_impact', count(DISTINCT (pu_date, weather_condition)) FROM fact
            UNION ALL SELECT 'mart_zone_weather_performance', count(DISTINCT (pu_zone, weather_condition)) FROM fact"""),
        "build_models_second_run": second_run(),
        "quality_label_counts_b": sql(VAL_B, "SELECT data_quality_check, count(*) AS trips FROM val GROUP BY 1"),
        "daily_trips_all_b": daily_all(VAL_B),
        "daily_trips_valid_b": daily_valid(VAL_B),
        "daily_data_quality_b": daily_quality(VAL_B),
        "zone_analysis_b": zones_of(VAL_B),
        "safe_casts": """
            SELECT event_id,
                   CAST(sign(event_id % 41 - 20) * floor(abs(event_id % 41 - 20) / 2.0 + 0.5) AS BIGINT) AS half_as_int,
                   CASE WHEN event_id % 3 <> 0 THEN user_id END AS mixed_as_int,
                   CAST(CASE WHEN event_id % 3 <> 0 THEN user_id END AS DOUBLE) AS mixed_as_double,
                   CAST(CASE event_id % 4 WHEN 0 THEN user_id WHEN 3 THEN user_id + 0.5 END AS DOUBLE) AS suffixed_as_double
            FROM events""",
        "clean_numeric": f"""
            SELECT event_id, CASE WHEN event_id % 10 >= 8 THEN {num('value')} END AS tmpf FROM events""",
        "parse_valid": f"""
            SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN {stamp("date_trunc('minute', ts)")} END AS valid
            FROM events""",
        "hour_alignment": sql(STG_A, f"""
            SELECT {stamp('pu_hour')} AS pickup_hour_rounded, dayofweek(pu) + 1 AS pickup_weekday,
                   count(*) AS trips
            FROM stg GROUP BY ALL"""),
        "views_by_name": sql(STG_A, """
            SELECT Borough, count(*) AS trips FROM stg JOIN zones ON LocationID = pu_zone GROUP BY 1"""),
        "column_subset": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
        "config_projection": """
            SELECT o_orderkey, year(o_orderdate) AS order_year, o_orderpriority LIKE '1%' AS is_urgent
            FROM orders""",
        "station_lookup": sql(RAW, f"""
            SELECT station AS file_station, {LISTED_NAME} AS station_name, {LISTED_ZONE} AS station_zone,
                   count(*) AS observations
            FROM obs GROUP BY ALL"""),
        "loaded_files": sql(FILE_ROWS, "SELECT DISTINCT source_file FROM files WHERE day(ts) <= 10"),
        "new_files": sql(FILE_ROWS, """
            SELECT source_file FROM files EXCEPT SELECT source_file FROM files WHERE day(ts) <= 10"""),
        "prune_files": sql(FILE_ROWS, """
            SELECT DISTINCT source_file FROM files
            WHERE NOT contains(source_file, '_')
               OR split_part(source_file, '_', 2) BETWEEN '20240105' AND '20240120'"""),
        "file_stats": sql(FILE_ROWS, "SELECT source_file, count(*) AS rows FROM files GROUP BY 1"),
        "coverage_gaps": sql(RAW, f"""
            SELECT s.station, {stamp('g.period')} AS period
            FROM (SELECT DISTINCT station FROM obs) s,
                 generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR) g(period)
            WHERE NOT EXISTS (SELECT 1 FROM obs o
                              WHERE o.station = s.station AND date_trunc('hour', o.valid) = g.period)"""),
        "missing_weather_files": sql(RAW, """
            SELECT station, start_date, end_date, year_month,
                   station || '_' || replace(start_date, '-', '') || '_' || replace(end_date, '-', '') || '.csv'
                       AS source_file
            FROM (SELECT DISTINCT station FROM obs) s,
                 (VALUES ('2024-01-15', '2024-01-31', '2024/01'), ('2024-02-01', '2024-02-29', '2024/02'),
                         ('2024-03-01', '2024-03-28', '2024/03')) m(start_date, end_date, year_month)
            WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.station = s.station
                              AND strftime(o.valid, '%Y/%m') = m.year_month AND m.start_date = '2024-01-15')"""),
        "missing_trip_files": """
            SELECT strftime(m, '%Y/%m') AS year_month, 'orders_' || strftime(m, '%Y-%m') || '.parquet' AS source_file
            FROM generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2003-06-01', INTERVAL 1 MONTH) g(m)
            WHERE NOT EXISTS (SELECT 1 FROM orders WHERE date_trunc('month', o_orderdate) = m)""",
        "ingest_weather": WEATHER_TABLE,
        "stream_weather": WEATHER_TABLE,
        "weather_file_positional_preamble": WEATHER_TABLE,
        "stream_weather_positional_preamble": WEATHER_TABLE,
        "weather_file_lines": sql(RAW, f"""
            SELECT station, {stamp('valid')} AS valid, CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS DOUBLE) AS lat,
                   {", ".join(f"{num(c)} AS {c}" for c in ("tmpf", "p01i", "vsby", "sknt"))},
                   CASE WHEN day(valid) % 2 = 1 THEN {num('gust')} END AS gust,
                   CAST(NULL AS VARCHAR) AS skyc1, CAST(NULL AS VARCHAR) AS wxcodes,
                   '2024-03-28' AS file_date, {LISTED_NAME} AS station_name, {LISTED_ZONE} AS station_zone,
                   station || '_' || strftime(valid, '%Y%m%d') || '_' || strftime(valid, '%Y%m%d') || '.csv'
                       AS source_file,
                   {day('valid')} AS valid_date
            FROM obs"""),
        "ingest_trips": raw_trips(CHARGES),
        "stream_trips": raw_trips(CHARGES),
        "ingest_trips_extra_columns": extra_trips(),
        "stream_trips_extra_columns": extra_trips(),
        "ingest_trips_ledger_column": raw_trips(CHARGES).replace("event_type AS source_file", "event_type AS loaded_from"),
        "ingest_report": """
            SELECT event_type AS source_file, count(*) AS "rows", 'loaded' AS outcome, CAST(NULL AS VARCHAR) AS reason
            FROM events WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1
            UNION ALL SELECT 'none', 0, 'empty', NULL""",
        "stream_report": """
            SELECT CAST(1 AS BIGINT) AS run, event_type AS source_file, 'loaded' AS outcome, count(*) AS "rows", FALSE AS has_reason
            FROM events WHERE event_type IN ('click', 'purchase', 'view') GROUP BY event_type
            UNION ALL SELECT 1, 'late', 'failed', 0, TRUE
            UNION ALL SELECT 2, 'late', 'loaded', count(*), FALSE FROM events WHERE event_type = 'view'""",
        "ingest_trips_fields": sql(RAW, f"""
            SELECT {stamp('pu')} AS tpep_pickup_datetime, {num('dist')} AS trip_distance,
                   pu_zone AS PULocationID, {num('total - tip')} AS net_amount, event_type AS source_file
            FROM trips_a"""),
        "incremental_two_step": sql(STG_A, f"""
            SELECT {SLIM_OUT} FROM (
                SELECT {SLIM} FROM stg WHERE pu_date <= DATE '2024-01-15'
                UNION ALL BY NAME
                SELECT {SLIM.replace("fare AS", "fare + 1000 AS")} FROM stg WHERE pu_date > (
                    SELECT max(pu_date) FROM stg WHERE pu_date <= DATE '2024-01-15'))"""),
        "high_water_filter": f"""
            SELECT o_orderkey, {stamp('o_orderdate')} AS o_orderdate FROM orders
            WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders
                                 WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2000-01-01')""",
        "full_refresh": sql(STG_A, f"SELECT {SLIM_OUT} FROM (SELECT {SLIM} FROM stg)"),
        "upsert_keys": sql(STG_A, f"""
            , slim AS (SELECT {SLIM} FROM stg),
            batch AS (SELECT * REPLACE (fare_amount + 1000 AS fare_amount) FROM slim
                      WHERE pickup_date >= DATE '2024-01-12')
            SELECT {SLIM_OUT} FROM (
                SELECT * FROM slim s WHERE pickup_date <= DATE '2024-01-15' AND NOT EXISTS (
                    SELECT 1 FROM batch b WHERE b.pickup_datetime = s.pickup_datetime
                    AND b.pickup_location_id = s.pickup_location_id
                    AND b.dropoff_location_id = s.dropoff_location_id AND b.vendor_id = s.vendor_id)
                UNION ALL SELECT * FROM batch)"""),
        "append_evolving": """
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
                   CASE WHEN l_returnflag = 'N' THEN 'N' END AS l_returnflag
            FROM lineitem""",
        "append_wide_integers": f"""
            SELECT l_orderkey,
                   CASE WHEN l_returnflag = 'N' THEN CAST(CAST(l_quantity + 0.5 AS DOUBLE) AS VARCHAR)
                        ELSE CAST(l_orderkey + 9007199254740992 AS VARCHAR) END AS far,
                   {num("CASE WHEN l_returnflag = 'N' THEN l_quantity + 0.5 ELSE l_orderkey END")} AS near
            FROM lineitem""",
        "append_widening": f"""
            SELECT l_orderkey, {num("CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE floor(l_quantity) END")} AS amount
            FROM lineitem""",
        "append_letter_case": f"""
            SELECT l_orderkey, {num("CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE l_quantity END")} AS amount
            FROM lineitem""",
        "partitioned_roundtrip": f"""
            SELECT o_orderkey, o_custkey, {num('o_totalprice')} AS o_totalprice,
                   strftime(o_orderdate, '%Y-%m-01') AS "month"
            FROM orders""",
        "dq_not_null": sql(STG_A, f"""
            SELECT vendor AS vendor_id, {stamp('pu')} AS pickup_datetime, pu_zone AS pickup_location_id
            FROM stg WHERE pass IS NULL"""),
        "dq_unique": """
            SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
            GROUP BY 1 HAVING count(*) > 1""",
        "dq_accepted_values": sql(STG_A, """
            SELECT pass AS passenger_count, count(*) AS n_records FROM stg WHERE pass NOT IN (1, 2, 3) GROUP BY 1"""),
        "dq_relationships": sql(STG_A + DIMENSIONS, f"""
            SELECT {stamp('pu')} AS pickup_datetime, vendor AS vendor_id, pu_zone AS pickup_location_id
            FROM stg WHERE pu_zone IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM mapping WHERE taxi_zone_id = pu_zone)"""),
        "dq_orphan_values": """
            SELECT l_orderkey, count(*) AS n_records FROM lineitem
            WHERE l_orderkey IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority LIKE '1%')
            GROUP BY 1""",
        "dq_unique_combination": """
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_records
            FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "dq_expression": sql(VAL_B, """
            SELECT vendor AS vendor_id, pu_zone AS pickup_location_id, count(*) AS failures
            FROM val WHERE NOT (secs >= 0) GROUP BY ALL"""),
        "dq_summary": sql(MODEL_VIEWS, oracle_checks()),
        "dq_two_expressions_one_column": sql(STG_A, """
            SELECT 'expression_is_true__stg__fare_amount__1' AS name, count(*) AS failures FROM stg WHERE NOT (fare >= 0)
            UNION ALL
            SELECT 'expression_is_true__stg__fare_amount__2', count(*) FROM stg WHERE NOT (fare < 40)"""),
        "dq_stored_failures": sql(STG_A, f"""
            SELECT vendor AS vendor_id, {stamp('pu')} AS pickup_datetime, pu_zone AS pickup_location_id,
                   {num('fare')} AS fare_amount
            FROM stg WHERE NOT (fare >= 0)"""),
    }
    renamed = FACT_A.replace("code || ' airfield' AS station_name", "code || ' airfield' || CASE WHEN value < 40 THEN ' north' ELSE ' south' END AS station_name")
    queries["trips_with_weather_renamed"] = sql(renamed, f"""
        SELECT {day('pu_date')} AS pickup_date, weather_station, station_name, weather_condition,
               count(*) AS trips, {num('sum(fare)')} AS fares
        FROM fact GROUP BY ALL""")
    # the same results by the other form of the lookup joins
    for name in ("trips_validated", "daily_weather_impact"):
        queries[f"{name}_shuffled"] = queries[name]
    return queries
