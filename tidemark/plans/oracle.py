"""For each query of the catalog, SQL that gives the same rows from the same tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

TRIPS = """trips AS (
  SELECT event_id AS trip_id, ts AS tpep_pickup_datetime,
         ts + to_minutes(1 + event_id % 50) AS tpep_dropoff_datetime,
         CAST(10000 + user_id % 20 AS INTEGER) AS pickup_zip,
         CAST(10000 + (user_id * 7 + event_id) % 20 AS INTEGER) AS dropoff_zip,
         value / 10 AS trip_distance, value AS fare_amount
  FROM events)"""

READINGS = """readings AS (
  SELECT CAST(user_id % 50 + 1 AS INTEGER) AS sensor_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id * 3) AS event_time,
         value - 10 AS temperature, (event_id * 37 % 1100) / 10 AS humidity,
         CAST(990 + event_id % 21 AS DOUBLE) AS pressure
  FROM events)"""

BROKEN = """broken AS (
  SELECT CASE WHEN sensor_id = 13 THEN 13000 ELSE sensor_id END AS sensor_id,
         CASE WHEN sensor_id <> 17 THEN event_time END AS event_time,
         CASE WHEN sensor_id <> 19 THEN temperature END AS temperature, humidity, pressure
  FROM readings)"""

PREDS = """preds AS (
  SELECT event_id AS trip_id, 1 + event_id % 2 AS model_id, value * 0.9 + event_id % 7 AS prediction,
         value AS fare_amount, ts AS timestamp
  FROM events)"""

READING_COLUMNS = """sensor_id, event_time, round(temperature, 6) AS temperature,
       round(humidity, 6) AS humidity, round(pressure, 6) AS pressure"""

STRICT = "temperature BETWEEN -5 AND 80 AND humidity BETWEEN 0 AND 100"
WIDE = "temperature BETWEEN -10 AND 80 AND humidity BETWEEN 0 AND 100"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def bucket(column: str, minutes: int) -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', {column}, {EPOCH})"


def sliding_end(column: str, size: int, slide: int) -> str:
    """End of the i-th window that holds a row, for i from 0 to size/slide - 1."""
    return f"{bucket(column, slide)} - i * INTERVAL '{slide} minutes' + INTERVAL '{size} minutes'"


def single(expression: str) -> str:
    """A 32-bit float shown as a double of three digits."""
    return f"round(CAST(CAST({expression} AS FLOAT) AS DOUBLE), 3)"


# --- scans and inputs -------------------------------------------------------------------

SQL["scan_by_path"] = "SELECT event_id, ts, user_id, event_type, value FROM events"
SQL["scan_by_name"] = f"""WITH {TRIPS}
SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, pickup_zip, dropoff_zip, fare_amount FROM trips"""
SQL["sql_input"] = f"""WITH {TRIPS}
SELECT pickup_zip, count(*) AS n, round(sum(fare_amount), 2) AS fares FROM trips GROUP BY pickup_zip"""

# --- filters and columns ----------------------------------------------------------------

SQL["time_range_filter"] = f"""WITH {TRIPS}
SELECT trip_id, tpep_pickup_datetime, fare_amount FROM trips
WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-10' AND tpep_pickup_datetime < TIMESTAMP '2024-01-20'"""
SQL["open_range_filter"] = f"""WITH {TRIPS}
SELECT trip_id, tpep_pickup_datetime, fare_amount FROM trips WHERE tpep_pickup_datetime < TIMESTAMP '2024-01-10'"""
SQL["plausibility_filter"] = f"WITH {READINGS} SELECT {READING_COLUMNS} FROM readings WHERE {STRICT}"
SQL["plausibility_wide"] = f"WITH {READINGS} SELECT {READING_COLUMNS} FROM readings WHERE {WIDE}"
SQL["enforce_schema"] = f"WITH {READINGS} SELECT {READING_COLUMNS} FROM readings WHERE sensor_id <> 7"
SQL["rescue_bad_rows"] = """
SELECT CASE WHEN event_id % 97 <> 0 THEN event_id END AS event_id,
       CASE WHEN event_id % 97 <> 0 THEN CAST(user_id % 50 + 1 AS INTEGER) END AS sensor_id,
       CASE WHEN event_id % 97 <> 0 THEN round(value - 10, 6) END AS temperature,
       CASE WHEN event_id % 97 <> 0 THEN CAST(event_id % 100 AS DOUBLE) END AS humidity,
       CASE WHEN event_id % 97 = 0 THEN '{"event_id": ' || event_id
            WHEN event_id % 50 = 1 THEN '{"site":"east","shift":"' || event_id % 3 || '"}' END AS _rescued_data
FROM events"""
SQL["rescue_nested"] = """WITH made AS (
  SELECT *, event_id % 97 = 0 AS cut, list_filter([
    CASE WHEN event_id % 8 = 5 THEN '"site":{"east":true}' END,
    CASE WHEN event_id % 6 = 2 THEN '"place.sensor_id":"north"' END,
    CASE WHEN event_id % 4 = 1 THEN '"place.zone.since":2020' END,
    CASE WHEN event_id % 10 = 3 THEN '"temperature":"hot"' END,
    CASE WHEN event_id % 9 = 4 THEN '"levels":[{"x":1},{"x":2,"y":3}]' END], lambda part: part IS NOT NULL) AS left_over
  FROM events)
SELECT CASE WHEN NOT cut THEN event_id END AS event_id,
       CASE WHEN NOT cut AND event_id % 6 <> 2 THEN CAST(user_id % 50 + 1 AS INTEGER) END AS sensor_id,
       CASE WHEN NOT cut THEN 'z' || event_id END AS code,
       CASE WHEN NOT cut AND event_id % 10 <> 3 THEN floor(value) END AS temperature,
       CASE WHEN cut THEN NULL WHEN event_id % 9 = 4 THEN '1,2' ELSE '5' END AS levels,
       CASE WHEN cut THEN '{"event_id":' || event_id
            WHEN len(left_over) > 0 THEN '{' || array_to_string(left_over, ',') || '}' END AS _rescued_data
FROM made"""
SQL["stamp_constants"] = f"""WITH {PREDS}
SELECT trip_id, round(prediction, 6) AS prediction, CAST(3 AS INTEGER) AS model_id,
       TIMESTAMP '2024-02-01 11:00:00' AS timestamp FROM preds"""

# --- scalar functions -------------------------------------------------------------------

SQL["month_keys"] = f"WITH {TRIPS} SELECT trip_id, strftime(tpep_dropoff_datetime, '%Y-%m') AS yyyy_mm FROM trips"
WEEKEND = "CAST(isodow(({0} AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 6 AS INTEGER)"
SQL["weekend_flags"] = f"""WITH {TRIPS}
SELECT trip_id, {WEEKEND.format("tpep_pickup_datetime")} AS is_weekend FROM trips"""


def rounding(column: str, minutes: int, direction: str = "up") -> str:
    """Grid that restarts each hour, in whole microseconds."""
    step = minutes * 60_000_000
    into = f"(epoch_us({column}) % 3600000000)"
    whole = f"(({into} + {step - 1}) // {step})" if direction == "up" else f"({into} // {step})"
    return f"date_trunc('hour', {column}) + to_microseconds({whole} * {step})"


for _name, _minutes, _direction in (
    ("round_up_15", 15, "up"),
    ("round_up_30", 30, "up"),
    ("round_up_45", 45, "up"),
    ("round_down_15", 15, "down"),
):
    SQL[_name] = f"""WITH {TRIPS}
SELECT trip_id, {rounding("tpep_pickup_datetime", _minutes, _direction)} AS rounded_at FROM trips"""

SQL["epoch_round_trip"] = f"""WITH {TRIPS}
SELECT trip_id, epoch_us(tpep_pickup_datetime) // 1000000 AS seconds,
       date_trunc('second', tpep_pickup_datetime) AS at FROM trips"""


def rounded_trips(direction: str = "up") -> str:
    return f"""rounded AS (
  SELECT trip_id, pickup_zip, dropoff_zip, trip_distance, fare_amount,
         {rounding("tpep_pickup_datetime", 15, direction)} AS rounded_pickup_datetime,
         {rounding("tpep_dropoff_datetime", 30, direction)} AS rounded_dropoff_datetime
  FROM trips)"""


SQL["rounded_trips"] = f"""WITH {TRIPS}, {rounded_trips()}
SELECT trip_id, pickup_zip, dropoff_zip, round(trip_distance, 6) AS trip_distance, fare_amount,
       rounded_pickup_datetime, rounded_dropoff_datetime FROM rounded"""


def hash_number(key: str, seed: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


def noise(seed: str) -> str:
    return f"({hash_number('event_id', seed)} / 4294967296.0 - 0.5)"


SQL["synth_wave"] = f"""
SELECT CAST(event_id % 50 + 1 AS INTEGER) AS sensor_id, ts AS event_time,
       round(20.0 + 10.0 * sin(event_id * 0.05::DOUBLE) + {noise("temperature")} * 3.0, 6) AS temperature,
       round(50.0 + 20.0 * cos(event_id * 0.03::DOUBLE) + {noise("humidity")} * 5.0, 6) AS humidity,
       round(1000.0 + {noise("pressure")} * 20.0, 6) AS pressure
FROM events"""

# --- time-window features ---------------------------------------------------------------


def pickup(where: str = "TRUE", source: str = "trips") -> str:
    return f"""
  SELECT pickup_zip AS zip, window_end AS tpep_pickup_datetime, strftime(window_end, '%Y-%m') AS yyyy_mm,
         {single("avg(fare_amount)")} AS mean_fare_window_1h_pickup_zip,
         CAST(count(*) AS INTEGER) AS count_trips_window_1h_pickup_zip
  FROM (SELECT pickup_zip, fare_amount, {sliding_end("tpep_pickup_datetime", 60, 15)} AS window_end
        FROM {source}, range(4) AS r(i) WHERE {where})
  GROUP BY pickup_zip, window_end"""


DROPOFF = f"""
  SELECT dropoff_zip AS zip, window_end AS tpep_dropoff_datetime, strftime(window_end, '%Y-%m') AS yyyy_mm,
         CAST(count(*) AS INTEGER) AS count_trips_window_30m_dropoff_zip,
         {WEEKEND.format("window_end")} AS dropoff_is_weekend
  FROM (SELECT dropoff_zip, {bucket("tpep_dropoff_datetime", 30)} + INTERVAL '30 minutes' AS window_end FROM trips)
  GROUP BY dropoff_zip, window_end"""

SQL["pickup_features"] = f"WITH {TRIPS} {pickup()}"
IN_RANGE = "tpep_pickup_datetime >= TIMESTAMP '2024-01-10' AND tpep_pickup_datetime < TIMESTAMP '2024-01-20'"
SQL["pickup_features_in_range"] = f"WITH {TRIPS} {pickup(IN_RANGE)}"
SQL["dropoff_features"] = f"WITH {TRIPS} {DROPOFF}"
SQL["sensor_features"] = f"""WITH {READINGS}
SELECT sensor_id, window_end AS event_time, strftime(window_end, '%Y-%m') AS yyyy_mm,
       {single("avg(temperature)")} AS mean_temp_1h, {single("stddev_samp(temperature)")} AS stddev_temp_1h,
       {single("avg(humidity)")} AS mean_humidity_1h, CAST(count(*) AS INTEGER) AS event_count_1h
FROM (SELECT *, {sliding_end("event_time", 60, 15)} AS window_end FROM readings, range(4) AS r(i))
GROUP BY sensor_id, window_end"""

# --- sensor layers ----------------------------------------------------------------------


def silver(windows: str, where: str, count: str) -> str:
    return f"""silver AS (
  SELECT sensor_id, window_end AS event_time, strftime(window_end, '%Y-%m') AS yyyy_mm,
         avg(temperature) AS avg_temp_5m, avg(humidity) AS avg_humidity_5m,
         min(pressure) AS min_pressure_5m, max(pressure) AS max_pressure_5m, count(*) AS {count}
  FROM ({windows}) WHERE {where} GROUP BY sensor_id, window_end)"""


SLIDING = silver(
    f"SELECT *, {sliding_end('event_time', 5, 1)} AS window_end FROM readings, range(5) AS r(i)",
    STRICT,
    "count_records_5m",
)
TUMBLING = silver(
    f"SELECT *, {bucket('event_time', 5)} + INTERVAL '5 minutes' AS window_end FROM readings", WIDE, "count_5m"
)


def silver_rows(count: str) -> str:
    return f"""SELECT sensor_id, event_time, yyyy_mm, round(avg_temp_5m + 1.3e-10, 8) AS avg_temp_5m,
       round(avg_humidity_5m + 1.3e-10, 8) AS avg_humidity_5m, round(min_pressure_5m + 1.3e-10, 8) AS min_pressure_5m,
       round(max_pressure_5m + 1.3e-10, 8) AS max_pressure_5m, {count} FROM silver"""


def gold(count: str) -> str:
    return f"""gold AS (
  SELECT sensor_id, window_end AS event_time, strftime(window_end, '%Y-%m') AS yyyy_mm,
         avg(avg_temp_5m) AS mean_temp_1h, stddev_samp(avg_temp_5m) AS std_temp_1h,
         avg(avg_humidity_5m) AS mean_humidity_1h, max_by(max_pressure_5m, event_time) AS last_pressure_1h,
         CAST(sum({count}) AS BIGINT) AS total_records_1h
  FROM (SELECT *, {bucket("event_time", 60)} + INTERVAL '60 minutes' AS window_end FROM silver)
  GROUP BY sensor_id, window_end)"""


GOLD_COLUMNS = """sensor_id, event_time, yyyy_mm, round(mean_temp_1h + 1.3e-10, 8) AS mean_temp_1h,
       round(std_temp_1h + 1.3e-10, 8) AS std_temp_1h, round(mean_humidity_1h + 1.3e-10, 8) AS mean_humidity_1h,
       round(last_pressure_1h + 1.3e-10, 8) AS last_pressure_1h, total_records_1h"""
FORECAST = "mean_temp_1h + (epoch_us(event_time) // 1000000) * 1.0::DOUBLE"

SQL["bronze_rules"] = f"""WITH {READINGS}, {BROKEN}
SELECT {READING_COLUMNS} FROM broken WHERE event_time IS NOT NULL AND sensor_id BETWEEN 1 AND 10000"""
SQL["silver_sliding"] = f"WITH {READINGS}, {SLIDING} {silver_rows('count_records_5m')}"
SQL["silver_tumbling"] = f"WITH {READINGS}, {TUMBLING} {silver_rows('count_5m')}"
SQL["gold_sliding"] = f"WITH {READINGS}, {SLIDING}, {gold('count_records_5m')} SELECT {GOLD_COLUMNS} FROM gold"
SQL["gold_tumbling"] = f"WITH {READINGS}, {TUMBLING}, {gold('count_5m')} SELECT {GOLD_COLUMNS} FROM gold"
SQL["gold_from_stored_silver"] = SQL["gold_tumbling"]
SQL["gold_forecast"] = f"""WITH {READINGS}, {TUMBLING}, {gold('count_5m')}
SELECT sensor_id, event_time, round({FORECAST} + 0.000013, 3) AS forecast_feature FROM gold"""
SQL["drop_null_rows"] = f"""WITH {READINGS}, {TUMBLING}, {gold('count_5m')}
SELECT {GOLD_COLUMNS} FROM gold WHERE std_temp_1h IS NOT NULL"""

# --- quality rules ----------------------------------------------------------------------

_RULES = {
    "valid_event_time": "event_time IS NOT NULL",
    "valid_sensor_id": "sensor_id BETWEEN 1 AND 10000",
    "not_null_temperature": "temperature IS NOT NULL",
    "temperature_safe_range": "temperature BETWEEN -20 AND 120",
    "valid_temperature": "temperature BETWEEN -5 AND 80",
    "valid_humidity": "humidity BETWEEN 0 AND 100",
}
SQL["expect_report"] = f"WITH {READINGS}, {BROKEN} " + " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS passed, "
    f"count(*) FILTER (WHERE NOT coalesce({rule}, FALSE)) AS failed FROM broken"
    for name, rule in _RULES.items()
)
SQL["expect_drop"] = f"WITH {READINGS}, {BROKEN} SELECT {READING_COLUMNS} FROM broken WHERE {STRICT}"
SQL["expect_keep"] = f"""WITH {READINGS}, {BROKEN}
SELECT count(*) AS kept, count(*) AS checked, count(*) - count(temperature) AS failed_not_null_temperature,
       count(*) - count(*) FILTER (WHERE temperature >= -20 AND temperature <= 120) AS failed_temperature_safe_range
FROM broken"""

# --- point-in-time lookup ---------------------------------------------------------------

FEATURES = f"pickup AS ({pickup()}), dropoff AS ({DROPOFF})"
PICKUP_MATCH = "ASOF LEFT JOIN pickup AS p ON t.pickup_zip = p.zip AND p.tpep_pickup_datetime <= {0}"
DROPOFF_MATCH = "ASOF LEFT JOIN dropoff AS d ON t.dropoff_zip = d.zip AND d.tpep_dropoff_datetime <= {0}"
PICKUP_COLUMNS = "p.mean_fare_window_1h_pickup_zip, p.count_trips_window_1h_pickup_zip"
DROPOFF_COLUMNS = "d.count_trips_window_30m_dropoff_zip, d.dropoff_is_weekend"

SQL["lookup_pickup"] = f"""WITH {TRIPS}, {rounded_trips()}, {FEATURES}
SELECT t.trip_id, t.pickup_zip, t.rounded_pickup_datetime, {PICKUP_COLUMNS}
FROM rounded AS t {PICKUP_MATCH.format("t.rounded_pickup_datetime")}"""
SQL["lookup_dropoff"] = f"""WITH {TRIPS}, {rounded_trips()}, {FEATURES}
SELECT t.trip_id, t.dropoff_zip, t.rounded_dropoff_datetime, {DROPOFF_COLUMNS}
FROM rounded AS t {DROPOFF_MATCH.format("t.rounded_dropoff_datetime")}"""
SQL["lookup_exact_times"] = f"""WITH {TRIPS}, {FEATURES}
SELECT t.trip_id, t.pickup_zip, t.tpep_pickup_datetime, {PICKUP_COLUMNS}
FROM trips AS t {PICKUP_MATCH.format("t.tpep_pickup_datetime")}"""


def training_set(direction: str) -> str:
    return f"""WITH {TRIPS}, {rounded_trips(direction)}, {FEATURES}
SELECT t.trip_id, t.pickup_zip, t.dropoff_zip, round(t.trip_distance, 6) AS trip_distance, t.fare_amount,
       {PICKUP_COLUMNS}, {DROPOFF_COLUMNS}
FROM rounded AS t {PICKUP_MATCH.format("t.rounded_pickup_datetime")}
{DROPOFF_MATCH.format("t.rounded_dropoff_datetime")}"""


SQL["training_set"] = training_set("up")
SQL["training_set_no_leak"] = training_set("down")

# --- keyed upsert -----------------------------------------------------------------------

SQL["upsert_features"] = f"""WITH {TRIPS},
current_rows AS ({pickup("tpep_pickup_datetime < TIMESTAMP '2024-01-20'")}),
incoming AS ({pickup("tpep_pickup_datetime >= TIMESTAMP '2024-01-10'")})
SELECT * FROM current_rows AS c WHERE NOT EXISTS (
  SELECT 1 FROM incoming AS n WHERE n.zip = c.zip AND n.tpep_pickup_datetime = c.tpep_pickup_datetime)
UNION ALL SELECT * FROM incoming"""

SQL["feature_table_upsert"] = SQL["upsert_features"]
SQL["upsert_new_column"] = f"""WITH {TRIPS},
current_rows AS ({pickup("tpep_pickup_datetime < TIMESTAMP '2024-01-20'")}),
incoming AS ({pickup("tpep_pickup_datetime >= TIMESTAMP '2024-01-10'")})
SELECT coalesce(n.zip, c.zip) AS zip, coalesce(n.tpep_pickup_datetime, c.tpep_pickup_datetime) AS tpep_pickup_datetime,
       coalesce(n.yyyy_mm, c.yyyy_mm) AS yyyy_mm,
       coalesce(n.mean_fare_window_1h_pickup_zip, c.mean_fare_window_1h_pickup_zip) AS mean_fare_window_1h_pickup_zip,
       coalesce(n.count_trips_window_1h_pickup_zip, c.count_trips_window_1h_pickup_zip)
         AS count_trips_window_1h_pickup_zip,
       CAST(n.zip % 7 AS INTEGER) AS zip_group
FROM current_rows AS c FULL JOIN incoming AS n
  ON n.zip = c.zip AND n.tpep_pickup_datetime = c.tpep_pickup_datetime"""
SQL["feature_job_in_parts"] = SQL["full_refresh"] = SQL["pickup_features"]
SQL["named_overwrite"] = f"""WITH {PREDS}
SELECT model_id, round(prediction, 6) AS prediction, round(fare_amount, 6) AS fare_amount, timestamp
FROM preds WHERE model_id = 1"""
SQL["hash_split_rows"] = """
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS in_both, TRUE AS near_75 FROM events"""

# --- split, scoring input, labels -------------------------------------------------------

SQL["hash_split_75"] = f"""
SELECT event_id AS trip_id, {hash_number("event_id", "123")} % 100 < 75 AS in_train FROM events"""
SQL["hash_split_80"] = f"""
SELECT event_id AS trip_id,
       CASE WHEN {hash_number("event_id", "42")} % 100 < 80 THEN 'train' ELSE 'test' END AS part FROM events"""
SQL["score_prepare"] = f"""WITH {TRIPS}, {rounded_trips()}
SELECT trip_id, pickup_zip, dropoff_zip, round(trip_distance, 6) AS trip_distance,
       rounded_pickup_datetime, rounded_dropoff_datetime FROM rounded"""
SQL["lookup_hot_key"] = f"""WITH {TRIPS}, told AS (
  SELECT tpep_pickup_datetime AS at, max(fare_amount) AS fare, max(trip_id) AS told_by
  FROM trips WHERE trip_id % 5 = 0 GROUP BY 1)
SELECT trip_id, tpep_pickup_datetime, round(fare, 6) AS fare, told_by
FROM trips ASOF LEFT JOIN told ON tpep_pickup_datetime >= told.at"""

SQL["score_lookup"] = f"""WITH {TRIPS}, {rounded_trips()}, {FEATURES}
SELECT t.trip_id, t.pickup_zip, t.dropoff_zip, round(t.trip_distance, 6) AS trip_distance,
       t.rounded_pickup_datetime, t.rounded_dropoff_datetime, {PICKUP_COLUMNS}, {DROPOFF_COLUMNS}
FROM rounded AS t {PICKUP_MATCH.format("t.rounded_pickup_datetime")}
{DROPOFF_MATCH.format("t.rounded_dropoff_datetime")}"""
SQL["label_join"] = f"""WITH {TRIPS}, {PREDS}
SELECT p.trip_id, p.model_id, round(p.prediction, 6) AS prediction, p.timestamp, t.fare_amount
FROM preds AS p LEFT JOIN trips AS t
ON t.trip_id = p.trip_id AND t.tpep_pickup_datetime < TIMESTAMP '2024-01-20'"""

# --- evaluation -------------------------------------------------------------------------

METRICS = """count(*) AS example_count, avg(abs(prediction - fare_amount)) AS mean_absolute_error,
         avg((prediction - fare_amount) ** 2) AS mean_squared_error,
         sqrt(avg((prediction - fare_amount) ** 2)) AS root_mean_squared_error,
         sum(fare_amount) AS sum_on_target, avg(fare_amount) AS mean_on_target,
         1 - avg((prediction - fare_amount) ** 2) / var_pop(fare_amount) AS r2_score,
         max(abs(prediction - fare_amount)) AS max_error,
         avg(abs(prediction - fare_amount) / greatest(abs(fare_amount), 2.220446049250313e-16))
           AS mean_absolute_percentage_error"""
SQL["regression_metrics"] = f"""WITH {PREDS}, m AS (SELECT {METRICS} FROM preds)
SELECT example_count, round(mean_absolute_error, 6) AS mean_absolute_error,
       round(mean_squared_error, 6) AS mean_squared_error,
       round(root_mean_squared_error, 6) AS root_mean_squared_error, round(sum_on_target, 6) AS sum_on_target,
       round(mean_on_target, 6) AS mean_on_target, round(r2_score, 6) AS r2_score, round(max_error, 6) AS max_error,
       round(mean_absolute_percentage_error, 6) AS mean_absolute_percentage_error FROM m"""
SQL["squared_diff_plus_one"] = f"""WITH {PREDS}
SELECT round(sum(abs(prediction - fare_amount + 1) ** 2), 4) AS squared_diff_plus_one FROM preds"""
SQL["threshold_gate"] = f"""WITH {PREDS}, m AS (SELECT {METRICS} FROM preds)
SELECT 'max_error' AS metric, round(max_error, 6) AS value, 500.0::DOUBLE AS threshold,
       max_error <= 500 AS passed FROM m
UNION ALL
SELECT 'mean_squared_error', round(mean_squared_error, 6), 500.0::DOUBLE, mean_squared_error <= 500 FROM m"""


def change(metric: str, sign: str, passed: str) -> str:
    gain = f"(n.{metric} - o.{metric})" if sign == "+" else f"(o.{metric} - n.{metric})"
    return f"""SELECT '{metric}' AS metric, round(n.{metric}, 6) AS candidate, round(o.{metric}, 6) AS baseline,
       round({gain}, 6) AS absolute_change, round({gain} / abs(o.{metric}), 6) AS relative_change,
       {passed.format(gain=gain, old=f"o.{metric}")} AS passed
FROM m AS n, m AS o WHERE n.model_id = 2 AND o.model_id = 1"""


SQL["baseline_compare"] = (
    f"WITH {PREDS}, m AS (SELECT model_id, {METRICS} FROM preds GROUP BY model_id) "
    + change("max_error", "-", "TRUE")
    + " UNION ALL "
    + change("mean_squared_error", "-", "{gain} / abs({old}) >= 0.01")
    + " UNION ALL "
    + change("r2_score", "+", "{gain} >= 0.0001")
)

# --- monitoring -------------------------------------------------------------------------

PROFILE = """profile AS (
  SELECT date_trunc('day', timestamp)::TIMESTAMP AS window_start,
         date_trunc('day', timestamp)::TIMESTAMP + INTERVAL '1 day' AS window_end,
         ':table' AS column_name, CAST(NULL AS VARCHAR) AS slice_key,
         CASE WHEN grouping(model_id) = 1 THEN '*' ELSE CAST(model_id AS VARCHAR) END AS model_id,
         'INPUT' AS log_type, count(*) AS count,
         avg(abs(prediction - fare_amount)) AS mean_average_error,
         avg((prediction - fare_amount) ** 2) AS mean_squared_error,
         sqrt(avg((prediction - fare_amount) ** 2)) AS root_mean_squared_error,
         avg(abs(prediction - fare_amount) / greatest(abs(fare_amount), 2.220446049250313e-16))
           AS mean_absolute_percentage_error,
         CASE WHEN var_pop(fare_amount) <> 0
              THEN 1 - avg((prediction - fare_amount) ** 2) / var_pop(fare_amount) END AS r2_score
  FROM preds GROUP BY GROUPING SETS ((date_trunc('day', timestamp), model_id), (date_trunc('day', timestamp))))"""
SQL["profile_by_day_model"] = f"""WITH {PREDS}, {PROFILE}
SELECT window_start, window_end, column_name, slice_key, model_id, log_type, count,
       round(mean_average_error, 6) AS mean_average_error, round(mean_squared_error, 6) AS mean_squared_error,
       round(root_mean_squared_error, 6) AS root_mean_squared_error,
       round(mean_absolute_percentage_error, 6) AS mean_absolute_percentage_error,
       round(r2_score, 6) AS r2_score FROM profile"""
AGED = """aged AS (
  SELECT *, row_number() OVER (ORDER BY window_start DESC, model_id) AS age
  FROM profile WHERE model_id <> '*')"""
SQL["recent_windows"] = f"""WITH {PREDS}, {PROFILE}, {AGED}
SELECT window_start, window_end, model_id, round(root_mean_squared_error, 6) AS root_mean_squared_error
FROM aged WHERE age <= 5"""


def violation(threshold: float) -> str:
    """Each metric row gets its age, newest first; one aggregate then looks at ages 1 to 5."""
    high = f"root_mean_squared_error > {threshold}"
    return f"""WITH {PREDS}, {PROFILE}, {AGED}
SELECT CAST(count(*) FILTER (WHERE {high} AND age <= 5) >= 2 AND count(*) FILTER (WHERE {high} AND age = 1) > 0 AS INTEGER)
       AS query_result FROM aged"""


SQL["violation_check"] = violation(100.0)
SQL["violation_check_low_limit"] = violation(3.0)
SQL["violation_by_model"] = f"""WITH {PREDS}, {PROFILE}, ranked AS (
  SELECT model_id, root_mean_squared_error AS rmse,
         row_number() OVER (PARTITION BY model_id ORDER BY window_start DESC) AS age
  FROM profile WHERE model_id <> '*')
SELECT model_id,
       CAST(CASE WHEN count(*) FILTER (WHERE rmse > 5.4) >= 2 AND max(rmse) FILTER (WHERE age = 1) > 5.4
            THEN 1 ELSE 0 END AS INTEGER) AS query_result
FROM ranked WHERE age <= 5 GROUP BY model_id"""

_EDGES = [10, 25, 50, 100, 200]
_CELLS = " UNION ALL ".join(f"SELECT {i} AS cell" for i in range(len(_EDGES) + 1))
_CASE = " ".join(f"WHEN fare < {edge} THEN {i}" for i, edge in enumerate(_EDGES))
SQL["drift_by_day"] = f"""WITH {TRIPS},
fares AS (
  SELECT date_trunc('day', tpep_pickup_datetime)::TIMESTAMP AS d,
         CASE WHEN trip_id % 11 <> 0 THEN fare_amount END AS fare FROM trips),
placed AS (SELECT d, fare, CASE WHEN fare IS NULL THEN NULL {_CASE} ELSE {len(_EDGES)} END AS cell FROM fares),
days AS (SELECT d, count(*) AS n_rows, count(*) - count(fare) AS nulls, avg(fare) AS mean, count(fare) AS present
         FROM fares GROUP BY d),
cells AS ({_CELLS}),
counts AS (
  SELECT days.d, cells.cell, count(placed.cell) AS n
  FROM days CROSS JOIN cells LEFT JOIN placed ON placed.d = days.d AND placed.cell = cells.cell
  GROUP BY days.d, cells.cell),
base AS (SELECT cell, sum(n) FILTER (WHERE d < TIMESTAMP '2024-01-10') AS b FROM counts GROUP BY cell),
shares AS (
  SELECT c.d, c.cell, c.n,
         (c.n + 0.5) / (sum(c.n) OVER (PARTITION BY c.d) + 3.0) AS p,
         (coalesce(b.b, 0) + 0.5) / (sum(coalesce(b.b, 0)) OVER (PARTITION BY c.d) + 3.0) AS q
  FROM counts AS c JOIN base AS b ON b.cell = c.cell),
psi AS (SELECT d, sum((p - q) * ln(p / q)) AS stability_index FROM shares GROUP BY d),
pct AS (SELECT d, quantile_disc(fare, 0.5) AS percentile FROM fares GROUP BY d)
SELECT days.d AS window_start, days.d + INTERVAL '1 day' AS window_end, n_rows AS rows, nulls,
       round(mean, 6) AS mean, round(CAST(percentile AS DOUBLE), 6) AS percentile,
       round(CAST(stability_index AS DOUBLE), 6) AS stability_index
FROM days JOIN psi ON psi.d = days.d LEFT JOIN pct ON pct.d = days.d"""

# --- streams ----------------------------------------------------------------------------

SQL["stream_bronze"] = SQL["bronze_rules"]
SQL["stream_json_rescue"] = SQL["rescue_bad_rows"]
SQL["stream_silver_closed"] = f"""WITH {READINGS}, {SLIDING}
{silver_rows('count_records_5m')} WHERE event_time <=
  (SELECT max(event_time) - INTERVAL '10 minutes' FROM readings WHERE {STRICT})"""

# --- models -----------------------------------------------------------------------------

TESTED = "count(*) AS example_count, round(sum({0}), 2) AS label_sum, round(avg({0}), 4) AS label_mean, round(var_pop({0}), 4) AS error_of_mean"
SQL["profile_refreshed"] = SQL["profile_by_day_model"]
SQL["train_score_boosted"] = f"""
SELECT {TESTED.format("value")} FROM events WHERE {hash_number("event_id", "123")} % 100 >= 75"""
SQL["train_score_forest"] = f"""WITH {READINGS}, {SLIDING}, {gold('count_records_5m')}
SELECT {TESTED.format("mean_temp_1h")} FROM gold
WHERE std_temp_1h IS NOT NULL AND {hash_number("sensor_id || '|' || strftime(event_time, '%Y-%m-%d %H:%M:%S')", "42")} % 100 >= 80"""
SQL["score_table"] = f"""WITH {TRIPS}, {rounded_trips()}, {FEATURES}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS without_prediction, count(DISTINCT t.trip_id) AS trips,
       CAST(sum(p.count_trips_window_1h_pickup_zip) AS BIGINT) AS looked_up,
       CAST(7 AS INTEGER) AS model_id, TIMESTAMP '2024-02-01 11:00:00' AS timestamp
FROM rounded AS t {PICKUP_MATCH.format("t.rounded_pickup_datetime")}"""
SQL["training_example"] = f"""WITH {READINGS}, {SLIDING}, {gold('count_records_5m')}
SELECT round(std_temp_1h + 1.3e-10, 8) AS std_temp_1h, round(mean_humidity_1h + 1.3e-10, 8) AS mean_humidity_1h,
       round(last_pressure_1h + 1.3e-10, 8) AS last_pressure_1h, total_records_1h
FROM (SELECT *, sensor_id || '|' || strftime(event_time, '%Y-%m-%d %H:%M:%S') AS row_key FROM gold)
WHERE std_temp_1h IS NOT NULL AND {hash_number("row_key", "42")} % 100 >= 80 ORDER BY row_key LIMIT 5"""
SQL["validation_modes"] = f"""WITH {PREDS}, measured AS (
  SELECT max(abs(prediction - fare_amount)) <= 500 AND avg((prediction - fare_amount) ** 2) <= 500 AS ok FROM preds)
SELECT 'disabled' AS mode, CAST(0 AS INTEGER) AS checks, CAST(NULL AS BOOLEAN) AS passed, FALSE AS refused
UNION ALL SELECT 'dry_run', 2, ok, FALSE FROM measured
UNION ALL SELECT 'enabled', CASE WHEN ok THEN 2 ELSE 0 END, ok, NOT ok FROM measured"""
SQL["stream_stored_silver"] = SQL["silver_tumbling"]
SQL["stream_late_rows"] = SQL["silver_tumbling"]
SQL["stream_rule_counts"] = f"""WITH {READINGS}, {BROKEN}
SELECT count(*) FILTER (event_time IS NOT NULL AND sensor_id BETWEEN 1 AND 10000) AS kept,
       CAST(6 AS BIGINT) AS batches, count(*) AS checked,
       count(*) FILTER (event_time IS NULL) AS failed_valid_event_time,
       count(*) FILTER (sensor_id NOT BETWEEN 1 AND 10000) AS failed_valid_sensor_id
FROM broken"""
SQL["stream_labels"] = """WITH told AS (
  SELECT event_id, value, ts + to_minutes(event_id % 180) AS labelled_at FROM events WHERE event_id % 5 <> 0),
passed AS (  -- the older of the two watermarks, in whole milliseconds as streams keep them
  SELECT date_trunc('milliseconds', least((SELECT max(ts) FROM events), (SELECT max(labelled_at) FROM told)))
         - INTERVAL '1 hour' AS mark)
SELECT e.event_id AS trip_id, round(e.value * 0.9 + e.event_id % 7, 6) AS prediction, e.ts AS timestamp,
       round(t.value, 6) AS fare_amount
FROM events e LEFT JOIN told t ON t.event_id = e.event_id AND t.labelled_at <= e.ts + INTERVAL '2 hours', passed
WHERE t.event_id IS NOT NULL OR e.ts + INTERVAL '2 hours' < mark"""
SQL["stream_rate"] = """
SELECT event_id, make_timestamp((1700000000000 + event_id // (1 + (SELECT max(event_id) FROM events) // 6) * 60000) * 1000)
       AS timestamp, round(value, 6) AS fare
FROM events"""
_BOTH_MONTHS = READINGS.replace("readings AS (", "first_month AS (") + """, readings AS (
  SELECT * FROM first_month
  UNION ALL SELECT sensor_id, event_time + INTERVAL '31 days', temperature, humidity, pressure FROM first_month)"""
SQL["refresh_from_month"] = f"WITH {_BOTH_MONTHS}, {TUMBLING}, {gold('count_5m')} SELECT {GOLD_COLUMNS} FROM gold"
SQL["stream_rescue_nested"] = SQL["rescue_nested"]
SQL["profile_from_states"] = SQL["profile_by_day_model"]
SQL["drift_from_sketches"] = f"""WITH {TRIPS}, steps AS (SELECT list(i ORDER BY i) AS s FROM range(1, 1025) AS r(i)),
told AS (
  SELECT date_trunc('day', tpep_pickup_datetime)::TIMESTAMP AS d,
         unnest(['fare_amount', 'trip_distance']) AS column_name,
         unnest([CASE WHEN trip_id % 11 <> 0 THEN fare_amount END, trip_distance]) AS v
  FROM trips),
sorted AS (
  SELECT d, column_name, count(*) AS n_rows, count(v) AS n, avg(v) AS mean,
         list_sort(list(v) FILTER (v IS NOT NULL)) AS vs FROM told GROUP BY ALL),
cut AS (SELECT *, list_transform(s, lambda i: vs[(i * n + 1023) // 1024]) AS cuts FROM sorted, steps),
early AS (
  SELECT column_name, count(v) AS n, list_sort(list(v)) AS vs
  FROM told WHERE d + INTERVAL '1 day' <= TIMESTAMP '2024-01-10' AND v IS NOT NULL GROUP BY 1),
base AS (SELECT column_name, list_transform(s, lambda i: vs[(i * n + 1023) // 1024]) AS base_cuts FROM early, steps),
days AS (
  SELECT cut.*, vs[1] AS smallest, vs[-1] AS largest, vs[(n + 1) // 2] AS percentile, base_cuts,
         list_filter(list_concat(cuts, base_cuts), lambda value, place: place % 16 = 0) AS points
  FROM cut LEFT JOIN base USING (column_name)),
apart AS (
  SELECT d, column_name, list_max(list_transform(points, lambda p: abs(
           len(list_filter(cuts, lambda c: c <= p)) - len(list_filter(base_cuts, lambda c: c <= p))))) / 1024 AS distance
  FROM days WHERE n > 0)
SELECT d AS window_start, d + INTERVAL '1 day' AS window_end, column_name, n_rows AS rows, n_rows - n AS nulls,
       round(mean + 1.3e-10, 8) AS mean, round(smallest + 1.3e-10, 8) AS smallest, round(largest + 1.3e-10, 8) AS largest,
       round(percentile + 1.3e-10, 8) AS percentile, round(distance + 1.3e-10, 8) AS distance
FROM days LEFT JOIN apart USING (d, column_name)"""
