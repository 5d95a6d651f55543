"""Independent ANSI-SQL (DuckDB dialect) statements of every registered query.

They run against the same parquet tables, pre-registered as views, and are
written from the model definitions -- not generated from the Spark code.
Building blocks are CTEs; ``sql(...)`` stitches the ones a query needs.
"""
from __future__ import annotations

# --- fixtures (same arithmetic as kerbside.sources.fixtures) -------------------
CTE = {}

CTE["trips_raw"] = """
trips_raw AS (
  SELECT ts AS tpep_pickup_datetime,
         ts + to_minutes(event_id % 90 - 5) AS tpep_dropoff_datetime,
         user_id % 25 AS pulocationid,
         nullif(event_id % 26, 25) AS dolocationid,
         nullif(event_id % 7, 0) AS passenger_count,
         CAST((event_id % 40) * 0.5 AS DOUBLE) AS trip_distance,
         CASE WHEN event_type = 'error' THEN -value ELSE value END AS total_amount,
         'yellow' AS _source_dataset,
         CASE WHEN event_id % 97 = 0 THEN '2023-12' ELSE strftime(ts, '%Y-%m') END AS _source_month,
         event_id AS _event_id
  FROM events)"""

CTE["bronze_trips"] = """
bronze_trips AS (
  SELECT * EXCLUDE (_event_id) FROM trips_raw
  UNION ALL
  SELECT * EXCLUDE (_event_id) FROM trips_raw WHERE _event_id % 10 = 0)"""

CTE["silver"] = """
silver AS (
  SELECT CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
         CAST(round(pulocationid) AS INTEGER) AS pickup_zone_id,
         CAST(round(dolocationid) AS INTEGER) AS dropoff_zone_id,
         CAST(round(passenger_count) AS INTEGER) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(total_amount AS DOUBLE) AS total_amount,
         _source_month AS source_month
  FROM bronze_trips
  WHERE total_amount > 0 AND NOT isnan(total_amount)
    AND trip_distance > 0 AND NOT isnan(trip_distance)
    AND tpep_pickup_datetime IS NOT NULL
    AND strftime(CAST(tpep_pickup_datetime AS TIMESTAMP), '%Y-%m') = _source_month)"""

KEY_SQL = """upper(md5(
    strftime(pickup_ts, '%Y-%m-%d %H:%M:%S.%f') || '|' ||
    strftime(dropoff_ts, '%Y-%m-%d %H:%M:%S.%f') || '|' ||
    CAST(pickup_zone_id AS VARCHAR) || '|' ||
    coalesce(CAST(dropoff_zone_id AS VARCHAR), '') || '|' ||
    CAST(trip_distance AS VARCHAR) || '|' ||
    CAST(total_amount AS VARCHAR) || '|' ||
    coalesce(CAST(passenger_count AS VARCHAR), '')))"""

KEYED_COLUMNS = f"""{KEY_SQL} AS trip_key,
         CAST(pickup_ts AS DATE) AS pickup_date,
         CAST(strftime(pickup_ts, '%Y%m%d') AS INTEGER) AS pickup_date_key,
         CAST(strftime(pickup_ts, '%Y%m%d%H') AS BIGINT) AS pickup_weather_key,
         pickup_zone_id, dropoff_zone_id, pickup_ts, dropoff_ts,
         date_sub('minute', pickup_ts, dropoff_ts) AS trip_minutes,
         passenger_count, trip_distance, total_amount"""

CTE["keyed"] = f"""
keyed AS (
  SELECT {KEYED_COLUMNS}
  FROM silver WHERE dropoff_ts >= pickup_ts)"""

FACT_LIST = ("trip_key, pickup_date, pickup_date_key, pickup_weather_key, pickup_zone_id, "
             "dropoff_zone_id, pickup_ts, dropoff_ts, trip_minutes, passenger_count, "
             "trip_distance, total_amount")

CTE["fact"] = f"""
fact AS (
  SELECT {FACT_LIST} FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_key ORDER BY dropoff_ts NULLS LAST) AS _rn
    FROM keyed WHERE trip_key IS NOT NULL) WHERE _rn = 1)"""

CTE["bronze_weather"] = """
bronze_weather AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS observed_at,
         value AS temperature_2m,
         CAST(event_id % 3 AS DOUBLE) AS precipitation,
         CAST(event_id % 20 AS DOUBLE) AS wind_speed_10m,
         CAST(event_id % 4 AS BIGINT) AS weather_code,
         strftime(ts, '%Y-%m') AS _source_month
  FROM events WHERE event_type = 'view')"""


def _exact_avg(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(28,9))) AS DOUBLE) / count({c})"


CTE["hourly_weather"] = f"""
hourly_weather AS (
  SELECT date_trunc('hour', strptime(observed_at, '%Y-%m-%dT%H:%M')) AS weather_hour,
         {_exact_avg('temperature_2m')} AS temperature_2m,
         {_exact_avg('precipitation')} AS precipitation,
         {_exact_avg('wind_speed_10m')} AS wind_speed_10m
  FROM bronze_weather GROUP BY 1)"""

CTE["mart"] = f"""
mart AS (
  SELECT t.pickup_zone_id, t.pickup_hour, t.trip_count, t.revenue, t.avg_distance,
         w.temperature_2m, w.precipitation
  FROM (SELECT pickup_zone_id, date_trunc('hour', pickup_ts) AS pickup_hour,
               count(*) AS trip_count,
               CAST(sum(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS revenue,
               {_exact_avg('trip_distance')} AS avg_distance
        FROM silver GROUP BY 1, 2) t
  LEFT JOIN hourly_weather w ON t.pickup_hour = w.weather_hour)"""

CTE["dim_date"] = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(d AS DATE) AS date_day,
         CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(isodow(d) AS INTEGER) AS day_of_week,
         isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(CAST(min(pickup_ts) AS DATE), CAST(max(pickup_ts) AS DATE),
                                      INTERVAL 1 DAY)) AS d FROM silver))"""

CTE["dim_weather"] = """
dim_weather AS (
  SELECT CAST(strftime(weather_hour, '%Y%m%d%H') AS BIGINT) AS weather_key,
         weather_hour, temperature_2m, precipitation, wind_speed_10m,
         precipitation > 0 AS is_wet
  FROM hourly_weather)"""

CTE["zones_v1"] = """
zones_v1 AS (
  SELECT CAST(n_nationkey AS INTEGER) AS zone_id, r_name AS borough, n_name AS zone_name,
         CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
              ELSE 'Airports' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

# Expected SCD2 history, written per case from the version rules:
# v2 renames keys % 5 = 0 and drops keys % 11 = 10; v3 restores v1.
CTE["zone_history_v2"] = """
zone_history_v2 AS (
  SELECT zone_id, borough, zone_name, service_zone,
         TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
         CASE WHEN zone_id % 5 = 0 OR zone_id % 11 = 10
              THEN TIMESTAMP '2024-02-01 00:00:00' END AS valid_to
  FROM zones_v1
  UNION ALL
  SELECT zone_id, borough, zone_name || ' North', service_zone,
         TIMESTAMP '2024-02-01 00:00:00', CAST(NULL AS TIMESTAMP)
  FROM zones_v1 WHERE zone_id % 5 = 0 AND zone_id % 11 <> 10)"""

CTE["zone_history"] = """
zone_history AS (
  SELECT zone_id, borough, zone_name, service_zone, valid_from,
         CASE WHEN valid_to IS NULL AND valid_from = TIMESTAMP '2024-02-01 00:00:00'
              THEN TIMESTAMP '2024-03-01 00:00:00' ELSE valid_to END AS valid_to
  FROM zone_history_v2
  UNION ALL
  SELECT zone_id, borough, zone_name, service_zone,
         TIMESTAMP '2024-03-01 00:00:00', CAST(NULL AS TIMESTAMP)
  FROM zones_v1 WHERE zone_id % 5 = 0 OR zone_id % 11 = 10)"""

CTE["dim_zone"] = """
dim_zone AS (
  SELECT zone_id, borough, zone_name, service_zone, valid_from, valid_to,
         valid_to IS NULL AS is_current
  FROM zone_history)"""

CTE["volume_silver"] = """
volume_silver AS (
  SELECT o_orderdate AS pickup_ts, l_shipdate AS dropoff_ts,
         CAST(l_suppkey AS INTEGER) AS pickup_zone_id,
         CAST(l_linenumber AS INTEGER) AS dropoff_zone_id,
         CAST(NULL AS INTEGER) AS passenger_count,
         l_quantity AS trip_distance, l_extendedprice AS total_amount,
         strftime(o_orderdate, '%Y-%m') AS source_month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CTE["volume_fact"] = f"""
volume_fact AS (
  SELECT {FACT_LIST} FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_key ORDER BY dropoff_ts NULLS LAST) AS _rn
    FROM (SELECT {KEYED_COLUMNS} FROM volume_silver WHERE dropoff_ts >= pickup_ts)
    WHERE trip_key IS NOT NULL) WHERE _rn = 1)"""

CTE["clean_weather"] = """
clean_weather AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M') AS observed_at,
         value AS temperature_2m,
         CAST(event_id % 3 AS DOUBLE) AS precipitation,
         CAST(event_id % 20 AS DOUBLE) AS wind_speed_10m,
         CAST(event_id % 4 AS BIGINT) AS weather_code,
         strftime(ts, '%Y-%m') AS _source_month
  FROM events WHERE event_type = 'view'
  QUALIFY row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%dT%H:%M') ORDER BY event_id) = 1)"""

CTE["clean_mart"] = CTE["mart"].replace("mart AS", "clean_mart AS", 1).replace("hourly_weather w", "clean_hourly w")
CTE["clean_hourly"] = (CTE["hourly_weather"].replace("hourly_weather AS", "clean_hourly AS", 1)
                       .replace("FROM bronze_weather", "FROM clean_weather"))

CTE["faint_hourly"] = """
faint_hourly AS (
  SELECT date_trunc('hour', strptime(observed_at, '%Y-%m-%dT%H:%M')) AS weather_hour,
         CAST(sum(CAST(temperature_2m AS DECIMAL(28,9))) AS DOUBLE) / count(temperature_2m) AS temperature_2m,
         CAST(sum(CAST(precipitation * 2 AS BIGINT)) AS DECIMAL(28,9)) / 1000 / count(precipitation) AS p,
         CAST(sum(CAST(wind_speed_10m AS DECIMAL(28,9))) AS DOUBLE) / count(wind_speed_10m) AS wind_speed_10m,
         sum(CAST(precipitation * 2 AS BIGINT)) AS thousandths, count(precipitation) AS n
  FROM bronze_weather GROUP BY 1)"""

CTE["dirty_fact"] = """
dirty_fact AS (
  SELECT CASE WHEN trip_minutes % 17 = 0 THEN 'X' ELSE trip_key END AS trip_key, pickup_date,
         CASE WHEN trip_minutes % 19 = 0 THEN 19000101 ELSE pickup_date_key END AS pickup_date_key,
         pickup_weather_key,
         CASE WHEN trip_minutes % 13 = 0 THEN NULL ELSE pickup_zone_id END AS pickup_zone_id,
         dropoff_zone_id, pickup_ts, dropoff_ts, trip_minutes, passenger_count, trip_distance,
         CASE WHEN trip_minutes % 10 = 0 THEN CAST('nan' AS DOUBLE)
              WHEN trip_minutes % 11 = 0 THEN -total_amount ELSE total_amount END AS total_amount
  FROM fact)"""

# Dependencies between CTEs, so a query names only what it selects from.
DEPS = {
    "trips_raw": [],
    "bronze_trips": ["trips_raw"],
    "silver": ["bronze_trips"],
    "keyed": ["silver"],
    "fact": ["keyed"],
    "bronze_weather": [],
    "hourly_weather": ["bronze_weather"],
    "mart": ["silver", "hourly_weather"],
    "dim_date": ["silver"],
    "dim_weather": ["hourly_weather"],
    "zones_v1": [],
    "zone_history_v2": ["zones_v1"],
    "zone_history": ["zone_history_v2"],
    "dim_zone": ["zone_history"],
    "volume_silver": [],
    "volume_fact": ["volume_silver"],
    "clean_weather": [],
    "clean_hourly": ["clean_weather"],
    "clean_mart": ["silver", "clean_hourly"],
    "faint_hourly": ["bronze_weather"],
    "dirty_fact": ["fact"],
}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in DEPS[n]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(uses: list[str], body: str) -> str:
    """``WITH <needed CTEs> <body>``."""
    ctes = ",".join(CTE[n] for n in _order(uses))
    return f"WITH {ctes}\n{body}"
