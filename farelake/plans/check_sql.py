"""The registered queries in plain SQL, written against the test tables alone."""

from __future__ import annotations


def _avg(value: str, scale: int = 100) -> str:
    """Average rounded half up to two decimals, in whole numbers; ``scale`` makes ``value`` whole."""
    whole = f"CAST(round({value} * {scale}) AS HUGEINT)"
    up = 100 // scale
    return f"CAST((2 * {up} * sum({whole}) + count({value})) // (2 * count({value})) AS DOUBLE) / 100"


def _sum(value: str) -> str:
    return f"round(sum({value}), 2)"


TRIPS = """
trips AS (
  SELECT
    nullif(l_linenumber % 4, 3) AS VendorID,
    CASE WHEN l_orderkey % 101 <> 0 THEN l_shipdate + to_seconds(l_orderkey * 7919 % 86399) END AS tpep_pickup_datetime,
    CASE WHEN l_partkey % 103 <> 0 THEN l_shipdate + to_seconds(l_orderkey * 7919 % 86399 + l_partkey % 3607 - 60) END
      AS tpep_dropoff_datetime,
    nullif(l_suppkey % 7, 6) AS passenger_count,
    CAST(l_partkey % 2500 AS DOUBLE) / 100 AS trip_distance,
    nullif(l_partkey % 8, 0) AS RatecodeID,
    l_returnflag AS store_and_fwd_flag,
    CAST(l_partkey % 265 + 1 AS INTEGER) AS PULocationID,
    CAST(l_orderkey % 265 + 1 AS INTEGER) AS DOLocationID,
    nullif(l_suppkey % 9, 8) AS payment_type,
    l_quantity - 1 AS fare_amount,
    nullif(l_discount, 0.05::DOUBLE) AS extra,
    nullif(l_tax, 0.08::DOUBLE) AS mta_tax,
    nullif(l_quantity, 7::DOUBLE) AS tip_amount,
    nullif(l_discount, 0.1::DOUBLE) AS tolls_amount,
    nullif(l_tax, 0::DOUBLE) AS improvement_surcharge,
    CASE WHEN l_orderkey % 59 <> 0 THEN l_extendedprice ELSE 0 END AS total_amount,
    nullif(l_tax, 0.02::DOUBLE) AS congestion_surcharge,
    nullif(l_discount, 0.07::DOUBLE) AS Airport_fee,
    nullif(l_discount, 0.01::DOUBLE) AS cbd_congestion_fee
  FROM lineitem
)"""

CLEAN = """
clean AS (
  SELECT * REPLACE (
    CASE WHEN RatecodeID BETWEEN 1 AND 6 THEN RatecodeID ELSE 99 END AS RatecodeID,
    CASE WHEN payment_type BETWEEN 1 AND 6 THEN payment_type ELSE 5 END AS payment_type,
    coalesce(Airport_fee, 0) AS Airport_fee,
    coalesce(cbd_congestion_fee, 0) AS cbd_congestion_fee,
    coalesce(congestion_surcharge, 0) AS congestion_surcharge,
    coalesce(extra, 0) AS extra,
    coalesce(mta_tax, 0) AS mta_tax,
    coalesce(tolls_amount, 0) AS tolls_amount,
    coalesce(tip_amount, 0) AS tip_amount
  )
  FROM trips
  WHERE VendorID IS NOT NULL AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND payment_type IS NOT NULL
    AND tpep_dropoff_datetime > tpep_pickup_datetime
    AND passenger_count > 0 AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
    AND VendorID IN (1, 2)
    AND PULocationID > 0 AND PULocationID <= 263
    AND DOLocationID > 0 AND DOLocationID <= 263
)"""

LOCATIONS = """
dim_location AS (
  SELECT CAST(id AS INTEGER) AS location_id,
    'Borough ' || (first_part % 6) AS borough,
    'Zone ' || id AS zone,
    'Service ' || (first_part % 4) AS service_zone
  FROM (SELECT p_partkey % 265 + 1 AS id, min(p_partkey) AS first_part FROM part GROUP BY 1)
  WHERE id % 53 <> 0
)"""

LOOKUPS = """
dim_vendor(vendor_id, provider_name) AS (
  VALUES (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc')
),
dim_payment(payment_id, payment_type_name, payment_description) AS (
  VALUES (1, 'Credit card', 'Paid by credit card'), (2, 'Cash', 'Cash payment'), (3, 'No charge', 'No charge'),
    (4, 'Dispute', 'Disputed fare'), (5, 'Unknown', 'Unknown'), (6, 'Voided trip', 'Voided trip')
),
dim_ratecode(rate_code_id, rate_code_name, rate_description) AS (
  VALUES (1, 'Standard rate', 'Standard metered fare'), (2, 'JFK', 'Flat fare to/from JFK Airport'),
    (3, 'Newark', 'Fare to/from Newark Airport'), (4, 'Nassau/Westchester', 'Outside NYC'),
    (5, 'Negotiated', 'Negotiated fare'), (6, 'Group ride', 'Group/shared ride'), (99, 'Unknown', 'Unknown rate')
)"""

TIMES = """
dim_time AS (
  SELECT ts AS timestamp_id, CAST(ts AS DATE) AS date,
    CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
    strftime(ts, '%a') AS day_of_week,
    CAST(CASE WHEN strftime(ts, '%a') IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS TINYINT) AS is_weekend
  FROM (SELECT tpep_pickup_datetime AS ts FROM clean UNION SELECT tpep_dropoff_datetime FROM clean)
)"""

FACT = """
fact AS (
  SELECT pt.timestamp_id AS pickup_time_sk, dt.timestamp_id AS dropoff_time_sk,
    v.vendor_id AS vendor_sk, coalesce(r.rate_code_id, 99) AS ratecode_sk, p.payment_id AS payment_type_sk,
    pu.location_id AS pickup_location_sk, dr.location_id AS dropoff_location_sk,
    CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance AS trip_distance_miles, store_and_fwd_flag,
    fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    congestion_surcharge, Airport_fee AS airport_fee, cbd_congestion_fee,
    CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS BIGINT) AS trip_time_seconds,
    tpep_pickup_datetime AS created_at_sk
  FROM clean
  LEFT JOIN dim_vendor v ON VendorID = v.vendor_id
  LEFT JOIN dim_ratecode r ON RatecodeID = r.rate_code_id
  LEFT JOIN dim_payment p ON payment_type = p.payment_id
  LEFT JOIN dim_location pu ON PULocationID = pu.location_id
  LEFT JOIN dim_location dr ON DOLocationID = dr.location_id
  LEFT JOIN dim_time pt ON tpep_pickup_datetime = pt.timestamp_id
  LEFT JOIN dim_time dt ON tpep_dropoff_datetime = dt.timestamp_id
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_STAR = _with(TRIPS, CLEAN, LOCATIONS, LOOKUPS, TIMES, FACT)
_TIMED = "FROM fact LEFT JOIN dim_time ON pickup_time_sk = timestamp_id"

DAILY = f"""
SELECT date, year, month, day, is_weekend, total_trips, total_revenue, avg_distance, avg_duration_seconds, avg_fare,
  total_tips, avg_passengers, max_fare, min_fare,
  CAST((200 * sum(total_trips) OVER w + count(*) OVER w) // (2 * count(*) OVER w) AS DOUBLE) / 100
    AS moving_avg_trips_7d,
  CAST((2 * sum(CAST(round(total_revenue * 100) AS HUGEINT)) OVER w + count(*) OVER w)
    // (2 * count(*) OVER w) AS DOUBLE) / 100 AS moving_avg_revenue_7d
FROM (
  SELECT date, year, month, day, is_weekend, count(*) AS total_trips,
    {_sum('total_amount')} AS total_revenue,
    {_avg('trip_distance_miles')} AS avg_distance,
    {_avg('trip_time_seconds', 1)} AS avg_duration_seconds,
    {_avg('total_amount')} AS avg_fare,
    {_sum('tip_amount')} AS total_tips,
    {_avg('passenger_count', 1)} AS avg_passengers,
    max(total_amount) AS max_fare, min(total_amount) AS min_fare
  {_TIMED}
  GROUP BY date, year, month, day, is_weekend
)
WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
"""

HOURLY = f"""
SELECT hour, day_of_week, is_weekend, count(*) AS total_trips,
  {_avg('total_amount')} AS avg_fare,
  {_avg('trip_distance_miles')} AS avg_distance,
  {_avg('trip_time_seconds', 1)} AS avg_duration_seconds
{_TIMED}
GROUP BY hour, day_of_week, is_weekend
"""


def _zones(role: str) -> str:
    return f"""
SELECT *, CAST(rank() OVER (ORDER BY {role}_count DESC) AS INTEGER) AS popularity_rank
FROM (
  SELECT location_id, borough, zone, service_zone, count(*) AS {role}_count,
    {_avg('total_amount')} AS avg_fare,
    {_avg('trip_distance_miles')} AS avg_distance,
    {_sum('total_amount')} AS total_revenue
  FROM fact LEFT JOIN dim_location ON {role}_location_sk = location_id
  GROUP BY location_id, borough, zone, service_zone
)
"""


VENDOR = f"""
SELECT *, CAST(rank() OVER (PARTITION BY date ORDER BY daily_trips DESC) AS INTEGER) AS daily_rank
FROM (
  SELECT date, vendor_id, provider_name, count(*) AS daily_trips,
    {_sum('total_amount')} AS daily_revenue,
    {_avg('trip_distance_miles')} AS avg_distance,
    {_avg('total_amount')} AS avg_fare
  {_TIMED} LEFT JOIN dim_vendor ON vendor_sk = vendor_id
  GROUP BY date, vendor_id, provider_name
)
"""

PAYMENT = f"""
SELECT year, month, payment_id, payment_type_name, count(*) AS transaction_count,
  {_sum('total_amount')} AS total_revenue,
  {_sum('tip_amount')} AS total_tips,
  {_avg('total_amount')} AS avg_transaction,
  {_avg('tip_amount')} AS avg_tip
{_TIMED} LEFT JOIN dim_payment ON payment_type_sk = payment_id
GROUP BY year, month, payment_id, payment_type_name
"""

ROUTES = f"""
SELECT * FROM (
  SELECT *, CAST(rank() OVER (ORDER BY trip_count DESC) AS INTEGER) AS route_rank
  FROM (
    SELECT pu.location_id AS pickup_location_id, pu.borough AS pickup_borough, pu.zone AS pickup_zone,
      dr.location_id AS dropoff_location_id, dr.borough AS dropoff_borough, dr.zone AS dropoff_zone,
      count(*) AS trip_count,
      {_avg('trip_distance_miles')} AS avg_distance,
      {_avg('trip_time_seconds', 1)} AS avg_duration_seconds,
      {_avg('total_amount')} AS avg_fare
    FROM fact
    LEFT JOIN dim_location pu ON pickup_location_sk = pu.location_id
    LEFT JOIN dim_location dr ON dropoff_location_sk = dr.location_id
    GROUP BY 1, 2, 3, 4, 5, 6
  )
)
WHERE route_rank <= 1000
"""

REVENUE = f"""
SELECT year, month, count(*) AS total_trips,
  {_sum('fare_amount')} AS total_base_fare,
  {_sum('extra')} AS total_extra,
  {_sum('mta_tax')} AS total_mta_tax,
  {_sum('tip_amount')} AS total_tips,
  {_sum('tolls_amount')} AS total_tolls,
  {_sum('improvement_surcharge')} AS total_improvement_surcharge,
  {_sum('congestion_surcharge')} AS total_congestion_surcharge,
  {_sum('airport_fee')} AS total_airport_fee,
  {_sum('cbd_congestion_fee')} AS total_cbd_fee,
  {_sum('total_amount')} AS total_revenue
{_TIMED}
GROUP BY year, month
"""

_STORED = {
    "dim_time": "SELECT * FROM dim_time",
    "dim_vendor": "SELECT * FROM dim_vendor",
    "dim_payment": "SELECT * FROM dim_payment",
    "dim_ratecode": "SELECT * FROM dim_ratecode",
    "dim_location": "SELECT * FROM dim_location",
    "fact_trip": "SELECT * FROM fact",
    "agg_daily_trips": DAILY,
    "agg_hourly_patterns": HOURLY,
    "agg_pickup_locations": _zones("pickup"),
    "agg_dropoff_locations": _zones("dropoff"),
    "agg_vendor_performance": VENDOR,
    "agg_payment_analysis": PAYMENT,
    "agg_popular_routes": ROUTES,
    "agg_revenue_breakdown": REVENUE,
}
SUMMARY = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql})" for name, sql in _STORED.items()
)


def _windows(source: str, ts: str) -> str:
    start = f"time_bucket(INTERVAL '10 minutes', {ts}, TIMESTAMP '1970-01-01')"
    return f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
  count(*) AS trip_count
FROM (SELECT {start} AS w FROM {source} WHERE {ts} IS NOT NULL)
GROUP BY w
"""


ENRICHED = "enriched AS (SELECT * FROM trips JOIN dim_location ON PULocationID = location_id)"
_SPEED = _with(TRIPS, LOCATIONS, ENRICHED)
_EVENT_WINDOWS = _windows("events", "ts")
_LATE = """
WITH b AS (
  SELECT event_id % 4 AS batch, ts, time_bucket(INTERVAL '10 minutes', ts, TIMESTAMP '1970-01-01') AS w
  FROM events WHERE ts IS NOT NULL
), tops AS (
  SELECT batch, max(ts) AS top FROM b GROUP BY batch
), marks AS (
  SELECT c.batch, max(t.top) - INTERVAL '30 minutes' AS mark
  FROM tops c LEFT JOIN tops t ON t.batch <= c.batch - 2 GROUP BY c.batch
)
"""
LATE = _LATE + """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS trip_count
FROM b JOIN marks USING (batch)
WHERE mark IS NULL OR w + INTERVAL '10 minutes' > mark
GROUP BY w
"""
LATE_SUMMARY = _LATE + """
SELECT 'window_counts' AS query, count(DISTINCT batch) AS batches, (SELECT count(*) FROM events) AS rows_in,
  count(DISTINCT (batch, w)) FILTER (w + INTERVAL '10 minutes' <= mark) AS late_windows,
  (SELECT count(*) FROM events) - count(*) + count(*) FILTER (w + INTERVAL '10 minutes' <= mark) AS late_rows
FROM b JOIN marks USING (batch)
"""
# All columns in the order of the fact, so that rows which share a place are equal.
DENSE = """
SELECT row_number() OVER (ORDER BY pickup_time_sk NULLS FIRST, dropoff_time_sk NULLS FIRST, vendor_sk NULLS FIRST,
  ratecode_sk NULLS FIRST, payment_type_sk NULLS FIRST, pickup_location_sk NULLS FIRST,
  dropoff_location_sk NULLS FIRST, passenger_count NULLS FIRST, trip_distance_miles NULLS FIRST,
  store_and_fwd_flag NULLS FIRST, fare_amount NULLS FIRST, extra NULLS FIRST, mta_tax NULLS FIRST,
  tip_amount NULLS FIRST, tolls_amount NULLS FIRST, improvement_surcharge NULLS FIRST, total_amount NULLS FIRST,
  congestion_surcharge NULLS FIRST, airport_fee NULLS FIRST, cbd_congestion_fee NULLS FIRST,
  trip_time_seconds NULLS FIRST, created_at_sk NULLS FIRST) - 1 AS fact_trip_sk, *
FROM fact
"""
_KEY = "concat_ws(':', VendorID, strftime(tpep_pickup_datetime, '%Y-%m-%d'))"

_CBD = "nullif(l_discount, 0.01::DOUBLE) AS cbd_congestion_fee"
# The files of the last third of the trips lack the column.
MIXED = TRIPS.replace(_CBD, _CBD.replace("nullif(", "nullif(CASE WHEN l_orderkey % 3 <> 2 THEN ").replace(",", " END,", 1))

ORACLE: dict[str, str] = {
    "clean_trips": _with(TRIPS, CLEAN) + "SELECT * FROM clean",
    "mixed_trips": _with(MIXED, CLEAN) + "SELECT * FROM clean",
    "mixed_replay": _with(MIXED) + "SELECT * FROM trips",
    "dim_time": _with(TRIPS, CLEAN, TIMES) + "SELECT * FROM dim_time",
    "dim_location": _with(LOCATIONS) + "SELECT * FROM dim_location",
    "lookup_usage": _STAR
    + """
SELECT vendor_id, provider_name, rate_code_id, rate_code_name, rate_description,
  payment_id, payment_type_name, payment_description, count(*) AS trips
FROM fact
LEFT JOIN dim_vendor ON vendor_sk = vendor_id
LEFT JOIN dim_ratecode ON ratecode_sk = rate_code_id
LEFT JOIN dim_payment ON payment_type_sk = payment_id
GROUP BY ALL
""",
    "fact_trip": _STAR + "SELECT * FROM fact",
    "fact_trip_star_join": _STAR + "SELECT * FROM fact",
    "mart_daily_trips": _STAR + DAILY,
    "mart_hourly_patterns": _STAR + HOURLY,
    "mart_pickup_locations": _STAR + _zones("pickup"),
    "mart_dropoff_locations": _STAR + _zones("dropoff"),
    "mart_vendor_performance": _STAR + VENDOR,
    "mart_payment_analysis": _STAR + PAYMENT,
    "mart_popular_routes": _STAR + ROUTES,
    "mart_revenue_breakdown": _STAR + REVENUE,
    "mart_daily_trips_star_join": _STAR + DAILY,
    "mart_hourly_patterns_star_join": _STAR + HOURLY,
    "mart_vendor_performance_star_join": _STAR + VENDOR,
    "mart_payment_analysis_star_join": _STAR + PAYMENT,
    "mart_revenue_breakdown_star_join": _STAR + REVENUE,
    "batch_summary": _STAR + SUMMARY,
    "event_window_counts": _EVENT_WINDOWS,
    "stream_window_counts": _EVENT_WINDOWS,
    "stream_window_counts_update": _EVENT_WINDOWS,
    "stream_late_counts": LATE,
    "stream_summary": LATE_SUMMARY,
    "stream_enriched": _SPEED + "SELECT * FROM enriched",
    "serve_total": _SPEED + "SELECT count(*) AS num_trip FROM enriched",
    "serve_window_series": _with(TRIPS)
    + f"SELECT window_start, trip_count FROM ({_windows('trips', 'tpep_pickup_datetime')})",
    "serve_by_vendor": _SPEED + "SELECT VendorID AS vendorid, count(*) AS trip_count FROM enriched GROUP BY VendorID",
    "serve_revenue_by_dropoff": _SPEED
    + """
SELECT CAST(DOLocationID AS VARCHAR) AS doid,
  CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue
FROM enriched
GROUP BY DOLocationID
""",
    "serve_distance_tip": _SPEED + "SELECT trip_distance, tip_amount FROM enriched",
    "message_keys": _with(TRIPS)
    + f"""
SELECT {_KEY} AS key, count(*) AS messages,
  min(epoch_ms(tpep_pickup_datetime)) AS first_pickup_ms, max(epoch_ms(tpep_dropoff_datetime)) AS last_dropoff_ms
FROM trips
GROUP BY 1
""",
    "replayed_messages": _with(TRIPS)
    + f"""
SELECT {_KEY} AS key, count(*) AS messages,
  CAST(sum(epoch_ms(tpep_dropoff_datetime)) AS BIGINT) AS dropoff_ms,
  CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM trips
GROUP BY 1
""",
    "landed_days": _with(TRIPS)
    + """
SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
  CAST(day(tpep_pickup_datetime) AS INTEGER) AS day
FROM trips
""",
    "landed_text": "SELECT concat_ws('|', event_id, event_type, user_id) AS value FROM events",
    "stored_fact_trip": _STAR + "SELECT * FROM fact",
    "stored_dim_time": _with(TRIPS, CLEAN, TIMES) + "SELECT * FROM dim_time",
    **{f"stored_{name}": _STAR + sql for name, sql in _STORED.items() if name.startswith("agg_")},
    "loaded_dim_time": _with(TRIPS, CLEAN, TIMES) + "SELECT * FROM dim_time",
    **{f"loaded_{n}": _STAR + _STORED[n] for n in ("agg_daily_trips", "agg_popular_routes", "agg_revenue_breakdown")},
    "fact_trip_dense_key": _STAR + DENSE,
}
