"""The same results as SQL text for DuckDB, written from the rules and not from the Spark code.

Every statement starts from the given tables: ``trips`` and ``zones`` are derived in CTEs, the layers build on them.
"""

from __future__ import annotations

_TRIPS = """
e AS (
  SELECT event_id, ts, user_id, value, 0 AS dup FROM events
  UNION ALL
  SELECT event_id, ts, user_id, value, 1 AS dup FROM events WHERE event_id % 20 = 0
), t AS (
  SELECT event_id, user_id, value, dup, ts + to_days(CAST(364 + event_id % 370 AS INTEGER)) AS pu FROM e
), trips AS (
  SELECT
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE pu END AS tpep_pickup_datetime,
    CASE WHEN event_id % 97 = 0 THEN pu + to_seconds(-300)
         WHEN event_id % 89 = 0 THEN pu + to_seconds(-30)
         WHEN event_id % 83 = 0 THEN pu + to_seconds(-60)
         WHEN event_id % 79 = 0 THEN pu + to_seconds(7200)
         WHEN event_id % 73 = 0 THEN pu + to_seconds(60)
         WHEN event_id % 71 = 0 THEN pu + to_seconds(59)
         WHEN event_id % 223 = 0 THEN NULL
         ELSE pu + to_seconds(CAST(floor(value * 60) AS BIGINT)) END AS tpep_dropoff_datetime,
    CASE WHEN dup = 1 THEN CAST(event_id % 5 AS BIGINT)
         WHEN event_id % 11 = 0 THEN NULL
         ELSE CAST(event_id % 7 AS BIGINT) END AS passenger_count,
    CASE WHEN dup = 1 THEN value / 10 + 0.5
         WHEN event_id % 53 = 0 THEN CAST(0 AS DOUBLE)
         WHEN event_id % 59 = 0 THEN CAST(-1 AS DOUBLE)
         WHEN event_id % 61 = 0 THEN CAST(30 AS DOUBLE)
         WHEN event_id % 227 = 0 THEN NULL
         ELSE value / 10 END AS trip_distance,
    CAST((user_id + event_id * 5) % 27 AS INTEGER) AS PULocationID,
    CAST((user_id * 7 + event_id) % 27 AS INTEGER) AS DOLocationID
  FROM t
)"""

_ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS zone_LocationID,
         CASE WHEN n_nationkey = 22 THEN 'EWR'
              WHEN n_nationkey = 23 THEN 'Unknown'
              WHEN n_nationkey = 24 THEN 'N/A'
              ELSE r_name END AS Borough
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

# date_diff counts second boundaries, which is the difference of the two times cut to whole seconds.
_STEPS = """
renamed AS (
  SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime, passenger_count,
         trip_distance, PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id
  FROM trips
), in_range AS (
  SELECT * FROM renamed
  WHERE pickup_datetime >= TIMESTAMP '2025-01-01' AND pickup_datetime < TIMESTAMP '2026-01-01'
), repaired AS (
  SELECT * REPLACE (
    CASE WHEN date_diff('second', dropoff_datetime, pickup_datetime) BETWEEN 1 AND 59
         THEN pickup_datetime ELSE dropoff_datetime END AS dropoff_datetime)
  FROM in_range
), timed AS (
  SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) AS duration_sec FROM repaired
), filled AS (
  SELECT * REPLACE (COALESCE(passenger_count, 0) AS passenger_count) FROM timed
), valid AS (
  SELECT * FROM filled WHERE duration_sec >= 0 AND trip_distance >= 0
), usual AS (
  SELECT * FROM valid
  WHERE duration_sec >= 60 AND duration_sec < 7200 AND trip_distance > 0 AND trip_distance < 30
), silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id
      ORDER BY trip_distance NULLS FIRST, passenger_count NULLS FIRST) AS rn
    FROM usual)
  WHERE rn = 1
)"""

# The sum of distances without rounding but the last one: whole numbers of 2 ** -74 miles (kept trips are longer than 2 ** -21
# miles, so their doubles are multiples of that), the upper and the lower part made doubles for themselves.
_WHOLE = "sum(CAST(trip_distance * pow(2.0, 74) AS HUGEINT))"
_EXACT_SUM = (
    f"((CAST({_WHOLE} >> 44 AS DOUBLE) * pow(2.0, 44) + CAST({_WHOLE} & ((CAST(1 AS HUGEINT) << 44) - 1) AS DOUBLE)) / pow(2.0, 74))"
)

_GOLD = f"""
enriched AS (
  SELECT silver.*, p.Borough, d.Borough AS DO_Borough
  FROM silver
  LEFT JOIN zones p ON pickup_location_id = p.zone_LocationID
  LEFT JOIN zones d ON dropoff_location_id = d.zone_LocationID
), hourly_demand AS (
  SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS ride_count
  FROM enriched WHERE pickup_datetime IS NOT NULL GROUP BY 1
), demand_by_borough AS (
  SELECT Borough, count(*) AS ride_count FROM enriched
  WHERE Borough IS NOT NULL AND Borough NOT IN ('Unknown', 'N/A', 'EWR') GROUP BY 1
), popular_routes AS (
  SELECT Borough, DO_Borough, count(*) AS ride_count FROM enriched
  WHERE Borough IS NOT NULL AND DO_Borough IS NOT NULL
    AND Borough NOT IN ('Unknown', 'N/A', 'EWR') AND DO_Borough NOT IN ('Unknown', 'N/A', 'EWR')
  GROUP BY 1, 2
), avg_duration AS (
  SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, avg(duration_sec) / 60 AS avg_duration_min
  FROM enriched GROUP BY 1
), avg_distance AS (
  SELECT CAST(month(pickup_datetime) AS INTEGER) AS month,
         {_EXACT_SUM} / count(trip_distance) AS avg_distance
  FROM enriched GROUP BY 1
), avg_passengers AS (
  SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, avg(passenger_count) AS avg_passenger_count
  FROM enriched WHERE passenger_count > 0 GROUP BY 1
)"""

_TIMES = "epoch_us({p}pickup_datetime) AS {p}pickup_datetime_us, epoch_us({p}dropoff_datetime) AS {p}dropoff_datetime_us"
_BRONZE_COLUMNS = f"{_TIMES.format(p='tpep_')}, passenger_count, trip_distance, PULocationID, DOLocationID"
_STAGE_COLUMNS = f"{_TIMES.format(p='')}, passenger_count, trip_distance, pickup_location_id, dropoff_location_id"
_SILVER_COLUMNS = f"{_STAGE_COLUMNS}, duration_sec"
_GOLD_COLUMNS = {
    "hourly_demand": ("hour", "ride_count"),
    "demand_by_borough": ("Borough", "ride_count"),
    "popular_routes": ("Borough", "DO_Borough", "ride_count"),
    "avg_duration": ("month", "avg_duration_min"),
    "avg_distance": ("month", "avg_distance"),
    "avg_passengers": ("month", "avg_passenger_count"),
}
_GOLD_TYPES = {"hour": "int", "month": "int", "ride_count": "bigint", "Borough": "string", "DO_Borough": "string"}
_BRONZE_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
}
_SILVER_TYPES = {
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "pickup_location_id": "int",
    "dropoff_location_id": "int",
    "duration_sec": "bigint",
}


def _bronze(select: str) -> str:
    return f"WITH {_TRIPS}\n{select}"


def _steps(select: str) -> str:
    return f"WITH {_TRIPS}, {_STEPS}\n{select}"


def _gold(select: str) -> str:
    return f"WITH {_TRIPS}, {_ZONES}, {_STEPS}, {_GOLD}\n{select}"


def _null_profile() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count FROM {table}"
        for table, columns in _GOLD_COLUMNS.items()
        for column in columns
    )


def _schema_report() -> str:
    declared = {"trips": ("bronze", _BRONZE_TYPES), "silver": ("silver", _SILVER_TYPES)}
    for table, columns in _GOLD_COLUMNS.items():
        declared[table] = (table, {c: _GOLD_TYPES.get(c, "double") for c in columns})
    return "\nUNION ALL\n".join(
        f"SELECT '{shown}' AS table_name, '{column}' AS column_name, '{kind}' AS expected_type, "
        f"'{kind}' AS actual_type, TRUE AS type_ok, count(*) - count({column}) AS null_count FROM {table}"
        for table, (shown, columns) in declared.items()
        for column, kind in columns.items()
    )


def _funnel() -> str:
    counts = [
        ("bronze", "SELECT count(*) FROM trips"),
        ("in_period", "SELECT count(*) FROM in_range"),
        (
            "skew_repaired",
            "SELECT count(*) FROM in_range WHERE date_diff('second', dropoff_datetime, pickup_datetime) BETWEEN 1 AND 59",
        ),
        ("duration_valid", "SELECT count(*) FROM filled WHERE duration_sec >= 0"),
        ("distance_valid", "SELECT count(*) FROM valid"),
        ("duration_usual", "SELECT count(*) FROM valid WHERE duration_sec >= 60 AND duration_sec < 7200"),
        ("distance_usual", "SELECT count(*) FROM usual"),
        ("silver", "SELECT count(*) FROM silver"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT CAST({no} AS INTEGER) AS step_no, '{step}' AS step, ({count}) AS row_count"
        for no, (step, count) in enumerate(counts, start=1)
    )


_REASONS = {
    "outside_period": "pickup_datetime >= TIMESTAMP '2025-01-01' AND pickup_datetime < TIMESTAMP '2026-01-01'",
    "duration_invalid": "duration_sec >= 0",
    "distance_invalid": "trip_distance >= 0",
    "duration_unusual": "duration_sec >= 60 AND duration_sec < 7200",
    "distance_unusual": "trip_distance > 0 AND trip_distance < 30",
}
# Every trip of the first step, with one truth value per filter (null counts as false).
_JUDGED = (
    """, seen AS (
  SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) AS duration_sec FROM (
    SELECT * REPLACE (
      CASE WHEN date_diff('second', dropoff_datetime, pickup_datetime) BETWEEN 1 AND 59
           THEN pickup_datetime ELSE dropoff_datetime END AS dropoff_datetime,
      COALESCE(passenger_count, 0) AS passenger_count)
    FROM renamed)
), judged AS (
  SELECT *, """
    + ", ".join(f"COALESCE({rule}, FALSE) AS ok_{reason}" for reason, rule in _REASONS.items())
    + " FROM seen)\n"
)


def _reject_reasons() -> str:
    names = list(_REASONS)
    return _JUDGED + "\nUNION ALL\n".join(
        f"SELECT CAST({no} AS INTEGER) AS reason_no, '{reason}' AS reason, count(*) FILTER (WHERE NOT ok_{reason}) AS row_count, "
        f"count(*) FILTER (WHERE {' AND '.join([*(f'ok_{n}' for n in names[:no - 1]), f'NOT ok_{reason}'])}) AS dropped_here FROM judged"
        for no, reason in enumerate(names, start=1)
    )


def _rejected_trips() -> str:
    marks = " + ".join(f"CASE WHEN ok_{reason} THEN 0 ELSE {1 << nth} END" for nth, reason in enumerate(_REASONS))
    return f"{_JUDGED}SELECT * FROM (SELECT {_SILVER_COLUMNS}, CAST({marks} AS INTEGER) AS reject_reasons FROM judged) WHERE reject_reasons > 0"


def _gate() -> str:
    rules = {
        "negative_duration": "duration_sec < 0",
        "invalid_distance": "trip_distance <= 0",
        "null_duration": "duration_sec IS NULL",
        "null_distance": "trip_distance IS NULL",
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {rule}) AS failures, "
        f"count(*) FILTER (WHERE {rule}) = 0 AS passed FROM silver"
        for name, rule in rules.items()
    )


def _two_decimals(column: str) -> str:
    return f"CAST(format('{{:.2f}}', {column}) AS DOUBLE)"


ORACLE: dict[str, str] = {
    "bronze_trips": _bronze(f"SELECT {_BRONZE_COLUMNS} FROM trips"),
    "bronze_month_coverage": _bronze(
        """, found AS (
  SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, count(*) AS row_count FROM trips GROUP BY 1
), expected AS (
  SELECT strftime(m, '%Y-%m') AS month
  FROM generate_series(TIMESTAMP '2025-01-01', TIMESTAMP '2025-12-01', INTERVAL 1 MONTH) AS s(m)
)
SELECT month, COALESCE(row_count, 0) AS row_count, row_count IS NULL AS missing
FROM expected LEFT JOIN found USING (month) ORDER BY month"""
    ),
    "bronze_profile": _bronze(
        "SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, "
        + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in _BRONZE_TYPES)
        + " FROM trips"
    ),
    "bronze_sample": _bronze(
        f"SELECT {_BRONZE_COLUMNS} FROM (SELECT * FROM trips ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in _BRONZE_TYPES)
        + " LIMIT 5)"
    ),
    "zones_lookup": f"WITH {_ZONES}\nSELECT zone_LocationID, Borough FROM zones",
    "silver_renamed": _steps(f"SELECT {_STAGE_COLUMNS} FROM renamed"),
    "silver_in_range": _steps(f"SELECT {_STAGE_COLUMNS} FROM in_range"),
    "silver_skew_repair": _steps(f"SELECT {_STAGE_COLUMNS} FROM repaired"),
    "silver_duration": _steps(f"SELECT {_SILVER_COLUMNS} FROM timed"),
    "silver_null_fill": _steps(f"SELECT {_SILVER_COLUMNS} FROM filled"),
    "silver_valid": _steps(f"SELECT {_SILVER_COLUMNS} FROM valid"),
    "silver_outliers": _steps(f"SELECT {_SILVER_COLUMNS} FROM usual"),
    "silver_dedup": _steps(
        f"""SELECT {_STAGE_COLUMNS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id
    ORDER BY trip_distance NULLS FIRST, passenger_count NULLS FIRST) AS rn
  FROM renamed) WHERE rn = 1"""
    ),
    "silver_clean_trips": _steps(f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "silver_funnel": _steps(_funnel()),
    "silver_reject_reasons": _steps(_reject_reasons()),
    "silver_rejected_trips": _steps(_rejected_trips()),
    "trips_with_boroughs": _gold(f"SELECT {_SILVER_COLUMNS}, Borough, DO_Borough FROM enriched"),
    "gold_hourly_demand": _gold("SELECT hour, ride_count FROM hourly_demand ORDER BY hour"),
    "gold_demand_by_borough": _gold(
        "SELECT Borough, ride_count FROM demand_by_borough ORDER BY ride_count DESC, Borough"
    ),
    "gold_popular_routes": _gold(
        "SELECT Borough, DO_Borough, ride_count FROM popular_routes ORDER BY ride_count DESC, Borough, DO_Borough"
    ),
    "gold_avg_duration": _gold("SELECT month, avg_duration_min FROM avg_duration ORDER BY month"),
    "gold_avg_distance": _gold("SELECT month, avg_distance FROM avg_distance ORDER BY month"),
    "gold_avg_passengers": _gold("SELECT month, avg_passenger_count FROM avg_passengers ORDER BY month"),
    "gold_merged_month_states": _gold(
        """SELECT month, ride_count, avg_duration_min, avg_distance, avg_passenger_count, passenger_rides
FROM avg_duration JOIN avg_distance USING (month) LEFT JOIN avg_passengers USING (month) JOIN (
  SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS ride_count,
         count(*) FILTER (WHERE passenger_count > 0) AS passenger_rides FROM silver GROUP BY 1) USING (month) ORDER BY month"""
    ),
    "gold_base_rollup": _steps(
        f""", keyed AS (
  SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, CAST(month(pickup_datetime) AS INTEGER) AS month, * FROM silver
)
SELECT CASE WHEN grouping(hour) = 0 THEN 'hour' WHEN grouping(month) = 0 THEN 'month' ELSE 'route' END AS grain,
       hour, month, pickup_location_id, dropoff_location_id,
       count(*) AS ride_count,
       CAST(sum(duration_sec) AS BIGINT) AS duration_sec_sum,
       count(duration_sec) AS duration_rides,
       CASE WHEN grouping(month) = 0 THEN {_EXACT_SUM} END AS distance_sum,
       CASE WHEN grouping(month) = 0 THEN count(trip_distance) END AS distance_rides,
       count(*) FILTER (WHERE passenger_count > 0) AS passenger_rides,
       CAST(sum(passenger_count) FILTER (WHERE passenger_count > 0) AS BIGINT) AS passenger_sum
FROM keyed
GROUP BY GROUPING SETS ((hour), (month), (pickup_location_id, dropoff_location_id))"""
    ),
    "serve_hourly_demand": _gold("SELECT hour, ride_count FROM hourly_demand ORDER BY hour"),
    "serve_demand_by_borough": _gold(
        "SELECT Borough AS borough, ride_count FROM demand_by_borough ORDER BY ride_count DESC, Borough"
    ),
    "serve_popular_routes": _gold(
        'SELECT Borough AS "from", DO_Borough AS "to", ride_count FROM popular_routes '
        "ORDER BY ride_count DESC, Borough, DO_Borough LIMIT 20"
    ),
    "serve_avg_duration": _gold(
        f"SELECT month, {_two_decimals('avg_duration_min')} AS avg_duration_min FROM avg_duration ORDER BY month"
    ),
    "serve_avg_distance": _gold(
        f"SELECT month, {_two_decimals('avg_distance')} AS avg_distance_miles FROM avg_distance ORDER BY month"
    ),
    "serve_avg_passengers": _gold(
        f"SELECT month, {_two_decimals('avg_passenger_count')} AS avg_passenger_count FROM avg_passengers ORDER BY month"
    ),
    "dash_popular_routes": _gold(
        'SELECT Borough AS "From", DO_Borough AS "To", ride_count AS "Ride Count" FROM popular_routes '
        "ORDER BY ride_count DESC, Borough, DO_Borough LIMIT 20"
    ),
    "dash_monthly_averages": _gold(
        "SELECT month, avg_duration_min, avg_distance, avg_passenger_count FROM avg_duration "
        "FULL JOIN avg_distance USING (month) FULL JOIN avg_passengers USING (month) ORDER BY month"
    ),
    "dq_silver_metrics": _steps(
        """SELECT min(duration_sec) AS min_duration, max(duration_sec) AS max_duration,
  count(*) FILTER (WHERE duration_sec < 0) AS negative_duration,
  count(*) FILTER (WHERE trip_distance <= 0) AS invalid_distance,
  count(*) FILTER (WHERE passenger_count < 0) AS negative_passengers,
  count(*) FILTER (WHERE duration_sec > 7200) AS very_long_duration,
  count(*) FILTER (WHERE trip_distance > 30) AS very_long_distance,
  count(*) FILTER (WHERE duration_sec IS NULL) AS null_duration,
  count(*) FILTER (WHERE trip_distance IS NULL) AS null_distance,
  count(*) FILTER (WHERE passenger_count IS NULL) AS null_passengers,
  count(*) FILTER (WHERE passenger_count = 0) AS zero_passengers
FROM silver"""
    ),
    "dq_silver_gate": _steps(_gate()),
    "dq_silver_sample": _steps(
        f"""SELECT {_TIMES.format(p='')}, duration_sec, trip_distance, passenger_count
FROM (SELECT * FROM silver
      ORDER BY pickup_datetime, dropoff_datetime, pickup_location_id NULLS FIRST, dropoff_location_id NULLS FIRST LIMIT 5)"""
    ),
    "dq_gold_null_profile": _gold(_null_profile()),
    "dq_gold_sample": _gold(
        "SELECT Borough, DO_Borough, ride_count FROM popular_routes ORDER BY Borough, DO_Borough, ride_count LIMIT 5"
    ),
    "dq_gold_hours_present": _gold(
        """SELECT CAST(h AS INTEGER) AS hour, h IN (SELECT hour FROM hourly_demand) AS present
FROM generate_series(0, 23) AS s(h) ORDER BY hour"""
    ),
    "dq_gold_nonpositive_routes": _gold(
        "SELECT Borough, DO_Borough, ride_count FROM popular_routes WHERE ride_count <= 0"
    ),
    "dq_gold_row_counts": _gold(
        "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _GOLD_COLUMNS)
    ),
    "dq_gold_totals": _gold(
        """, totals AS (
  SELECT (SELECT CAST(sum(ride_count) AS BIGINT) FROM hourly_demand) AS hourly_total,
         (SELECT CAST(sum(ride_count) AS BIGINT) FROM demand_by_borough) AS borough_total,
         (SELECT CAST(sum(ride_count) AS BIGINT) FROM popular_routes) AS routes_total
)
SELECT *, hourly_total >= borough_total AND borough_total >= routes_total AS totals_ordered FROM totals"""
    ),
    "dq_layer_reconciliation": _gold(
        """, n AS (
  SELECT (SELECT count(*) FROM trips) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
         (SELECT CAST(sum(ride_count) AS BIGINT) FROM hourly_demand) AS gold_rides
)
SELECT bronze_rows, silver_rows, bronze_rows - silver_rows AS rows_removed,
       CAST(bronze_rows - silver_rows AS DOUBLE) / CAST(bronze_rows AS DOUBLE) * 100 AS pct_removed,
       bronze_rows > silver_rows AS some_removed, gold_rides, gold_rides = silver_rows AS gold_matches_silver
FROM n"""
    ),
    "dq_schema_report": _gold(_schema_report()),
    "dq_zone_id_unique": f"""WITH {_ZONES}, per_id AS (
  SELECT zone_LocationID, count(*) AS copies FROM zones GROUP BY 1
)
SELECT CAST(sum(copies) AS BIGINT) AS zone_rows, count(*) AS distinct_ids,
       count(*) FILTER (WHERE copies > 1) AS repeated_ids, count(*) FILTER (WHERE copies > 1) = 0 AS is_unique
FROM per_id""",
}

# Files hold the trips of their month of pickup, the first one also those of no month. Counts that writes have stored must be
# those of the trips, and a stored table must be what its query gives.
ORACLE["lake_file_coverage"] = _bronze(
    """, files AS (
  SELECT CASE WHEN tpep_pickup_datetime >= TIMESTAMP '2025-01-01' AND tpep_pickup_datetime < TIMESTAMP '2026-01-01'
              THEN strftime(tpep_pickup_datetime, '%Y-%m') ELSE '2025-01' END AS month
  FROM trips
), found AS (
  SELECT month, count(*) AS row_count FROM files GROUP BY 1
), expected AS (
  SELECT strftime(m, '%Y-%m') AS month
  FROM generate_series(TIMESTAMP '2025-01-01', TIMESTAMP '2026-02-01', INTERVAL 1 MONTH) AS s(m)
)
SELECT month, COALESCE(row_count, 0) AS row_count, row_count IS NULL AS missing
FROM expected LEFT JOIN found USING (month) ORDER BY month"""
)
ORACLE["lake_bronze_profile"] = ORACLE["bronze_profile"]
ORACLE["lake_layer_reconciliation"] = ORACLE["dq_layer_reconciliation"]
ORACLE["lake_popular_routes"] = ORACLE["gold_popular_routes"]
