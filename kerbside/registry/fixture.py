"""Trips and zones derived from the given tables, so that each rule of the pipeline is hit.

One event gives one trip, every twentieth event a second one with the same key but other measures. Days are spread over
370 days around the default period. The divisors below decide which event breaks which rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.zones import zone_lookup

# Seconds from pickup to dropoff for every n-th event; the first divisor that fits wins.
DROPOFF_AFTER_SEC = ((97, -300), (89, -30), (83, -60), (79, 7200), (73, 60), (71, 59), (223, None))
# Distance for every n-th event; the first divisor that fits wins.
DISTANCE_MILES = ((53, 0), (59, -1), (61, 30), (227, None))
# Boroughs that the cleaner excludes.
PLACEHOLDER_ZONES = ((22, "EWR"), (23, "Unknown"), (24, "N/A"))

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE"


def _first_fit(divisors: tuple[tuple[int, int | None], ...], otherwise: str) -> str:
    cases = " ".join(f"WHEN event_id % {n} = 0 THEN {'NULL' if v is None else v}" for n, v in divisors)
    return f"CASE {cases} ELSE {otherwise} END"


def _trip(passengers: str, miles: str) -> str:
    after_sec = _first_fit(DROPOFF_AFTER_SEC, "CAST(floor(value * 60) AS INT)")
    return f"""struct(
        CASE WHEN event_id % 211 <> 0 THEN pickup END AS tpep_pickup_datetime,
        timestampadd(SECOND, {after_sec}, pickup) AS tpep_dropoff_datetime,
        CAST({passengers} AS BIGINT) AS passenger_count,
        CAST({miles} AS DOUBLE) AS trip_distance,
        CAST((user_id + event_id * 5) % 27 AS INT) AS PULocationID,
        CAST((user_id * 7 + event_id) % 27 AS INT) AS DOLocationID)"""


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan: an event becomes an array of one or two trips. The array is also where filters stop:
    pushed below it they would repeat the whole derivation in each condition."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    first = _trip("IF(event_id % 11 = 0, NULL, event_id % 7)", _first_fit(DISTANCE_MILES, "value / 10"))
    second = _trip("event_id % 5", "value / 10 + 0.5D")
    return events.selectExpr(
        "*", "timestampadd(DAY, CAST(364 + event_id % 370 AS INT), ts) AS pickup"
    ).selectExpr(f"inline(IF(event_id % 20 = 0, array({first}, {second}), array({first})))")


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.schema("n_nationkey INT, n_regionkey INT").parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.schema("r_regionkey INT, r_name STRING").parquet(f"{sf_dir}/region.parquet")
    placeholders = " ".join(f"WHEN n_nationkey = {key} THEN '{name}'" for key, name in PLACEHOLDER_ZONES)
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey AS LocationID", f"CASE {placeholders} ELSE r_name END AS Borough"
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_lookup(raw_zones(spark, sf_dir))
