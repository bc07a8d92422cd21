"""Declared schemas. Files are cast to these, never the other way round."""

from __future__ import annotations

from pyspark.sql import types as T

# Times are wall-clock times without a zone: durations must not depend on the session's zone.
BRONZE_TRIPS = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
    ]
)

SILVER_TRIPS = T.StructType(
    [
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_location_id", T.IntegerType()),
        T.StructField("dropoff_location_id", T.IntegerType()),
        T.StructField("duration_sec", T.LongType()),
    ]
)

ZONES = T.StructType(
    [
        T.StructField("zone_LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
    ]
)

GOLD = {
    "hourly_demand": T.StructType(
        [T.StructField("hour", T.IntegerType()), T.StructField("ride_count", T.LongType())]
    ),
    "demand_by_borough": T.StructType(
        [T.StructField("Borough", T.StringType()), T.StructField("ride_count", T.LongType())]
    ),
    "popular_routes": T.StructType(
        [
            T.StructField("Borough", T.StringType()),
            T.StructField("DO_Borough", T.StringType()),
            T.StructField("ride_count", T.LongType()),
        ]
    ),
    "avg_duration": T.StructType(
        [T.StructField("month", T.IntegerType()), T.StructField("avg_duration_min", T.DoubleType())]
    ),
    "avg_distance": T.StructType(
        [T.StructField("month", T.IntegerType()), T.StructField("avg_distance", T.DoubleType())]
    ),
    "avg_passengers": T.StructType(
        [T.StructField("month", T.IntegerType()), T.StructField("avg_passenger_count", T.DoubleType())]
    ),
}


def gold_schemas(by_year: bool) -> dict[str, T.StructType]:
    """The six tables; where silver holds several years, each monthly one carries the year before the month."""
    year = [T.StructField("year", T.IntegerType())] if by_year else []
    return {name: T.StructType([*(year if "month" in schema.names else []), *schema]) for name, schema in GOLD.items()}
