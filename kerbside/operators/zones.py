"""Zone lookup: from location ids to boroughs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zone_lookup(zones: DataFrame) -> DataFrame:
    """The two columns that the joins need, under names that do not clash with trip columns."""
    return zones.select(F.col("LocationID").alias("zone_LocationID"), F.col("Borough"))


def with_boroughs(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add ``Borough`` (pickup) and ``DO_Borough`` (dropoff); an unmatched place gives null, the trip stays.

    No broadcast hint: Spark broadcasts the lookup while its size is below
    ``spark.sql.autoBroadcastJoinThreshold``. Beyond it, it plans a sort-merge join, whose
    hot places adaptive execution splits.
    """
    pickup = lookup.select(F.col("zone_LocationID").alias("PU_zone_id"), F.col("Borough"))
    dropoff = lookup.select(F.col("zone_LocationID").alias("DO_zone_id"), F.col("Borough").alias("DO_Borough"))
    return (
        trips.join(pickup, F.col("pickup_location_id") == F.col("PU_zone_id"), "left")
        .join(dropoff, F.col("dropoff_location_id") == F.col("DO_zone_id"), "left")
        .drop("PU_zone_id", "DO_zone_id")
    )


def zone_id_uniqueness(lookup: DataFrame) -> DataFrame:
    """One row: a repeated id would multiply trips in the joins, so it must not occur."""
    per_id = lookup.groupBy("zone_LocationID").agg(F.count("*").alias("copies"))
    return per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("zone_rows"),
        F.count("*").alias("distinct_ids"),
        F.count_if(F.col("copies") > 1).alias("repeated_ids"),
        (F.count_if(F.col("copies") > 1) == 0).alias("is_unique"),
    )
