"""The zone lookup: a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.zones import zone_lookup


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """(zone_LocationID, Borough). Columns are found by header name; ``N/A`` stays a string, it is not null.

    Without type inference Spark reads the file once, and every column starts as a string.
    """
    lines = spark.read.option("header", True).csv(path)
    return zone_lookup(lines.select(F.col("LocationID").cast("int"), F.col("Borough")))
