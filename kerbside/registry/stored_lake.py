"""Queries over a stored lake: monthly files made of the given tables, read as files, and the layers built from them.

Each query writes a lake of its own into the folder that ``spark.checkpoint.dir`` names, keeps the few rows of its report and
deletes the lake. Files of even months hold passengers as a double, those of odd months places as a bigint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.cleaning import clean_trips
from kerbside.plans import jobs
from kerbside.registry import fixture
from kerbside.settings import LakeLayout, Period
from kerbside.sources.lake import read_bronze, read_table, write_bronze, write_silver
from kerbside.sources.monthly_files import read_monthly_files

FILES = "file_month={month}"
# Two months more than there are files for.
EXPECTED = Period(date(2025, 1, 1), date(2026, 3, 1))


def _scratch(spark: SparkSession) -> str:
    """The shared folder of the cluster; where none is named, one in the warehouse, unless that is local to one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{warehouse}/kerbside_scratch"


def _put_files(spark: SparkSession, sf_dir: str, lake: LakeLayout) -> None:
    """Trips as files by month of pickup (what belongs to no month is in the first one), and the zone file."""
    months = Period().months
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    trips = fixture.bronze_trips(spark, sf_dir).withColumn("file_month", F.when(month.isin(months), month).otherwise(months[0]))
    even = F.substring("file_month", 6, 2).cast("int") % 2 == 0
    for own, column, kind in ((even, "passenger_count", "double"), (~even, "PULocationID", "bigint")):
        drifted = trips.filter(own).withColumn(column, F.col(column).cast(kind))
        drifted.write.mode("append").partitionBy("file_month").parquet(lake.raw)
    fixture.raw_zones(spark, sf_dir).write.option("header", True).csv(lake.zones)


def _build(spark: SparkSession, sf_dir: str, lake: LakeLayout, layers: int) -> None:
    _put_files(spark, sf_dir, lake)
    write_bronze(read_monthly_files(spark, lake.raw, pattern=FILES), lake.bronze)
    if layers > 1:
        write_silver(clean_trips(read_bronze(spark, lake.bronze)), lake.silver)
        jobs.build_gold(spark, lake)


def _from_lake(report: Callable[[SparkSession, LakeLayout], DataFrame], layers: int) -> Callable[[SparkSession, str], DataFrame]:
    """A report of a fresh lake. Its rows, which grow with months and boroughs only, outlive the lake."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = LakeLayout(f"{_scratch(spark)}/kerbside-lake-{uuid.uuid4().hex}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(lake.root)
        try:
            _build(spark, sf_dir, lake, layers)
            table = report(spark, lake)
            return spark.createDataFrame(table.collect(), table.schema)
        finally:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    return query


LAKE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lake_file_coverage": _from_lake(lambda spark, lake: jobs.check_bronze(spark, lake, EXPECTED)["months"], 1),
    "lake_bronze_profile": _from_lake(lambda spark, lake: jobs.check_bronze(spark, lake)["profile"], 1),
    "lake_layer_reconciliation": _from_lake(lambda spark, lake: jobs.check_layers(spark, lake)["layers"], 3),
    "lake_popular_routes": _from_lake(lambda spark, lake: read_table(spark, lake.gold("popular_routes")), 3),
}
