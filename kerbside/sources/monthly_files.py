"""Raw trips: one Parquet file (or directory of part files) per month, whose types may drift from month to month."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from kerbside.schemas import BRONZE_TRIPS
from kerbside.settings import MONTH_FILE, Period
from kerbside.sources.lake import schema_if_present

# Footers that are asked for at the same time: a small job each.
FOOTERS_AT_ONCE = 16


def found_months(
    spark: SparkSession, raw_dir: str, period: Period, pattern: str = MONTH_FILE
) -> dict[str, T.StructType]:
    """Schema of every expected month that is there, each from one footer that a task reads; several months at a time.

    Only "no such path" means a missing month. A file that cannot be read raises: silently skipping it would
    lose a month.
    """

    def schema_of(month: str) -> T.StructType | None:
        return schema_if_present(spark, f"{raw_dir}/{pattern.format(month=month)}")

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        schemas = dict(zip(period.months, pool.map(inheritable_thread_target(spark)(schema_of), period.months)))
    return {month: schema for month, schema in schemas.items() if schema is not None}


def conform(trips: DataFrame, declared: T.StructType = BRONZE_TRIPS) -> DataFrame:
    """Cast the declared columns, wherever the file has them; all other columns pass through."""
    by_name = {c.lower(): c for c in trips.columns}
    missing = [f.name for f in declared if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"trip file lacks the columns {missing}")
    floating = {c.lower() for c, kind in trips.dtypes if kind in ("float", "double")}

    def cast(f: T.StructField) -> Column:
        found = F.col(by_name[f.name.lower()])
        if f.name.lower() in floating and isinstance(f.dataType, T.IntegralType):
            found = F.when(~F.isnan(found), found)  # NaN stands for a missing number; any other overflow is an error
        return found.cast(f.dataType).alias(f.name)

    core = [cast(f) for f in declared]
    taken = {f.name.lower() for f in declared}
    return trips.select(*core, *[F.col(c) for c in trips.columns if c.lower() not in taken])


def read_monthly_files(
    spark: SparkSession, raw_dir: str, period: Period = Period(), pattern: str = MONTH_FILE
) -> DataFrame:
    """All months of the period as one table, with ``source_month`` (date) naming the file of each row."""
    found = found_months(spark, raw_dir, period, pattern)
    if not found:
        raise FileNotFoundError(f"no month of {period.start}..{period.end} under {raw_dir}")
    return scan_months(spark, raw_dir, found, pattern)


def scan_months(
    spark: SparkSession, raw_dir: str, found: dict[str, T.StructType], pattern: str = MONTH_FILE
) -> DataFrame:
    """The months that ``found_months`` has found, as one table with ``source_month``.

    Files that disagree on a type cannot be read in one scan, so each month is scanned with its own schema and cast to
    the declared one before the union. The month is a literal of its scan: one scan of many months would have to take it from
    the path of each row's file, which costs several times the scan itself, whether it is cut out or looked up.
    """
    months = [
        conform(spark.read.schema(schema).parquet(f"{raw_dir}/{pattern.format(month=month)}")).withColumn(
            "source_month", F.lit(date.fromisoformat(f"{month}-01"))
        )
        for month, schema in found.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), months)


def pickup_month_counts(bronze: DataFrame) -> DataFrame:
    """(month, row_count) per month of pickup, for trips that do not come in monthly files."""
    month = F.date_format(F.col("tpep_pickup_datetime").cast("date"), "yyyy-MM")
    return bronze.groupBy(month.alias("month")).agg(F.count("*").alias("row_count")).filter(F.col("month").isNotNull())


def expected_months(spark: SparkSession, period: Period = Period()) -> DataFrame:
    """(month) for every month of the period."""
    nth = F.add_months(F.lit(period.start), F.col("id").cast("int"))
    return spark.range(period.month_count).select(F.date_format(nth, "yyyy-MM").alias("month"))
