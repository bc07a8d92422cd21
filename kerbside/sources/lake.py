"""The layers of the lake: Parquet directories on any Hadoop file system.

Writing twice gives the same table. A full build replaces the directory, a build of some months replaces the
directories of these months: nothing is ever appended to the data of an earlier run.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from kerbside.functions import month_start
from kerbside.schemas import BRONZE_TRIPS
from kerbside.settings import Period
from kerbside.sources.measures import (
    MonthMeasures,
    by_month,
    measured,
    measured_columns,
    no_rows,
    store_measures,
    stored_measures,
)

# Stored with every trip: Parquet keeps bounds of dates that scans skip by, of zone-free times it does not.
DAY = "pickup_day"
# Months that a partial build writes at the same time: a job each, so that one month's last tasks leave no executor idle.
MONTHS_AT_ONCE = 8


def _counted(table: DataFrame) -> tuple[DataFrame, Observation]:
    """The row count falls out of the write itself: no cache, no second pass."""
    seen = Observation()
    return table.observe(seen, F.count("*").alias("rows")), seen


def _store(table: DataFrame, path: str, *partitioned_by: str) -> int:
    counted, seen = _counted(table)
    writer = counted.write.mode("overwrite")
    (writer.partitionBy(*partitioned_by) if partitioned_by else writer).parquet(path)
    return seen.get["rows"]


def _store_measured(table: DataFrame, path: str, month: str, columns: list[str], *partitioned_by: str) -> int:
    """Store a layer, and beside it what the write has counted; returns the rows written."""
    spark = table.sparkSession
    store_measures(spark, path, {})
    seen = Observation()
    counted = table.observe(seen, *measured_columns(F.col(month), columns))
    counted.write.mode("overwrite").partitionBy(*partitioned_by).parquet(path)
    store_measures(spark, path, by_month(seen.get, columns))
    return seen.get["rows"]


def _replace_measured(
    months: dict[date, DataFrame], path: str, month: str, columns: dict[date, list[str]], *partitioned_by: str
) -> int:
    """Store some months of a layer, ``MONTHS_AT_ONCE`` at a time, and once all are there what their writes have counted.

    Each month replaces its own directory. Counts of these months are taken away first: after a failure the months that were
    written are scanned for their counts, and all can be replaced again. Returns the rows written.
    """
    if not months:
        return 0
    spark = next(iter(months.values())).sparkSession
    others = {m: seen for m, seen in stored_measures(spark, path).items() if m not in months}
    store_measures(spark, path, others)

    def replaced(only: date) -> tuple[int, dict[date, MonthMeasures]]:
        seen = Observation()
        counted = months[only].observe(seen, *measured_columns(F.lit(only), columns[only])).drop(month)
        writer = counted.write.mode("overwrite")
        (writer.partitionBy(*partitioned_by) if partitioned_by else writer).parquet(_month_dir(path, month, only))
        return seen.get["rows"], {only: no_rows(columns[only]), **by_month(seen.get, columns[only])}

    with ThreadPoolExecutor(MONTHS_AT_ONCE) as pool:
        written = list(pool.map(inheritable_thread_target(spark)(replaced), months))
    store_measures(spark, path, reduce(lambda a, b: {**a, **b}, [found for _, found in written], others))
    return sum(rows for rows, _ in written)


def layer_measures(spark: SparkSession, path: str, column: str) -> dict[date, MonthMeasures]:
    """Counts of every month of a layer (``column`` names its month) as its writes have stored them.

    Nothing of the layer is read, but for months whose write stored no counts (it ended half-way): these are scanned.
    """
    stored = stored_measures(spark, path)
    found = {}
    for month in _stored_months(spark, path, column):
        if month not in stored:
            folder = _month_dir(path, column, month)
            schema = _schema_of_files(spark, folder)
            columns = [c for c in schema.names if c not in ("stray", DAY)]
            stored[month] = measured(spark.read.schema(schema).parquet(folder), month, columns) if columns else no_rows([])
        found[month] = stored[month]
    return found


def _month_dir(path: str, column: str, month: date) -> str:
    return f"{path}/{column}={month.isoformat()}"


def _stored_months(spark: SparkSession, path: str, column: str) -> list[date]:
    """Months that a layer has directories for: one listing, no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(date.fromisoformat(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}="))


# Bronze: each month has the columns and types of its file -----------------------------------------------------------


def _marked(trips: DataFrame) -> DataFrame:
    """With ``stray``, 1 for a pickup (or a missing one) outside the month of the file, else 0, and the day of pickup.

    Sorted by day within each task, so that pages hold few days and a read of some days skips the others.
    """
    pickup, month = F.col("tpep_pickup_datetime"), F.col("source_month")
    own = (pickup >= month.cast("timestamp_ntz")) & (pickup < F.add_months(month, 1).cast("timestamp_ntz"))
    marked = trips.withColumn("stray", F.when(own, 0).otherwise(1)).withColumn(DAY, pickup.cast("date"))
    return marked.sortWithinPartitions("source_month", "stray", DAY)


def _schemas_path(path: str) -> str:
    return f"{path}_schemas"


def _schema_of_files(spark: SparkSession, folder: str) -> T.StructType:
    """Columns of the files of a month; none where a write of no rows has left no file."""
    try:
        return schema_if_present(spark, folder) or T.StructType()
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return T.StructType()


def stored_schemas(spark: SparkSession, path: str) -> dict[date, T.StructType]:
    """Columns of each month of bronze as they were written, from the schema table beside the layer.

    A month that the table does not name (a write that ended between the data and the table) is read from one of its files.
    """
    try:
        named = spark.read.schema("source_month DATE, columns STRING").json(_schemas_path(path)).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        named = []
    known = {row["source_month"]: T.StructType.fromJson(json.loads(row["columns"])) for row in named}
    found = {}
    for month in _stored_months(spark, path, "source_month"):
        schema = known.get(month) or _schema_of_files(spark, _month_dir(path, "source_month", month))
        found[month] = T.StructType([f for f in schema if f.name != "stray"])
    return found


def _store_schemas(spark: SparkSession, path: str, schemas: dict[date, T.StructType]) -> None:
    rows = [(month, schema.json()) for month, schema in sorted(schemas.items())]
    table = spark.createDataFrame(rows, "source_month DATE, columns STRING")
    table.coalesce(1).write.mode("overwrite").json(_schemas_path(path))


def _columns_of(marked: DataFrame) -> T.StructType:
    return T.StructType([f for f in marked.schema if f.name not in ("stray", "source_month")])


_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def _wide_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: the wider number (a whole one beside a float is a double), else text."""
    if a == b:
        return a
    if a in _WIDER and b in _WIDER:
        wide = max(a, b, key=_WIDER.index)
        return T.DoubleType() if isinstance(wide, T.FloatType) else wide
    kinds = {type(a), type(b)}
    if kinds <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def widened(schemas: list[T.StructType]) -> T.StructType:
    """All columns of all schemas, by name without regard to case, in the order of their first appearance."""
    fields: dict[str, T.StructField] = {}
    for field in [f for schema in schemas for f in schema]:
        seen = fields.setdefault(field.name.lower(), field)
        fields[field.name.lower()] = T.StructField(seen.name, _wide_type(seen.dataType, field.dataType))
    return T.StructType(list(fields.values()))


def write_bronze(trips: DataFrame, path: str) -> int:
    """Store raw trips by the month of their file, replacing all of bronze; returns the rows written.

    The file's month, not the pickup's: replacing a file must replace exactly its own rows. But every file holds a few
    stray pickups of other months, even years, which would make it useless to skip data by pickup time. So strays
    go to a partition of their own, and a build of one month reads that month and the strays whose days fit.
    No shuffle: each task writes the splits it reads.
    """
    marked = _marked(trips)
    written = _store_measured(marked, path, "source_month", _columns_of(trips).names, "source_month", "stray")
    spark = trips.sparkSession
    _store_schemas(spark, path, dict.fromkeys(_stored_months(spark, path, "source_month"), _columns_of(marked)))
    return written


def replace_bronze_months(trips: dict[date, DataFrame], path: str) -> int:
    """Store the trips of the files of some months, replacing what bronze had from these files and nothing else.

    Each month keeps its own columns and types: those of other months are not touched, nor are their files opened.
    """
    if not trips:
        return 0
    marked = {month: _marked(of) for month, of in trips.items()}
    names = {month: _columns_of(of).names for month, of in trips.items()}
    written = _replace_measured(marked, path, "source_month", names, "stray")
    spark = next(iter(trips.values())).sparkSession
    _store_schemas(spark, path, {**stored_schemas(spark, path), **{month: _columns_of(of) for month, of in marked.items()}})
    return written


def replace_bronze_month(trips: DataFrame, path: str, month: date) -> int:
    """``replace_bronze_months`` for one file."""
    return replace_bronze_months({month: trips}, path)


def read_bronze(spark: SparkSession, path: str, picked_up_in: Period | None = None) -> DataFrame:
    """Bronze trips without the columns that the layer adds, in the widest types that months have.

    Months with equal columns are one scan, each by its stored schema; no footer is opened to plan it. With a period only the
    trips picked up in it are read: its months, and the pages of strays that hold its days.
    """
    months: dict[str, list[date]] = {}
    schemas = stored_schemas(spark, path)
    for month, schema in schemas.items():
        months.setdefault(schema.json(), []).append(month)
    if not months:
        return spark.createDataFrame([], BRONZE_TRIPS)
    wide = widened(list(schemas.values()))
    scans = []
    for columns, of in months.items():
        schema = T.StructType.fromJson(json.loads(columns)).add("source_month", T.DateType()).add("stray", T.IntegerType())
        folders = [path] if len(months) == 1 else [_month_dir(path, "source_month", month) for month in of]
        trips = spark.read.schema(schema).option("basePath", path).parquet(*folders)
        if picked_up_in is not None:
            start, end = F.lit(picked_up_in.start), F.lit(picked_up_in.end)
            own = (F.col("source_month") >= start) & (F.col("source_month") < end)
            trips = trips.filter((F.col("stray") == 1) | own).filter((F.col(DAY) >= start) & (F.col(DAY) < end))
        here = {f.name.lower(): f.name for f in schema}
        scans.append(trips.select(*[F.col(here[f.name.lower()]).cast(f.dataType).alias(f.name) for f in wide if f.name.lower() in here]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans).drop(DAY)


def aligned_with_bronze(trips: DataFrame, path: str) -> DataFrame:
    """Columns that stored bronze has too, spelled as it has them."""
    stored = {f.name.lower(): f.name for f in widened(list(stored_schemas(trips.sparkSession, path).values()))}
    return trips.select(*[F.col(c).alias(stored.get(c.lower(), c)) for c in trips.columns])


# Silver ---------------------------------------------------------------------------------------------------------


def write_silver(trips: DataFrame, path: str) -> int:
    """Store clean trips by pickup month, replacing all of silver; returns the rows written.

    Ranges of pickup times become files; adaptive execution merges small neighbours up to the advisory size, and a large month
    is several ranges. Every file is sorted by pickup and has the day as a column, so a read of some days opens few files and
    skips the pages of the other days.
    """
    pickup = F.col("pickup_datetime")
    dated = trips.withColumn(DAY, pickup.cast("date")).withColumn("pickup_month", month_start(pickup))
    ordered = dated.repartitionByRange("pickup_datetime").sortWithinPartitions("pickup_month", "pickup_datetime")
    return _store_measured(ordered, path, "pickup_month", trips.columns, "pickup_month")


def write_marked(trips: DataFrame, path: str) -> int:
    """Store trips with ``reject_reasons``, kept and rejected ones as partitions (``rejected``) of one write without a shuffle."""
    rejected = F.when(F.col("reject_reasons") == 0, 0).otherwise(1)
    return _store(trips.withColumn("rejected", rejected).sortWithinPartitions("rejected"), path, "rejected")


def replace_silver_months(trips: dict[date, DataFrame], path: str) -> int:
    """Store the clean trips of some months, replacing these months and nothing else, also when none are left."""

    def ordered(month: DataFrame) -> DataFrame:
        dated = month.withColumn(DAY, F.col("pickup_datetime").cast("date"))
        return dated.repartitionByRange("pickup_datetime").sortWithinPartitions("pickup_datetime")

    names = {month: of.columns for month, of in trips.items()}
    return _replace_measured({month: ordered(of) for month, of in trips.items()}, path, "pickup_month", names)


def replace_silver_month(trips: DataFrame, path: str, month: date) -> int:
    """``replace_silver_months`` for one month."""
    return replace_silver_months({month: trips}, path)


def read_silver(
    spark: SparkSession,
    path: str,
    start: date | None = None,
    end: date | None = None,
    columns: T.StructType | None = None,
) -> DataFrame:
    """Clean trips with ``pickup_month``; with days only those picked up from ``start`` to before ``end``.

    Months outside are not listed into the scan, and inside a month Parquet's bounds skip the pages of other days. With
    ``columns`` only these are there, and no footer is opened to plan the read.
    """
    added = [T.StructField(DAY, T.DateType()), T.StructField("pickup_month", T.DateType())]
    trips = read_table(spark, path, columns and T.StructType([*columns, *added]))
    if start is not None:
        trips = trips.filter((F.col("pickup_month") >= F.trunc(F.lit(start), "month")) & (F.col(DAY) >= F.lit(start)))
    if end is not None:
        trips = trips.filter((F.col("pickup_month") < F.lit(end)) & (F.col(DAY) < F.lit(end)))
    return trips.drop(DAY)


# Small tables ---------------------------------------------------------------------------------------------------


def write_by_month(table: DataFrame, path: str, column: str) -> int:
    """Store a small table by the month in ``column``, replacing it; returns the rows written."""
    return _store(table.repartition(column), path, column)


def replace_months(table: DataFrame, path: str, column: str, period: Period) -> int:
    """Store what a small table has for the months of the period, replacing these months and nothing else.

    The table is computed once, for all months, into a folder beside the layer; each month is then copied to its place, also
    when it has no rows.
    """
    beside = f"{path}_replaced"
    written = write_by_month(table, beside, column)
    stored = read_table(table.sparkSession, beside, table.schema)
    for month in period.each_month():
        own = stored.filter(F.col(column) == F.lit(month.start)).drop(column)
        _store(own, _month_dir(path, column, month.start))
    return written


def write_table(table: DataFrame, path: str) -> int:
    """Store a small unpartitioned table, replacing it; returns the rows written."""
    return _store(table, path)


def schema_if_present(spark: SparkSession, path: str) -> T.StructType | None:
    """Schema of a Parquet file or directory, or None when there is no such path. Any other error is raised."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A layer; with a schema no footer is read before the query starts."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
