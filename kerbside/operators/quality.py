"""Quality checks. Each one returns a small DataFrame; only ``enforce`` looks at rows, and it raises.

Every check is one aggregate per table, with map-side combining. Layers of different tables are compared by a union of
one-row aggregates, never by a cross join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.settings import (
    CRITICAL_CHECKS,
    MAX_DISTANCE_MILES,
    MAX_DURATION_SEC,
    RECHECK_EXCLUDED_BOROUGHS,
    SAMPLE_ROWS,
)


class QualityError(ValueError):
    """A check that guards the pipeline failed."""


def _nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _lines(entries: list[dict[str, Column]]) -> Column:
    """Turn a one-row aggregate into one row per entry."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in entry.items()]) for entry in entries]))


# Bronze ---------------------------------------------------------------------------------------------------------


def table_profile(table: DataFrame) -> DataFrame:
    """One row: rows, columns, and nulls per column."""
    return table.agg(
        F.count("*").alias("row_count"),
        F.lit(len(table.columns)).cast("bigint").alias("column_count"),
        *[_nulls(c).alias(f"null_{c}") for c in table.columns],
    )


def sample(table: DataFrame, order: list[str] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows in a stated order (all columns when none is given), so the sample is the same in every run."""
    return table.orderBy(*(order or table.columns)).limit(rows)


# Silver ---------------------------------------------------------------------------------------------------------


def silver_metrics(trips: DataFrame) -> DataFrame:
    """Eleven measures in one pass. The outlier limits are looser than the cleaner's, so they read 0 on good silver."""
    seconds, miles, people = F.col("duration_sec"), F.col("trip_distance"), F.col("passenger_count")
    return trips.agg(
        F.min(seconds).alias("min_duration"),
        F.max(seconds).alias("max_duration"),
        F.count_if(seconds < 0).alias("negative_duration"),
        F.count_if(miles <= 0).alias("invalid_distance"),
        F.count_if(people < 0).alias("negative_passengers"),
        F.count_if(seconds > MAX_DURATION_SEC).alias("very_long_duration"),
        F.count_if(miles > MAX_DISTANCE_MILES).alias("very_long_distance"),
        _nulls("duration_sec").alias("null_duration"),
        _nulls("trip_distance").alias("null_distance"),
        _nulls("passenger_count").alias("null_passengers"),
        F.count_if(people == 0).alias("zero_passengers"),
    )


def silver_gate(metrics: DataFrame) -> DataFrame:
    """The critical rules of the metrics as rows (check_name, failures, passed)."""
    return metrics.select(
        _lines(
            [
                {"check_name": F.lit(c), "failures": F.col(c), "passed": F.col(c) == 0}
                for c in CRITICAL_CHECKS
            ]
        )
    )


def enforce(gate: DataFrame, metrics: DataFrame | None = None) -> None:
    """Raise if any rule of a gate failed, and say what was measured. A gate has a handful of rows, metrics have one."""
    failed = [f"{r.check_name} ({r.failures} rows)" for r in gate.filter(~F.col("passed")).collect()]
    if failed:
        measured = "".join(f"; measured: {r.asDict()}" for r in (metrics.collect() if metrics is not None else []))
        raise QualityError("validation failed: " + ", ".join(failed) + measured)


def silver_sample(trips: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """First trips by key, in the columns that a reader wants to see."""
    key = ["pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id"]
    shown = ["pickup_datetime", "dropoff_datetime", "duration_sec", "trip_distance", "passenger_count"]
    return sample(trips, key, rows).select(*shown)


# Gold -----------------------------------------------------------------------------------------------------------


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, row_count, null_count) over several tables."""
    parts = None
    for name, table in tables.items():
        counted = table.agg(F.count("*").alias("row_count"), *[_nulls(c).alias(f"null_{c}") for c in table.columns])
        part = counted.select(
            _lines(
                [
                    {
                        "table_name": F.lit(name),
                        "column_name": F.lit(c),
                        "row_count": F.col("row_count"),
                        "null_count": F.col(f"null_{c}"),
                    }
                    for c in table.columns
                ]
            )
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def recheck_boroughs(demand_by_borough: DataFrame) -> DataFrame:
    """The validator's own, shorter exclusion list; on good gold it removes nothing."""
    return demand_by_borough.filter(~F.col("Borough").isin(*RECHECK_EXCLUDED_BOROUGHS))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count); for a monthly table this is the number of months."""
    parts = None
    for name, table in tables.items():
        part = table.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def hours_present(hourly_demand: DataFrame) -> DataFrame:
    """(hour, present) for the 24 hours of a day."""
    spark = hourly_demand.sparkSession
    day = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    found = hourly_demand.select("hour").distinct().withColumn("found", F.lit(True))
    return day.join(found, "hour", "left").select("hour", F.col("found").isNotNull().alias("present")).orderBy("hour")


def nonpositive_routes(popular_routes: DataFrame) -> DataFrame:
    """Routes that no trip can have produced; expected to be empty."""
    return popular_routes.filter(F.col("ride_count") <= 0)


def _one_row(parts: dict[str, DataFrame]) -> DataFrame:
    """Put one number from each of several one-row frames side by side."""
    names = list(parts)
    stacked = None
    for name, part in parts.items():
        value = F.col(part.columns[0]).cast("bigint")
        row = part.select(*[(value if n == name else F.lit(None).cast("bigint")).alias(n) for n in names])
        stacked = row if stacked is None else stacked.unionByName(row)
    return stacked.agg(*[F.max(n).alias(n) for n in names])


def _total(table: DataFrame) -> DataFrame:
    return table.agg(F.coalesce(F.sum("ride_count"), F.lit(0)).alias("total"))


def _count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("total"))


def gold_totals(hourly: DataFrame, borough: DataFrame, routes: DataFrame) -> DataFrame:
    """Rides per table. Each step filters more, so hourly >= borough >= routes must hold."""
    totals = _one_row(
        {
            "hourly_total": _total(hourly),
            "borough_total": _total(recheck_boroughs(borough)),
            "routes_total": _total(routes),
        }
    )
    ordered = (F.col("hourly_total") >= F.col("borough_total")) & (F.col("borough_total") >= F.col("routes_total"))
    return totals.withColumn("totals_ordered", ordered)


# Across layers --------------------------------------------------------------------------------------------------


def layer_reconciliation(bronze: DataFrame, silver: DataFrame, hourly: DataFrame) -> DataFrame:
    """What cleaning removed, and whether gold still counts every silver row. One row."""
    return reconciled(_count(bronze), _count(silver), hourly)


def reconciled(bronze_rows: DataFrame, silver_rows: DataFrame, hourly: DataFrame) -> DataFrame:
    """The same from numbers of rows (frames of one number) that the layers' writes have counted."""
    totals = _one_row({"bronze_rows": bronze_rows, "silver_rows": silver_rows, "gold_rides": _total(hourly)})
    removed = F.col("bronze_rows") - F.col("silver_rows")
    return totals.select(
        "bronze_rows",
        "silver_rows",
        removed.alias("rows_removed"),
        (F.try_divide(removed.cast("double"), F.col("bronze_rows").cast("double")) * 100).alias("pct_removed"),
        (removed > 0).alias("some_removed"),
        "gold_rides",
        (F.col("gold_rides") == F.col("silver_rows")).alias("gold_matches_silver"),
    )


def schema_report(
    tables: Mapping[str, DataFrame],
    declared: Mapping[str, T.StructType],
    profiles: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """(table_name, column_name, expected_type, actual_type, type_ok, null_count) for every declared or found column.

    The types come from the schemas; the null counts from one pass over each table, or from its profile where one is given. A declared column that is missing
    has no actual type and no null count, and fails; a column that is not declared has no expected type and passes.
    """
    parts = None
    for name, table in tables.items():
        found = {f.name: f.dataType.simpleString() for f in table.schema}
        wanted = {f.name: f.dataType.simpleString() for f in declared[name]}
        counted = (profiles or {}).get(name)
        if counted is None:
            counted = table.agg(F.lit(True).alias("seen"), *[_nulls(c).alias(f"null_{c}") for c in found])
        entries = []
        for column in [*wanted, *[c for c in found if c not in wanted]]:
            expected, actual = wanted.get(column), found.get(column)
            entries.append(
                {
                    "table_name": F.lit(name),
                    "column_name": F.lit(column),
                    "expected_type": F.lit(expected).cast("string"),
                    "actual_type": F.lit(actual).cast("string"),
                    "type_ok": F.lit(actual is not None and expected in (None, actual)),
                    "null_count": F.col(f"null_{column}") if actual else F.lit(None).cast("bigint"),
                }
            )
        part = counted.select(_lines(entries))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def month_coverage(months: DataFrame, expected: DataFrame) -> DataFrame:
    """(month, row_count, missing) for every expected month; ``months`` has (month, row_count)."""
    return (
        expected.join(months, "month", "left")
        .select(
            "month",
            F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
            F.col("row_count").isNull().alias("missing"),
        )
        .orderBy("month")
    )
