"""What the write of a layer has counted, per month, stored beside the layer: reports need not read the layer again.

A small JSON table: the month, its rows, nulls of each column, and a few rows as a sample. While a month is being written it
is not in the table, so a write that ended half-way leaves no stale counts; such a month is measured from its own files.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.settings import SAMPLE_ROWS

# Distinct months that counts stay exact for; the sketch drops nothing until three quarters of its map are full.
MOST_MONTHS = 5_000
COUNTERS = 10_000
# Each class of row hashes gives its smallest row, the sample is the smallest of these.
SAMPLE_CLASSES = 8

MEASURES = "month DATE, counts MAP<STRING, BIGINT>, sample ARRAY<STRUCT<hash: BIGINT, row: STRING>>"


@dataclass
class MonthMeasures:
    """Counts of one month (``rows``, and ``null_<column>`` for each column) and sampled rows as (hash, JSON)."""

    counts: Counter = field(default_factory=Counter)
    sample: list[tuple[int, str]] = field(default_factory=list)


def _month_number(month: Column) -> Column:
    return F.year(month) * 12 + F.month(month) - 1


def _per_month(number: Column) -> Column:
    """Rows per month as one aggregate state: the sketch counts every month apart while there are fewer than its counters."""
    return F.call_function("approx_top_k", number, F.lit(MOST_MONTHS), F.lit(COUNTERS))


def measured_columns(month: Column, columns: list[str]) -> list[Column]:
    """Aggregates to observe: the number of them grows with the columns, not with the months."""
    number = _month_number(month)
    hashed = F.xxhash64(*[F.col(c) for c in columns])
    row = F.struct(hashed.alias("hash"), number.alias("month"), F.struct(*columns).alias("row"))
    smallest = [F.min(F.when(F.pmod(hashed, F.lit(SAMPLE_CLASSES)) == n, row)) for n in range(SAMPLE_CLASSES)]
    return [
        F.count("*").alias("rows"),
        _per_month(number).alias("months"),
        *[_per_month(F.when(F.col(c).isNull(), number)).alias(f"null_{c}") for c in columns],
        F.array(*smallest).alias("sample"),
    ]


def _text(row: Row) -> str:
    def plain(value: object) -> object:
        return value.isoformat() if isinstance(value, (date, datetime)) else str(value)

    return json.dumps(row.asDict(recursive=True), default=plain)


def by_month(seen: Mapping[str, object], columns: list[str]) -> dict[date, MonthMeasures]:
    """Observed aggregates taken apart: every month with rows, and a count for every column, also where it is 0."""

    def months(name: str) -> dict[date, int]:
        return {date(r["item"] // 12, r["item"] % 12 + 1, 1): r["count"] for r in seen[name] or [] if r["item"] is not None}

    found = {month: MonthMeasures(Counter(rows=rows)) for month, rows in months("months").items()}
    if sum(m.counts["rows"] for m in found.values()) != seen["rows"]:
        raise ValueError("rows without a month, or more months than are counted apart")
    for column in columns:
        nulls = months(f"null_{column}")
        for month, measures in found.items():
            measures.counts[f"null_{column}"] = nulls.get(month, 0)
    for taken in seen["sample"] or []:
        if taken is not None:
            month = date(taken["month"] // 12, taken["month"] % 12 + 1, 1)
            found[month].sample.append((taken["hash"], _text(taken["row"])))
    return found


def measured(table: DataFrame, month: date, columns: list[str]) -> MonthMeasures:
    """The measures of one month from its rows: what a write would have observed."""
    seen = table.agg(*measured_columns(F.lit(month), columns)).first().asDict()
    return by_month(seen, columns).get(month, no_rows(columns))


def no_rows(columns: list[str]) -> MonthMeasures:
    return MonthMeasures(Counter({"rows": 0, **{f"null_{c}": 0 for c in columns}}))


def _path(layer: str) -> str:
    return f"{layer}_measures"


def stored_measures(spark: SparkSession, layer: str) -> dict[date, MonthMeasures]:
    try:
        stored = spark.read.schema(MEASURES).json(_path(layer)).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r["month"]: MonthMeasures(Counter(r["counts"]), [tuple(s) for s in r["sample"]]) for r in stored}


def store_measures(spark: SparkSession, layer: str, measures: Mapping[date, MonthMeasures]) -> None:
    rows = [(month, dict(m.counts), m.sample) for month, m in sorted(measures.items())]
    spark.createDataFrame(rows, MEASURES).coalesce(1).write.mode("overwrite").json(_path(layer))


def profile_of(spark: SparkSession, measures: Mapping[date, MonthMeasures], columns: list[str]) -> DataFrame:
    """``quality.table_profile`` of a layer from its measures. A month that lacks a column has nulls for all of its rows."""
    names = {c: f"null_{c}" for c in columns}
    found = [{k.lower(): n for k, n in m.counts.items()} for m in measures.values()]
    nulls = [sum(m.get(name.lower(), m["rows"]) for m in found) for name in names.values()]
    schema = ", ".join(["row_count BIGINT", "column_count BIGINT", *[f"`{n}` BIGINT" for n in names.values()]])
    return spark.createDataFrame([(sum(m["rows"] for m in found), len(columns), *nulls)], schema)


def month_rows(spark: SparkSession, measures: Mapping[date, MonthMeasures]) -> DataFrame:
    """(month, row_count) per month of a layer."""
    rows = [(f"{month:%Y-%m}", m.counts["rows"]) for month, m in measures.items()]
    return spark.createDataFrame(rows, "month STRING, row_count BIGINT")


def total_rows(spark: SparkSession, measures: Mapping[date, MonthMeasures]) -> DataFrame:
    return spark.createDataFrame([(sum(m.counts["rows"] for m in measures.values()),)], "total BIGINT")


def sample_of(
    spark: SparkSession, measures: Mapping[date, MonthMeasures], schema: T.StructType, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Sampled rows of a layer, smallest hash first. Each write adds its own, and a replaced month takes its rows away."""
    smallest = sorted(taken for m in measures.values() for taken in m.sample)[:rows]
    texts = spark.createDataFrame([(text,) for _, text in smallest], "row STRING")
    return texts.select(F.from_json("row", schema).alias("row")).select("row.*")
