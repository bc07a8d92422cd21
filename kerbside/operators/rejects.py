"""Trips that cleaning drops, with the reasons: every filter marks its bit instead of removing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.cleaning import (
    DEFAULT_PERIOD,
    DEFAULT_RULES,
    fill_passengers,
    in_period,
    rename_trip_columns,
    repair_clock_skew,
    sane_distance,
    sane_duration,
    usual_distance,
    usual_duration,
    with_duration,
)
from kerbside.settings import CleaningRules, Period

REASONS = ("outside_period", "duration_invalid", "distance_invalid", "duration_unusual", "distance_unusual")


def _conditions(period: Period, rules: CleaningRules) -> list[Column]:
    """What a trip must meet, in the order of the cleaner's filters; null counts as not met, as it does in a filter."""
    return [in_period(period), sane_duration(), sane_distance(), usual_duration(rules), usual_distance(rules)]


def with_reject_reasons(
    trips: DataFrame, period: Period = DEFAULT_PERIOD, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Every bronze trip as the cleaner sees it (renamed, repaired, timed, filled), with ``reject_reasons``.

    Bit n of it is set where the trip fails the n-th filter, whatever the filters before it say; 0 is what goes on to
    deduplication. One narrow pass: no row is read twice for being rejected twice.
    """
    seen = trips.transform(rename_trip_columns).transform(repair_clock_skew, rules)
    seen = seen.transform(with_duration).transform(fill_passengers)
    bits = F.lit(0)
    for nth, condition in enumerate(_conditions(period, rules)):
        bits = bits + F.when(F.coalesce(condition, F.lit(False)), 0).otherwise(1 << nth)
    return seen.withColumn("reject_reasons", bits)


def reject_counts(marked: DataFrame) -> DataFrame:
    """(reason_no, reason, row_count, dropped_here): trips that fail each filter, and those that fail no earlier one.

    The second number is what the filter takes out of the funnel. One aggregate over the marks.
    """
    marks = F.col("reject_reasons")
    counted = marked.groupBy(marks.alias("marks")).agg(F.count("*").alias("trips"))
    lines = []
    for nth, reason in enumerate(REASONS):
        bit = 1 << nth
        has = F.col("marks").bitwiseAND(F.lit(bit)) != 0
        first = F.col("marks").bitwiseAND(F.lit(2 * bit - 1)) == bit
        for name, condition in ((f"n_{reason}", has), (f"first_{reason}", first)):
            lines.append(F.coalesce(F.sum(F.when(condition, F.col("trips"))), F.lit(0)).alias(name))
    rows = [
        F.struct(
            F.lit(nth).alias("reason_no"),
            F.lit(reason).alias("reason"),
            F.col(f"n_{reason}").alias("row_count"),
            F.col(f"first_{reason}").alias("dropped_here"),
        )
        for nth, reason in enumerate(REASONS, start=1)
    ]
    return counted.agg(*lines).select(F.inline(F.array(*rows)))
