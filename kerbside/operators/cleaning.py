"""From bronze trips to silver trips. Each step is one function for ``DataFrame.transform``.

The order of the steps is part of the meaning: deduplication comes last, after the filters,
because rows that differ only in a filtered measure must not shadow a good row.
All steps but the last are narrow, so the chain costs exactly one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import elapsed_seconds, ntz
from kerbside.settings import CleaningRules, Period

SILVER_NAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}
TRIP_KEY = ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")
KEEP_FIRST_BY = ("trip_distance", "passenger_count")
DEFAULT_RULES = CleaningRules()
DEFAULT_PERIOD = Period()


def rename_trip_columns(trips: DataFrame) -> DataFrame:
    """Snake-case names for the two times and the two places; every other column is left alone."""
    return trips.withColumnsRenamed(SILVER_NAMES)


def in_period(period: Period = DEFAULT_PERIOD) -> Column:
    """Condition: picked up within the period. Null pickups fail it."""
    pickup = F.col("pickup_datetime")
    return (pickup >= ntz(period.start)) & (pickup < ntz(period.end))


def within_period(trips: DataFrame, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Trips picked up within the period."""
    return trips.filter(in_period(period))


def skewed_clock(rules: CleaningRules = DEFAULT_RULES) -> Column:
    """Condition: the dropoff lies before the pickup, but by less than the tolerance."""
    gap = elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return (gap < 0) & (gap > -rules.skew_tolerance_sec)


def repair_clock_skew(trips: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    """Set the dropoff to the pickup where the clocks disagree slightly; a null dropoff stays null."""
    repaired = F.when(skewed_clock(rules), F.col("pickup_datetime")).otherwise(F.col("dropoff_datetime"))
    return trips.withColumn("dropoff_datetime", repaired)


def with_duration(trips: DataFrame) -> DataFrame:
    """Add ``duration_sec``."""
    return trips.withColumn("duration_sec", elapsed_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")))


def fill_passengers(trips: DataFrame) -> DataFrame:
    """An unknown passenger count becomes 0 instead of costing the row."""
    return trips.fillna(0, subset=["passenger_count"])


def sane_duration() -> Column:
    return F.col("duration_sec") >= 0


def sane_distance() -> Column:
    return F.col("trip_distance") >= 0


def valid_measures(trips: DataFrame) -> DataFrame:
    """No negative durations or distances; nulls fail as well."""
    return trips.filter(sane_duration()).filter(sane_distance())


def usual_duration(rules: CleaningRules = DEFAULT_RULES) -> Column:
    seconds = F.col("duration_sec")
    return (seconds >= rules.min_duration_sec) & (seconds < rules.max_duration_sec)


def usual_distance(rules: CleaningRules = DEFAULT_RULES) -> Column:
    """NaN sorts above every number in Spark, so the upper bound drops it."""
    miles = F.col("trip_distance")
    return (miles > 0) & (miles < rules.max_distance_miles)


def without_outliers(trips: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    """Durations from the minimum up to below the maximum; distances strictly between 0 and the maximum."""
    return trips.filter(usual_duration(rules)).filter(usual_distance(rules))


def one_row_per_trip(trips: DataFrame) -> DataFrame:
    """Keep one row per (pickup, dropoff, pickup place, dropoff place); null places equal each other.

    The row kept is the smallest by distance, then passengers, then the other columns by name, nulls first.
    ``dropDuplicates`` would keep an arbitrary one, and the averages over distance and passengers
    would change from run to run.

    As an aggregate (the minimum of a struct) this combines on the map side: however many copies of one trip there
    are, each input task sends at most one of them on, so no reducer ever holds a hot trip's copies.
    """
    rest = [c for c in trips.columns if c not in TRIP_KEY]
    by_rank = [c for c in KEEP_FIRST_BY if c in rest] + sorted(c for c in rest if c not in KEEP_FIRST_BY)
    first = F.min(F.struct(*[F.col(c) for c in by_rank]))
    kept = trips.groupBy(*TRIP_KEY).agg(first.alias("kept"))
    return kept.select(*[F.col(c) if c in TRIP_KEY else F.col(f"kept.{c}").alias(c) for c in trips.columns])


def filtered_trips(
    trips: DataFrame, period: Period = DEFAULT_PERIOD, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """All narrow steps: everything before deduplication."""
    return (
        trips.transform(rename_trip_columns)
        .transform(within_period, period)
        .transform(repair_clock_skew, rules)
        .transform(with_duration)
        .transform(fill_passengers)
        .transform(valid_measures)
        .transform(without_outliers, rules)
    )


def clean_trips(
    trips: DataFrame, period: Period = DEFAULT_PERIOD, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Bronze trips to silver trips in one pass over the whole period.

    The duration follows from the trip key, so it is not carried through the shuffle but worked out again after it.
    """
    kept = trips.transform(filtered_trips, period, rules).drop("duration_sec").transform(one_row_per_trip)
    return kept.transform(with_duration)


def cleaning_funnel(
    trips: DataFrame, period: Period = DEFAULT_PERIOD, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Rows left after each step, as (step_no, step, row_count), from one scan and one keyed shuffle.

    The first grouping counts per trip key. Rows that fail a filter share one null key, which costs nothing: each
    input task has summed them to one row before the shuffle. Groups that passed everything are the silver rows.
    """
    prepared = trips.transform(rename_trip_columns).withColumn("was_skewed", skewed_clock(rules))
    prepared = prepared.transform(repair_clock_skew, rules).transform(with_duration)
    steps = [
        ("in_period", in_period(period)),
        ("duration_valid", sane_duration()),
        ("distance_valid", sane_distance()),
        ("duration_usual", usual_duration(rules)),
        ("distance_usual", usual_distance(rules)),
    ]
    passed = F.lit(True)
    flags = {}
    for name, condition in steps:
        passed = passed & F.coalesce(condition, F.lit(False))
        flags[name] = passed
    flags["skew_repaired"] = flags["in_period"] & F.coalesce(F.col("was_skewed"), F.lit(False))
    flagged = prepared.select(
        *[F.when(passed, F.col(c)).alias(c) for c in TRIP_KEY],
        *[flag.alias(name) for name, flag in flags.items()],
    )
    # distance_usual is the last filter: it is true exactly for the rows that reach deduplication.
    per_trip = flagged.groupBy("distance_usual", *TRIP_KEY).agg(
        F.count("*").alias("bronze"),
        *[F.count_if(F.col(name)).alias(f"n_{name}") for name in flags],
    )
    totals = per_trip.agg(
        F.coalesce(F.sum("bronze"), F.lit(0)).alias("bronze"),
        *[F.coalesce(F.sum(f"n_{name}"), F.lit(0)).alias(name) for name in flags],
        F.count_if("distance_usual").alias("silver"),
    )
    order = [
        "bronze",
        "in_period",
        "skew_repaired",
        "duration_valid",
        "distance_valid",
        "duration_usual",
        "distance_usual",
        "silver",
    ]
    lines = F.inline(
        F.array(
            *[
                F.struct(F.lit(no).alias("step_no"), F.lit(name).alias("step"), F.col(name).alias("row_count"))
                for no, name in enumerate(order, start=1)
            ]
        )
    )
    return totals.select(lines)
