"""Raw to bronze to silver to gold, and the checks over the layers.

The layers are the only lineage cuts: each job reads what the one before has written, so a lost executor costs its
tasks and no more. ``only_these_months`` makes a job replace the months of its period and leave the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import quality
from kerbside.operators.cleaning import clean_trips
from kerbside.operators.demand import BY_MONTH, gold_from_rollup, month_states, rollup_of_states
from kerbside.operators.rejects import reject_counts, with_reject_reasons
from kerbside.operators.views import VIEWS, dash_monthly_averages, dash_popular_routes
from kerbside.operators.zones import zone_id_uniqueness
from kerbside.schemas import BRONZE_TRIPS, SILVER_TRIPS, gold_schemas
from kerbside.session import size_shuffles
from kerbside.settings import GOLD_TABLES, CleaningRules, LakeLayout, Period
from kerbside.sources.lake import (
    aligned_with_bronze,
    layer_measures,
    read_bronze,
    read_silver,
    read_table,
    replace_bronze_months,
    replace_months,
    replace_silver_months,
    schema_if_present,
    write_bronze,
    write_by_month,
    write_marked,
    write_silver,
    write_table,
)
from kerbside.sources.measures import month_rows, profile_of, sample_of, total_rows
from kerbside.sources.monthly_files import expected_months, found_months, read_monthly_files, scan_months
from kerbside.sources.zone_file import read_zones


def build_bronze(
    spark: SparkSession, lake: LakeLayout, period: Period = Period(), only_these_months: bool = False
) -> int:
    """Store the monthly files of the period; returns the rows written."""
    if not only_these_months:
        return write_bronze(read_monthly_files(spark, lake.raw, period), lake.bronze)
    present = found_months(spark, lake.raw, period)
    missing = [month.months[0] for month in period.each_month() if month.months[0] not in present]
    if missing:
        raise FileNotFoundError(f"no raw file for {missing} under {lake.raw}; bronze is unchanged")
    trips = {
        month.start: aligned_with_bronze(scan_months(spark, lake.raw, {month.months[0]: present[month.months[0]]}), lake.bronze)
        for month in period.each_month()
    }
    return replace_bronze_months(trips, lake.bronze)


def build_silver(
    spark: SparkSession,
    lake: LakeLayout,
    period: Period = Period(),
    rules: CleaningRules = CleaningRules(),
    only_these_months: bool = False,
) -> int:
    """Store the clean trips of the period; returns the rows written.

    A full build is one job for all months. A partial one has a job per month, several at a time, each of which scans
    little more than that month; months are disjoint by pickup, which is part of the trip key, so the rows are the same.
    """

    def cleaned(span: Period) -> DataFrame:
        return read_bronze(spark, lake.bronze, span).transform(clean_trips, span, rules)

    size_shuffles(spark, lake.bronze)
    if not only_these_months:
        return write_silver(cleaned(period), lake.silver)
    return replace_silver_months({month.start: cleaned(month) for month in period.each_month()}, lake.silver)


def build_marked(
    spark: SparkSession, lake: LakeLayout, period: Period = Period(), rules: CleaningRules = CleaningRules()
) -> int:
    """Store every bronze trip with the reasons why cleaning would reject it, kept and rejected trips apart; returns the rows."""
    return write_marked(with_reject_reasons(read_bronze(spark, lake.bronze), period, rules), lake.marked)


def check_rejects(spark: SparkSession, lake: LakeLayout) -> dict[str, DataFrame]:
    """Rejected trips by reason, from the partition of rejected trips alone."""
    rejected = read_table(spark, lake.marked).filter("rejected = 1")
    return {"reasons": reject_counts(rejected), "sample": quality.sample(rejected.drop("rejected"))}


def build_gold(
    spark: SparkSession,
    lake: LakeLayout,
    by_year: bool | None = None,
    period: Period = Period(),
    only_these_months: bool = False,
) -> dict[str, int]:
    """Store the states of each month, the rollup merged from them, and the six tables; returns the rows of each table.

    A full build scans silver once. A partial one scans the months of the period, replaces their states and merges them with
    the stored states of the other months, so gold is as after a full build. Without stored states it is a full build.

    Monthly tables carry the year where silver holds several years; a caller who refuses that then gets an error. A repeated
    zone id would multiply counts, so the job checks for it first.
    """
    zones = read_zones(spark, lake.zones)
    unique = zone_id_uniqueness(zones).select(
        F.lit("zone_id_unique").alias("check_name"),
        F.col("repeated_ids").alias("failures"),
        F.col("is_unique").alias("passed"),
    )
    quality.enforce(unique)
    silver = read_silver(spark, lake.silver, columns=SILVER_TRIPS)
    if only_these_months and schema_if_present(spark, lake.states) is not None:
        month = F.col("pickup_month")
        changed = silver.filter((month >= F.lit(period.start)) & (month < F.lit(period.end)))
        replace_months(month_states(changed), lake.states, "pickup_month", period)
    else:
        write_by_month(month_states(silver), lake.states, "pickup_month")
    states = read_table(spark, lake.states, month_states(silver).schema)
    several = states.filter(F.col("grain") == BY_MONTH).select(F.year("pickup_month")).distinct().limit(2).count() > 1
    if several and by_year is False:
        raise ValueError("silver holds several years: month numbers would mix")
    write_table(rollup_of_states(states, bool(by_year) or several), lake.rollup)
    tables = gold_from_rollup(read_table(spark, lake.rollup), zones)
    return {name: write_table(table, lake.gold(name)) for name, table in tables.items()}


def read_gold(spark: SparkSession, lake: LakeLayout) -> dict[str, DataFrame]:
    return {name: read_table(spark, lake.gold(name)) for name in GOLD_TABLES}


def serve(spark: SparkSession, lake: LakeLayout, view: str) -> DataFrame:
    """One of the named views over the stored gold tables."""
    if view == "dash-popular-routes":
        return dash_popular_routes(read_table(spark, lake.gold("popular_routes")))
    if view == "dash-monthly-averages":
        return dash_monthly_averages(
            *[read_table(spark, lake.gold(name)) for name in ("avg_duration", "avg_distance", "avg_passengers")]
        )
    table, definition = VIEWS[view]
    return definition(read_table(spark, lake.gold(table)))


def check_bronze(spark: SparkSession, lake: LakeLayout, period: Period = Period()) -> dict[str, DataFrame]:
    """The checks on bronze, from what its writes have counted: no trip is read."""
    bronze = read_bronze(spark, lake.bronze)
    measures = layer_measures(spark, lake.bronze, "source_month")
    profile = profile_of(spark, measures, bronze.columns)
    return {
        "profile": profile,
        "schema": quality.schema_report({"bronze": bronze}, {"bronze": BRONZE_TRIPS}, {"bronze": profile}),
        "months": quality.month_coverage(month_rows(spark, measures), expected_months(spark, period)),
        "sample": sample_of(spark, measures, bronze.schema),
    }


def check_silver(spark: SparkSession, lake: LakeLayout) -> dict[str, DataFrame]:
    """The checks on silver. Raises when a critical one fails."""
    silver = read_silver(spark, lake.silver).drop("pickup_month")
    # One pass: the gate and the report are made of the one row that is fetched here.
    measured = quality.silver_metrics(silver)
    metrics = spark.createDataFrame(measured.collect(), measured.schema)
    gate = quality.silver_gate(metrics)
    quality.enforce(gate, metrics)
    return {
        "schema": quality.schema_report({"silver": silver}, {"silver": SILVER_TRIPS}),
        "metrics": metrics,
        "gate": gate,
        "sample": quality.silver_sample(silver),
    }


def check_gold(spark: SparkSession, lake: LakeLayout) -> dict[str, DataFrame]:
    tables = read_gold(spark, lake)
    profiled = {**tables, "demand_by_borough": quality.recheck_boroughs(tables["demand_by_borough"])}
    return {
        "schema": quality.schema_report(tables, gold_schemas(any("year" in t.columns for t in tables.values()))),
        **{f"sample of {name}": quality.sample(table) for name, table in profiled.items()},
        "nulls": quality.null_profile(profiled),
        "rows": quality.row_counts(tables),
        "hours": quality.hours_present(tables["hourly_demand"]),
        "nonpositive_routes": quality.nonpositive_routes(tables["popular_routes"]),
        "totals": quality.gold_totals(
            tables["hourly_demand"], tables["demand_by_borough"], tables["popular_routes"]
        ),
    }


def check_layers(spark: SparkSession, lake: LakeLayout) -> dict[str, DataFrame]:
    """What cleaning removed and whether gold counts every silver trip: rows counted by the writes beside the stored gold."""
    bronze = total_rows(spark, layer_measures(spark, lake.bronze, "source_month"))
    silver = total_rows(spark, layer_measures(spark, lake.silver, "pickup_month"))
    return {"layers": quality.reconciled(bronze, silver, read_table(spark, lake.gold("hourly_demand")))}
