"""One query per operator, over the trips derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import epoch_micros
from kerbside.operators import cleaning, demand, quality, rejects, views
from kerbside.operators.zones import with_boroughs, zone_id_uniqueness
from kerbside.registry import fixture
from kerbside.registry.stored_lake import LAKE_QUERIES
from kerbside.schemas import BRONZE_TRIPS, GOLD, SILVER_TRIPS
from kerbside.sources.monthly_files import expected_months, pickup_month_counts

Query = Callable[[SparkSession, str], DataFrame]


def _comparable(table: DataFrame) -> DataFrame:
    """Times as microseconds since the epoch (``<name>_us``), which every engine hashes alike."""
    return table.select(
        *[
            epoch_micros(F.col(f.name)).alias(f"{f.name}_us")
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name)
            for f in table.schema
        ]
    )


def _renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze_trips(spark, sf_dir).transform(cleaning.rename_trip_columns)


def _in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _renamed(spark, sf_dir).transform(cleaning.within_period)


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_range(spark, sf_dir).transform(cleaning.repair_clock_skew)


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir).transform(cleaning.with_duration)


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir).transform(cleaning.fill_passengers)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir).transform(cleaning.valid_measures)


def _usual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valid(spark, sf_dir).transform(cleaning.without_outliers)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.bronze_trips(spark, sf_dir).transform(cleaning.clean_trips)


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six tables from one rollup, as the gold job builds them; its exchange is planned once and used again."""
    return demand.gold_from_rollup(demand.activity_rollup(_silver(spark, sf_dir)), fixture.zones(spark, sf_dir))


def _from_silver(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_silver(spark, sf_dir))


def _from_silver_and_zones(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_silver(spark, sf_dir), fixture.zones(spark, sf_dir))


def _stage(stage: Query) -> Query:
    return lambda spark, sf_dir: _comparable(stage(spark, sf_dir))


hourly_demand = _from_silver(demand.hourly_demand)
demand_by_borough = _from_silver_and_zones(demand.demand_by_borough)
popular_routes = _from_silver_and_zones(demand.popular_routes)
avg_duration = _from_silver(demand.avg_duration)
avg_distance = _from_silver(demand.avg_distance)
avg_passengers = _from_silver(demand.avg_passengers)


def _served(view: Callable[[DataFrame], DataFrame], table: Query) -> Query:
    return lambda spark, sf_dir: view(table(spark, sf_dir))


def monthly_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.monthly_averages(demand.activity_rollup(_silver(spark, sf_dir))).orderBy("month")


def merged_month_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of each month, merged to the averages of all months, as a partial build of gold has them."""
    states = demand.month_states(_silver(spark, sf_dir))
    return demand.month_rows(demand.rollup_of_states(states)).orderBy("month")


def month_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pickup_month_counts(fixture.bronze_trips(spark, sf_dir))
    return quality.month_coverage(found, expected_months(spark))


def gold_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _gold(spark, sf_dir)
    return quality.null_profile(
        {**gold, "demand_by_borough": quality.recheck_boroughs(gold["demand_by_borough"])}
    )


def gold_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _gold(spark, sf_dir)
    return quality.gold_totals(gold["hourly_demand"], gold["demand_by_borough"], gold["popular_routes"])


def layer_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.layer_reconciliation(
        fixture.bronze_trips(spark, sf_dir), _silver(spark, sf_dir), hourly_demand(spark, sf_dir)
    )


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "bronze": fixture.bronze_trips(spark, sf_dir),
        "silver": _silver(spark, sf_dir),
        **_gold(spark, sf_dir),
    }
    return quality.schema_report(tables, {"bronze": BRONZE_TRIPS, "silver": SILVER_TRIPS, **GOLD})


QUERIES: dict[str, Query] = {
    # Sources
    "bronze_trips": _stage(fixture.bronze_trips),
    "bronze_month_coverage": month_coverage,
    "bronze_profile": lambda spark, sf_dir: quality.table_profile(fixture.bronze_trips(spark, sf_dir)),
    "bronze_sample": _stage(lambda spark, sf_dir: quality.sample(fixture.bronze_trips(spark, sf_dir))),
    "zones_lookup": fixture.zones,
    # Bronze to silver, step by step
    "silver_renamed": _stage(_renamed),
    "silver_in_range": _stage(_in_range),
    "silver_skew_repair": _stage(_repaired),
    "silver_duration": _stage(_timed),
    "silver_null_fill": _stage(_filled),
    "silver_valid": _stage(_valid),
    "silver_outliers": _stage(_usual),
    "silver_dedup": _stage(lambda spark, sf_dir: cleaning.one_row_per_trip(_renamed(spark, sf_dir))),
    "silver_clean_trips": _stage(_silver),
    "silver_funnel": lambda spark, sf_dir: cleaning.cleaning_funnel(fixture.bronze_trips(spark, sf_dir)),
    "silver_reject_reasons": lambda spark, sf_dir: rejects.reject_counts(
        rejects.with_reject_reasons(fixture.bronze_trips(spark, sf_dir))
    ),
    "silver_rejected_trips": _stage(
        lambda spark, sf_dir: rejects.with_reject_reasons(fixture.bronze_trips(spark, sf_dir)).filter("reject_reasons > 0")
    ),
    # Silver to gold
    "trips_with_boroughs": _stage(_from_silver_and_zones(with_boroughs)),
    "gold_hourly_demand": hourly_demand,
    "gold_demand_by_borough": demand_by_borough,
    "gold_popular_routes": popular_routes,
    "gold_avg_duration": avg_duration,
    "gold_avg_distance": avg_distance,
    "gold_avg_passengers": avg_passengers,
    "gold_base_rollup": _from_silver(lambda silver: demand.readable_rollup(demand.activity_rollup(silver))),
    "gold_merged_month_states": merged_month_states,
    # Served views
    "serve_hourly_demand": _served(views.serve_hourly_demand, hourly_demand),
    "serve_demand_by_borough": _served(views.serve_demand_by_borough, demand_by_borough),
    "serve_popular_routes": _served(views.serve_popular_routes, popular_routes),
    "serve_avg_duration": _served(views.serve_avg_duration, avg_duration),
    "serve_avg_distance": _served(views.serve_avg_distance, avg_distance),
    "serve_avg_passengers": _served(views.serve_avg_passengers, avg_passengers),
    "dash_popular_routes": _served(views.dash_popular_routes, popular_routes),
    "dash_monthly_averages": monthly_averages,
    # Checks
    "dq_silver_metrics": _from_silver(quality.silver_metrics),
    "dq_silver_gate": lambda spark, sf_dir: quality.silver_gate(quality.silver_metrics(_silver(spark, sf_dir))),
    "dq_silver_sample": _stage(_from_silver(quality.silver_sample)),
    "dq_gold_null_profile": gold_null_profile,
    "dq_gold_sample": _served(quality.sample, popular_routes),
    "dq_gold_hours_present": _served(quality.hours_present, hourly_demand),
    "dq_gold_nonpositive_routes": _served(quality.nonpositive_routes, popular_routes),
    "dq_gold_row_counts": lambda spark, sf_dir: quality.row_counts(_gold(spark, sf_dir)),
    "dq_gold_totals": gold_totals,
    "dq_layer_reconciliation": layer_reconciliation,
    "dq_schema_report": schema_report,
    "dq_zone_id_unique": lambda spark, sf_dir: zone_id_uniqueness(fixture.zones(spark, sf_dir)),
    # Over stored layers, built from monthly files
    **LAKE_QUERIES,
}
