"""Served views: small ordered results over gold tables, for an API or a dashboard to show.

Each view sorts again: the order in which a table was written is no promise about reading it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import round_half_even
from kerbside.settings import TOP_ROUTES


def _calendar(table: DataFrame) -> list[str]:
    return [c for c in ("year", "month") if c in table.columns]


def _top_routes(popular_routes: DataFrame, top: int) -> DataFrame:
    """Sort and limit together, so Spark keeps ``top`` rows per task. Ties are broken by name."""
    return popular_routes.orderBy(F.desc("ride_count"), "Borough", "DO_Borough").limit(top)


def serve_hourly_demand(hourly_demand: DataFrame) -> DataFrame:
    return hourly_demand.select("hour", "ride_count").orderBy("hour")


def serve_demand_by_borough(demand_by_borough: DataFrame) -> DataFrame:
    return demand_by_borough.select(F.col("Borough").alias("borough"), "ride_count").orderBy(
        F.desc("ride_count"), "borough"
    )


def serve_popular_routes(popular_routes: DataFrame, top: int = TOP_ROUTES) -> DataFrame:
    return _top_routes(popular_routes, top).select(
        F.col("Borough").alias("from"), F.col("DO_Borough").alias("to"), "ride_count"
    )


def dash_popular_routes(popular_routes: DataFrame, top: int = TOP_ROUTES) -> DataFrame:
    return _top_routes(popular_routes, top).select(
        F.col("Borough").alias("From"), F.col("DO_Borough").alias("To"), F.col("ride_count").alias("Ride Count")
    )


def _monthly(table: DataFrame, stored: str, served: str) -> DataFrame:
    months = _calendar(table)
    return table.select(*months, round_half_even(F.col(stored)).alias(served)).orderBy(*months)


def serve_avg_duration(avg_duration: DataFrame) -> DataFrame:
    return _monthly(avg_duration, "avg_duration_min", "avg_duration_min")


def serve_avg_distance(avg_distance: DataFrame) -> DataFrame:
    return _monthly(avg_distance, "avg_distance", "avg_distance_miles")


def serve_avg_passengers(avg_passengers: DataFrame) -> DataFrame:
    return _monthly(avg_passengers, "avg_passenger_count", "avg_passenger_count")


def dash_monthly_averages(
    avg_duration: DataFrame, avg_distance: DataFrame, avg_passengers: DataFrame
) -> DataFrame:
    """The three unrounded averages side by side; a month that one table lacks shows null there."""
    months = _calendar(avg_duration)
    return avg_duration.join(avg_distance, months, "full").join(avg_passengers, months, "full").orderBy(*months)


VIEWS = {
    "hourly-demand": ("hourly_demand", serve_hourly_demand),
    "demand-by-borough": ("demand_by_borough", serve_demand_by_borough),
    "popular-routes": ("popular_routes", serve_popular_routes),
    "avg-duration": ("avg_duration", serve_avg_duration),
    "avg-distance": ("avg_distance", serve_avg_distance),
    "avg-passengers": ("avg_passengers", serve_avg_passengers),
}
