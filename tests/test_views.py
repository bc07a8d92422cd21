from __future__ import annotations

import math
import random

from conftest import rows
from pyspark.sql import functions as F

from kerbside.functions import round_half_even
from kerbside.operators import views


def test_rounding_is_that_of_python(spark):
    random.seed(7)
    values = [2.675, 0.125, 0.375, 1.005, 1234.005, 0.0, -2.675, 107 / 40, 1e-9, 33.335, 12.345]
    values += [n / 200 for n in range(1, 4000, 7)] + [random.uniform(0, 200) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select("v", round_half_even(F.col("v")))
    wrong = [(v, got) for v, got in rows(frame) if got != round(v, 2)]
    assert not wrong


def test_rounding_null_is_null(spark):
    frame = spark.createDataFrame([(None,)], "v DOUBLE").select(round_half_even(F.col("v")))
    assert rows(frame) == [(None,)]


def test_top_routes_cut_and_ties(spark):
    many = [(f"A{n:02d}", "Z", 5) for n in range(25)] + [("B", "Z", 9)]
    routes = spark.createDataFrame(many, "Borough STRING, DO_Borough STRING, ride_count LONG")
    served = views.serve_popular_routes(routes)
    assert served.columns == ["from", "to", "ride_count"]
    got = rows(served)
    assert got[0] == ("B", "Z", 9) and [r[0] for r in got[1:]] == [f"A{n:02d}" for n in range(19)]


def test_dashboard_names(spark):
    routes = spark.createDataFrame([("A", "B", 1)], "Borough STRING, DO_Borough STRING, ride_count LONG")
    assert views.dash_popular_routes(routes).columns == ["From", "To", "Ride Count"]


def test_views_sort_again(spark):
    hours = spark.createDataFrame([(5, 1), (0, 2), (23, 3)], "hour INT, ride_count LONG").repartition(3)
    assert [r[0] for r in rows(views.serve_hourly_demand(hours))] == [0, 5, 23]
    boroughs = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "Borough STRING, ride_count LONG")
    assert rows(views.serve_demand_by_borough(boroughs)) == [("c", 2), ("a", 1), ("b", 1)]


def test_monthly_views_round_and_rename(spark):
    months = spark.createDataFrame([(2, 2.675), (1, math.pi)], "month INT, avg_distance DOUBLE")
    served = views.serve_avg_distance(months)
    assert served.columns == ["month", "avg_distance_miles"] and rows(served) == [(1, 3.14), (2, 2.67)]


def test_monthly_overview_keeps_months_without_passengers(spark):
    duration = spark.createDataFrame([(1, 10.0), (2, 20.0)], "month INT, avg_duration_min DOUBLE")
    distance = spark.createDataFrame([(1, 1.0), (2, 2.0)], "month INT, avg_distance DOUBLE")
    people = spark.createDataFrame([(2, 1.5)], "month INT, avg_passenger_count DOUBLE")
    assert rows(views.dash_monthly_averages(duration, distance, people)) == [(1, 10.0, 1.0, None), (2, 20.0, 2.0, 1.5)]
