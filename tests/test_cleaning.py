from __future__ import annotations

import itertools
from datetime import date

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from kerbside.operators import cleaning
from kerbside.registry import fixture
from kerbside.settings import CleaningRules, Period

SF = "/root/testdata/sf0.01"


def steps(trips, *operators):
    trips = cleaning.rename_trip_columns(trips)
    for operator in operators:
        trips = operator(trips)
    return trips


def test_rename_leaves_other_columns_alone(bronze):
    renamed = cleaning.rename_trip_columns(bronze({}).withColumn("fare", F.lit(1)))
    assert renamed.columns == [
        "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
        "pickup_location_id", "dropoff_location_id", "fare",
    ]


def test_period_edges(bronze):
    times = [
        "2024-12-31 23:59:59.999999", "2025-01-01 00:00:00", "2025-12-31 23:59:59.999999", "2026-01-01 00:00:00", None,
    ]
    kept = steps(bronze(*[{"pickup": t} for t in times]), cleaning.within_period)
    assert {r[0] for r in rows(kept)} == {at(times[1]), at(times[2])}


@pytest.mark.parametrize(
    ("dropoff", "expected"),
    [
        ("2025-03-01 09:59:01", "2025-03-01 10:00:00"),  # 59 s before: repaired
        ("2025-03-01 09:59:00", "2025-03-01 09:59:00"),  # 60 s before: left
        ("2025-03-01 09:58:59", "2025-03-01 09:58:59"),  # 61 s before: left
        ("2025-03-01 10:00:00", "2025-03-01 10:00:00"),
        ("2025-03-01 10:00:01", "2025-03-01 10:00:01"),
        (None, None),
    ],
)
def test_clock_skew(bronze, dropoff, expected):
    repaired = steps(bronze({"dropoff": dropoff}), cleaning.repair_clock_skew)
    assert rows(repaired.select("dropoff_datetime")) == [(at(expected),)]


def test_skew_in_the_same_second_is_no_skew(bronze):
    trip = {"pickup": "2025-03-01 10:00:00.9", "dropoff": "2025-03-01 10:00:00.1"}
    repaired = steps(bronze(trip), cleaning.repair_clock_skew)
    assert rows(repaired.select("dropoff_datetime")) == [(at(trip["dropoff"]),)]


def test_duration_cuts_each_side_to_its_second(bronze):
    trip = {"pickup": "2025-03-01 00:00:00.9", "dropoff": "2025-03-01 00:01:00.1"}
    assert rows(steps(bronze(trip), cleaning.with_duration).select("duration_sec")) == [(60,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_duration_ignores_the_session_zone(spark, bronze, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        trip = {"pickup": "2025-03-09 01:50:00", "dropoff": "2025-03-09 03:10:00"}
        assert rows(steps(bronze(trip), cleaning.with_duration).select("duration_sec")) == [(4800,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_null_passengers_become_zero(bronze):
    filled = steps(bronze({"passengers": None}, {"passengers": 3}), cleaning.fill_passengers)
    assert sorted(rows(filled.select("passenger_count"))) == [(0,), (3,)]


def test_validity_drops_negatives_and_nulls(bronze):
    by_time = [{"dropoff": None}, {"dropoff": "2025-03-01 09:00:00"}]
    trips = bronze({"miles": -0.1}, {"miles": None}, {"miles": 0.0}, *by_time)
    kept = steps(trips, cleaning.with_duration, cleaning.valid_measures)
    assert rows(kept.select("trip_distance")) == [(0.0,)]


def test_outlier_edges(bronze):
    seconds = {59: False, 60: True, 7199: True, 7200: False}
    miles = {0.0: False, 0.001: True, 29.999: True, 30.0: False, float("nan"): False}
    by_time = [
        {"dropoff": f"2025-03-01 {10 + s // 3600}:{s % 3600 // 60:02d}:{s % 60:02d}", "pu": s} for s in seconds
    ]
    kept = steps(bronze(*by_time), cleaning.with_duration, cleaning.without_outliers)
    assert {r[0] for r in rows(kept.select("pickup_location_id"))} == {s for s, keep in seconds.items() if keep}
    kept = steps(bronze(*[{"miles": m} for m in miles]), cleaning.with_duration, cleaning.without_outliers)
    assert {r[0] for r in rows(kept.select("trip_distance"))} == {m for m, keep in miles.items() if keep}


def test_rules_are_parameters(bronze):
    trips = steps(bronze({"miles": 40.0}), cleaning.with_duration)
    assert cleaning.without_outliers(trips).count() == 0
    assert cleaning.without_outliers(trips, CleaningRules(max_distance_miles=50.0)).count() == 1


def test_dedup_keeps_the_smallest_in_any_input_order(bronze):
    copies = [
        {"miles": 3.0, "passengers": 1}, {"miles": 2.0, "passengers": 2}, {"miles": 2.0, "passengers": 1},
        {"miles": 2.0, "passengers": None}, {"miles": 9.0, "passengers": 0},
    ]
    for order in itertools.islice(itertools.permutations(copies), 0, 120, 37):
        kept = steps(bronze(*order).repartition(3), cleaning.one_row_per_trip)
        assert rows(kept.select("trip_distance", "passenger_count")) == [(2.0, None)]


def test_dedup_breaks_ties_by_the_other_columns(bronze):
    trips = bronze({}, {}, {}).withColumn("fare", F.monotonically_increasing_id())
    kept = steps(trips, cleaning.one_row_per_trip)
    assert kept.columns[-1] == "fare"
    assert rows(kept.select("fare")) == [(min(r[0] for r in rows(trips.select("fare"))),)]


def test_dedup_treats_null_places_as_equal(bronze):
    assert steps(bronze({"pu": None}, {"pu": None}, {"pu": 1}), cleaning.one_row_per_trip).count() == 2


def test_filters_come_before_dedup(bronze):
    # The zero-mile copy would win the deduplication and then be filtered: the good copy must survive.
    cleaned = cleaning.clean_trips(bronze({"miles": 0.0}, {"miles": 5.0}))
    assert rows(cleaned.select("trip_distance")) == [(5.0,)]


def test_skew_repair_never_reaches_silver(bronze):
    assert cleaning.clean_trips(bronze({"dropoff": "2025-03-01 09:59:30"})).count() == 0


def test_extra_columns_pass_through(bronze):
    cleaned = cleaning.clean_trips(bronze({}).withColumn("fare", F.lit(7.5)))
    assert rows(cleaned.select("fare")) == [(7.5,)]


def test_clean_is_idempotent_and_independent_of_partitioning(spark):
    trips = fixture.bronze_trips(spark, SF)
    once = cleaning.clean_trips(trips)
    again = cleaning.one_row_per_trip(once)
    shuffled = cleaning.clean_trips(trips.repartition(13, "PULocationID"))
    assert once.exceptAll(again).count() == 0
    assert once.exceptAll(shuffled).count() == 0 and once.count() == shuffled.count() == 7525


def test_months_add_up_to_the_year(spark):
    trips = fixture.bronze_trips(spark, SF)
    firsts = [date(2025, m, 1) for m in range(1, 13)] + [date(2026, 1, 1)]
    monthly = None
    for start, end in zip(firsts, firsts[1:]):
        part = cleaning.clean_trips(trips, Period(start, end))
        monthly = part if monthly is None else monthly.unionByName(part)
    year = cleaning.clean_trips(trips)
    assert year.exceptAll(monthly).count() == 0 and monthly.count() == 7525


def test_a_third_of_all_rows_in_one_trip(spark, bronze):
    hot = bronze({}).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50_000))))
    hot = hot.withColumn("trip_distance", F.col("copy") / 1e4).drop("copy")
    others = bronze({}).withColumn("PULocationID", F.explode(F.sequence(F.lit(1000), F.lit(100_999))))
    cleaned = cleaning.clean_trips(hot.unionByName(others).repartition(16))
    assert cleaned.count() == 100_001
    assert rows(cleaned.filter("pickup_location_id = 1").select("trip_distance")) == [(0.0001,)]


def test_empty_input(bronze):
    nothing = bronze({}).limit(0)
    assert cleaning.clean_trips(nothing).count() == 0
    assert {r[2] for r in rows(cleaning.cleaning_funnel(nothing))} == {0}


@pytest.mark.parametrize(
    ("scale", "expected"),
    [
        ("0.001", (1050, 1005, 11, 979, 959, 835, 806, 764)),
        ("0.01", (10500, 9947, 110, 9684, 9491, 8192, 7917, 7525)),
        ("0.1", (105000, 99581, 1109, 96957, 95035, 81738, 79002, 75233)),
    ],
)
def test_funnel_at_every_scale(spark, scale, expected):
    funnel = cleaning.cleaning_funnel(fixture.bronze_trips(spark, f"/root/testdata/sf{scale}"))
    assert tuple(r[2] for r in sorted(rows(funnel))) == expected
