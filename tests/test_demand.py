from __future__ import annotations

import math
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.operators import cleaning, demand, zones
from kerbside.registry import fixture
from kerbside.settings import GOLD_TABLES, Period

BOROUGHS = [(1, "Queens"), (2, "Bronx"), (3, "Unknown"), (4, "N/A"), (5, "EWR"), (6, None), (7, "unknown")]


def test_hourly_demand_counts(silver):
    trips = silver({"pickup": "2025-03-01 23:10:00"}, {}, {"pickup": "2025-07-09 10:59:59.9"}, {"pickup": None})
    assert sorted(rows(demand.hourly_demand(trips))) == [(10, 2), (23, 1)]


def test_borough_exclusions_are_case_sensitive(silver, lookup):
    trips = silver(*[{"pu": n} for n in (1, 1, 2, 3, 4, 5, 6, 7, 99, None)])
    assert sorted(rows(demand.demand_by_borough(trips, lookup(*BOROUGHS)))) == [("Bronx", 1), ("Queens", 2), ("unknown", 1)]


def test_routes_need_both_ends(silver, lookup):
    trips = silver({}, {}, {"pu": 2, "do": 1}, {"pu": 1, "do": 3}, {"pu": 6, "do": 1}, {"do": None}, {"pu": 5, "do": 5})
    assert sorted(rows(demand.popular_routes(trips, lookup(*BOROUGHS)))) == [("Bronx", "Queens", 1), ("Queens", "Bronx", 2)]


def test_monthly_averages(silver):
    trips = silver(
        {"seconds": 60, "miles": 0.1, "passengers": 0},
        {"seconds": 90, "miles": 0.2, "passengers": 1},
        {"seconds": 120, "miles": 0.3, "passengers": 4},
        {"pickup": "2025-04-01 00:00:00", "passengers": 0},
    )
    assert sorted(rows(demand.avg_duration(trips))) == [(3, 1.5), (4, 10.0)]
    assert sorted(rows(demand.avg_distance(trips))) == [(3, 0.6 / 3), (4, 2.5)]
    assert rows(demand.avg_passengers(trips)) == [(3, 2.5)]


def test_average_distance_does_not_depend_on_partitioning(spark):
    trips = cleaning.clean_trips(fixture.bronze_trips(spark, "/root/testdata/sf0.01"))
    answers = {tuple(sorted(rows(demand.avg_distance(trips.repartition(n))))) for n in (1, 7, 16)}
    assert len(answers) == 1


def test_years_do_not_mix_when_asked(silver):
    trips = silver({"seconds": 60}, {"pickup": "2026-03-01 10:00:00", "seconds": 120})
    assert sorted(rows(demand.avg_duration(trips))) == [(3, 1.5)]
    assert sorted(rows(demand.avg_duration(trips, by_year=True))) == [(2025, 3, 1.0), (2026, 3, 2.0)]
    by_year = demand.gold_from_rollup(demand.activity_rollup(trips, by_year=True), _no_zones(trips.sparkSession))
    assert sorted(rows(by_year["avg_duration"])) == [(2025, 3, 1.0), (2026, 3, 2.0)]
    assert Period(date(2025, 3, 1), date(2026, 4, 1)).several_years and not Period().several_years


def _no_zones(spark):
    return spark.createDataFrame([], "zone_LocationID INT, Borough STRING")


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_rollup_equals_the_direct_form(spark, scale):
    sf_dir = f"/root/testdata/sf{scale}"
    trips = cleaning.clean_trips(fixture.bronze_trips(spark, sf_dir)).cache()
    lookup = fixture.zones(spark, sf_dir)
    rolled = demand.gold_from_rollup(demand.activity_rollup(trips).cache(), lookup)
    assert tuple(rolled) == GOLD_TABLES
    direct = {
        "hourly_demand": demand.hourly_demand(trips),
        "demand_by_borough": demand.demand_by_borough(trips, lookup),
        "popular_routes": demand.popular_routes(trips, lookup),
        "avg_duration": demand.avg_duration(trips),
        "avg_distance": demand.avg_distance(trips),
        "avg_passengers": demand.avg_passengers(trips),
    }
    for name, table in direct.items():
        assert sorted(rows(table)) == sorted(rows(rolled[name])), name
    spark.catalog.clearCache()


def test_rollup_keeps_null_places_apart_from_other_grains(silver):
    rollup = demand.activity_rollup(silver({"pu": None, "do": None}, {"pu": None, "do": None}))
    assert rows(rollup.filter("grain = 'route'").select("pickup_location_id", "ride_count")) == [(None, 2)]
    assert rollup.count() == 3


def test_unmatched_places_keep_the_trip(silver, lookup):
    joined = zones.with_boroughs(silver({"pu": 1, "do": 99}, {"pu": None, "do": 2}), lookup(*BOROUGHS))
    assert sorted(rows(joined.select("Borough", "DO_Borough")), key=str) == [("Queens", None), (None, "Bronx")]


def test_repeated_zone_ids_are_found_and_would_fan_out(silver, lookup):
    twice = lookup((1, "Queens"), (1, "Queens"), (2, "Bronx"))
    assert rows(zones.zone_id_uniqueness(twice)) == [(3, 2, 1, False)]
    assert rows(zones.zone_id_uniqueness(lookup(*BOROUGHS))) == [(7, 7, 0, True)]
    assert zones.with_boroughs(silver({}), twice).count() == 2
    assert rows(demand.demand_by_borough(silver({}), twice)) == [("Queens", 2)]


def test_join_result_does_not_depend_on_broadcast(spark, silver, lookup):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    trips = silver(*[{"pu": n % 9, "do": n % 7} for n in range(200)])
    expected = sorted(rows(zones.with_boroughs(trips, lookup(*BOROUGHS))), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(rows(zones.with_boroughs(trips, lookup(*BOROUGHS))), key=str) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_totals_per_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    trips = cleaning.clean_trips(fixture.bronze_trips(spark, sf_dir))
    lookup = fixture.zones(spark, sf_dir)
    total = F.sum("ride_count")
    assert rows(demand.hourly_demand(trips).agg(total)) == [(7525,)]
    assert rows(demand.demand_by_borough(trips, lookup).agg(total)) == [(6137,)]
    assert rows(demand.popular_routes(trips, lookup).agg(total)) == [(4989,)]


def test_nulls_and_fine_distances_count_alike_in_both_forms(silver, lookup):
    trips = silver({"miles": 2.0, "seconds": 600}, {"miles": None, "seconds": 600}, {"miles": 0.00041, "seconds": None})
    rolled = demand.gold_from_rollup(demand.activity_rollup(trips), lookup(*BOROUGHS))
    assert rows(rolled["avg_distance"]) == rows(demand.avg_distance(trips)) == [(3, 2.00041 / 2)]
    assert rows(rolled["avg_duration"]) == rows(demand.avg_duration(trips)) == [(3, 10.0)]


def test_a_distance_that_is_no_number_shows_in_the_average(silver, lookup):
    trips = silver({"miles": 2.0}, {"miles": float("nan")})
    rolled = demand.gold_from_rollup(demand.activity_rollup(trips), lookup(*BOROUGHS))
    for table in (rolled["avg_distance"], demand.avg_distance(trips)):
        assert str(rows(table)[0][1]) == "nan"


def test_average_distance_is_that_of_the_exact_sum(silver, lookup):
    lists = {1: [1e-10, 1e-10], 2: [1e20, 0.1, 2.5], 3: [0.1] * 10, 4: [float("inf"), 1.0], 5: [float("inf"), float("-inf")], 6: [None], 7: [-0.1, 0.3]}
    trips = silver(*[{"pickup": f"2025-{m:02d}-01 10:00:00", "miles": x} for m, xs in lists.items() for x in xs])
    rolled = demand.gold_from_rollup(demand.activity_rollup(trips), lookup(*BOROUGHS))
    merged = demand.gold_from_rollup(demand.rollup_of_states(demand.month_states(trips)), lookup(*BOROUGHS))
    wanted = {m: math.fsum(xs) / len(xs) for m, xs in lists.items() if m not in (4, 5, 6)}
    for table in (rolled["avg_distance"], merged["avg_distance"], demand.avg_distance(trips.repartition(7))):
        answer = dict(rows(table))
        assert {m: answer[m] for m in wanted} == wanted
        assert answer[4] == float("inf") and str(answer[5]) == "nan" and answer[6] is None
