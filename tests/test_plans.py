"""The plans that matter at scale: what is shuffled, what is joined, what reaches the scan."""

from __future__ import annotations

import re
from datetime import date

import pytest
from conftest import plan

from kerbside.operators import cleaning, demand, quality, views, zones
from kerbside.registry import fixture
from kerbside.registry.queries import QUERIES
from kerbside.settings import Period
from kerbside.sources.lake import read_bronze, read_table, write_bronze, write_silver
from kerbside.sources.monthly_files import read_monthly_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    trips = fixture.bronze_trips(spark, SF)
    for month in range(1, 13):
        mine = trips.filter(f"month(tpep_pickup_datetime) = {month}")
        mine.coalesce(1).write.parquet(f"{root}/raw/yellow_tripdata_2025-{month:02d}.parquet")
    write_bronze(read_monthly_files(spark, f"{root}/raw"), f"{root}/bronze")
    write_silver(cleaning.clean_trips(read_bronze(spark, f"{root}/bronze")), f"{root}/silver")
    return root


@pytest.fixture
def silver_table(spark, layers):
    return read_table(spark, f"{layers}/silver")


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", text)


def scanned_columns(text: str) -> set[str]:
    return {c.split(":")[0] for schema in re.findall(r"ReadSchema: struct<(.*?)>", text) for c in schema.split(",")}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_join_anywhere(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_cleaning_shuffles_once_and_combines_before_it(spark, layers):
    text = plan(cleaning.clean_trips(read_bronze(spark, f"{layers}/bronze", Period())))
    assert exchanges(text) == ["hashpartitioning"]
    above, below = text.split("Exchange hashpartitioning")
    assert "partial_min" in below and "partial_min" not in above


def test_cleaning_pushes_filters_to_the_scan(spark, layers):
    march = Period(date(2025, 3, 1), date(2025, 4, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        frame = cleaning.filtered_trips(read_bronze(spark, f"{layers}/bronze", march), march)
        details = plan(frame)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    partition_filters, pushed = re.search(r"PartitionFilters: \[(.*)\], PushedFilters: \[(.*)\]", details).groups()
    assert "source_month" in partition_filters and "stray" in partition_filters
    for condition in ("GreaterThan(trip_distance,0.0)", "LessThan(trip_distance,30.0)", "tpep_pickup_datetime"):
        assert condition in pushed
    assert exchanges(plan(frame)) == []


def test_a_month_of_bronze_reads_the_pickups_of_that_month(spark, layers):
    march = Period(date(2025, 3, 1), date(2025, 4, 1))
    picked_up = "tpep_pickup_datetime >= TIMESTAMP_NTZ'2025-03-01' AND tpep_pickup_datetime < TIMESTAMP_NTZ'2025-04-01'"
    wanted = read_bronze(spark, f"{layers}/bronze").filter(picked_up).count()
    assert read_bronze(spark, f"{layers}/bronze", march).count() == wanted > 0
    assert cleaning.clean_trips(read_bronze(spark, f"{layers}/bronze", march), march).count() == (
        cleaning.clean_trips(fixture.bronze_trips(spark, SF), march).count()
    )


def test_layers_prune_partitions(spark, silver_table):
    text = plan(silver_table.filter("pickup_month = DATE'2025-03-01'"))
    assert "PartitionFilters: [isnotnull(pickup_month" in text


@pytest.mark.parametrize(
    ("operator", "columns"),
    [
        (demand.hourly_demand, {"pickup_datetime"}),
        (demand.avg_duration, {"pickup_datetime", "duration_sec"}),
        (demand.avg_distance, {"pickup_datetime", "trip_distance"}),
        (demand.avg_passengers, {"pickup_datetime", "passenger_count"}),
    ],
)
def test_tables_without_boroughs_join_nothing_and_read_only_what_they_need(silver_table, operator, columns):
    text = plan(operator(silver_table))
    assert "Join" not in text
    assert scanned_columns(text) == columns
    # The average distance has a second exchange, of one row per month and size of distance.
    assert exchanges(text) == ["hashpartitioning"] * (2 if operator is demand.avg_distance else 1)
    assert "partial_count" in text


def test_boroughs_are_joined_after_counting(spark, silver_table):
    lookup = fixture.zones(spark, SF)
    for operator, ids, joins in (
        (demand.demand_by_borough, {"pickup_location_id"}, 1),
        (demand.popular_routes, {"pickup_location_id", "dropoff_location_id"}, 2),
    ):
        text = plan(operator(silver_table, lookup))
        trips_side = text[: text.index("ReadSchema: struct<pickup_location_id")]
        assert trips_side.count("BroadcastHashJoin") >= joins and "SortMergeJoin" not in text
        innermost = trips_side[trips_side.rindex("Exchange hashpartitioning(pickup_location_id") :]
        assert "partial_count" in innermost and "Join" not in innermost
        assert ids <= scanned_columns(text)


def test_row_level_lookup_is_broadcast_only_while_small(spark, silver_table):
    lookup = fixture.zones(spark, SF)
    assert plan(zones.with_boroughs(silver_table, lookup)).count("BroadcastHashJoin [pickup") >= 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(zones.with_boroughs(silver_table, lookup))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rollup_scans_silver_once(silver_table):
    text = plan(demand.activity_rollup(silver_table))
    assert text.count("FileScan") == 1 and exchanges(text) == ["hashpartitioning"]
    assert text.count("HashAggregate") == 2 and "Sort" not in text


def test_top_routes_never_sort_everything(spark, silver_table):
    table = demand.rides_per_place(silver_table, "pickup_location_id", "dropoff_location_id")
    routes = table.selectExpr("pickup_location_id AS Borough", "dropoff_location_id AS DO_Borough", "ride_count")
    text = plan(views.serve_popular_routes(routes))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_metrics_take_one_scan(silver_table):
    text = plan(quality.silver_gate(quality.silver_metrics(silver_table)))
    assert text.count("FileScan") == 1 and text.count("HashAggregate") == 2


def test_funnel_takes_one_scan_and_hash_aggregates(spark, layers):
    text = plan(cleaning.cleaning_funnel(read_bronze(spark, f"{layers}/bronze")))
    assert text.count("FileScan") == 1 and "SortAggregate" not in text
    assert sorted(exchanges(text)) == ["SinglePartition", "hashpartitioning"]


def test_monthly_files_are_read_once_each_and_not_shuffled(spark, layers):
    text = plan(read_monthly_files(spark, f"{layers}/raw"))
    assert text.count("FileScan") == 12 and exchanges(text) == [] and "regexp" not in text
