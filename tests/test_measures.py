"""Counts that the writes of layers store, against counts of the layers themselves."""

from __future__ import annotations

import glob
import shutil
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_lake import MARCH, SF, built, built_files, lake, raw_files, same  # noqa: F401

from kerbside.operators import quality
from kerbside.plans import jobs
from kerbside.registry import fixture
from kerbside.sources.lake import aligned_with_bronze, layer_measures, read_bronze, read_table, replace_bronze_month
from kerbside.sources.measures import stored_measures


def break_files(layer):
    for file in glob.glob(f"{layer}/**/*.parquet", recursive=True):
        with open(file, "r+b") as out:
            out.truncate(3)


def test_layers_are_compared_without_reading_them_and_a_tampered_gold_fails(spark, built):  # noqa: F811
    jobs.build_gold(spark, built)
    break_files(built.bronze)
    break_files(built.silver)
    assert rows(jobs.check_layers(spark, built)["layers"])[0][:3] == (1050, 764, 286)
    assert rows(jobs.check_layers(spark, built)["layers"])[0][-2:] == (764, True)
    hourly = read_table(spark, built.gold("hourly_demand"))
    tampered = spark.createDataFrame([(h, n + (h == 7)) for h, n in rows(hourly)], hourly.schema)
    tampered.write.mode("overwrite").parquet(built.gold("hourly_demand"))
    assert rows(jobs.check_layers(spark, built)["layers"])[0][-2:] == (765, False)


def test_bronze_is_checked_without_reading_it(spark, built):  # noqa: F811
    """Also after a month is replaced, with a column that the others lack."""
    april = date(2025, 4, 1)
    own = fixture.bronze_trips(spark, SF).limit(20).withColumn("source_month", F.lit(april))
    own = own.withColumn("fee", F.when(F.col("passenger_count") > 2, 1.5))
    replace_bronze_month(aligned_with_bronze(own, built.bronze), built.bronze, april)
    bronze = read_bronze(spark, built.bronze)
    wanted = rows(quality.table_profile(bronze))
    trips = [tuple(r) for r in bronze.collect()]
    break_files(built.bronze)
    reports = jobs.check_bronze(spark, built)
    assert rows(reports["profile"]) == wanted and reports["profile"].columns[-1] == "null_fee"
    nulls = {r.column_name: r.null_count for r in reports["schema"].collect()}
    assert nulls["fee"] == wanted[0][-1] > len(trips) - 20 and all(r.type_ok for r in reports["schema"].collect())
    shown = rows(reports["sample"])
    assert len(shown) == 5 == len(set(shown)) and set(shown) <= set(trips) and reports["sample"].schema == bronze.schema
    months = {r.month: (r.row_count, r.missing) for r in reports["months"].collect()}
    assert months["2025-04"] == (20, False) and sum(n for n, _ in months.values()) == len(trips)


def test_files_that_are_not_there_are_missing_and_empty_ones_are_not(spark, lake):  # noqa: F811
    for month in ("2025-05", "2025-06"):
        shutil.rmtree(f"{lake.raw}/yellow_tripdata_{month}.parquet")
    jobs.build_bronze(spark, lake)
    june = fixture.bronze_trips(spark, SF).limit(0).withColumn("source_month", F.lit(date(2025, 6, 1)))
    replace_bronze_month(june, lake.bronze, date(2025, 6, 1))
    months = {r.month: (r.row_count, r.missing) for r in jobs.check_bronze(spark, lake)["months"].collect()}
    assert months["2025-05"] == (0, True) and months["2025-06"] == (0, False)
    assert [m for m, (_, missing) in months.items() if missing] == ["2025-05"]


@pytest.mark.parametrize("layer, column", [("bronze", "source_month"), ("silver", "pickup_month")])
def test_a_month_without_stored_counts_is_measured_from_its_files(spark, built, layer, column):  # noqa: F811
    path = getattr(built, layer)
    stored = stored_measures(spark, path)
    assert len(stored) == 12 and layer_measures(spark, path, column).keys() == stored.keys()
    shutil.rmtree(f"{path}_measures")
    scanned = layer_measures(spark, path, column)
    assert {m: s.counts for m, s in scanned.items()} == {m: s.counts for m, s in stored.items()}


def test_a_replaced_month_replaces_its_counts_alone(spark, built):  # noqa: F811
    before = {m: s.counts for m, s in stored_measures(spark, built.silver).items()}
    jobs.build_silver(spark, built, MARCH, only_these_months=True)
    assert {m: s.counts for m, s in stored_measures(spark, built.silver).items()} == before


def test_gold_of_several_years_declares_the_year(spark, built):  # noqa: F811
    trips = spark.read.parquet(f"{built.raw}/yellow_tripdata_2025-03.parquet").limit(30)
    later = trips.withColumns({c: F.expr(f"{c} + INTERVAL '1' YEAR") for c in trips.columns if c.endswith("datetime")})
    later.write.parquet(f"{built.raw}/yellow_tripdata_2026-03.parquet")
    march_2026 = jobs.Period(date(2026, 3, 1), date(2026, 4, 1))
    jobs.build_bronze(spark, built, march_2026, only_these_months=True)
    jobs.build_silver(spark, built, march_2026, only_these_months=True)
    jobs.build_gold(spark, built)
    report = jobs.check_gold(spark, built)["schema"].collect()
    years = {r.table_name: (r.expected_type, r.type_ok) for r in report if r.column_name == "year"}
    assert years == {t: ("int", True) for t in ("avg_duration", "avg_distance", "avg_passengers")}
    assert all(r.type_ok for r in report)
