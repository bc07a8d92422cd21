from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.operators import quality
from kerbside.schemas import SILVER_TRIPS
from kerbside.sources.monthly_files import expected_months, pickup_month_counts


def test_metrics_count_each_fault(silver):
    bad = silver(
        {"seconds": -1}, {"seconds": None}, {"seconds": 7200}, {"seconds": 7201},
        {"miles": 0.0}, {"miles": None}, {"miles": 30.0}, {"miles": 30.5},
        {"passengers": -1}, {"passengers": None}, {"passengers": 0},
    )
    found = quality.silver_metrics(bad).first().asDict()
    assert found == {
        "min_duration": -1, "max_duration": 7201, "negative_duration": 1, "invalid_distance": 1,
        "negative_passengers": 1, "very_long_duration": 1, "very_long_distance": 1, "null_duration": 1,
        "null_distance": 1, "null_passengers": 1, "zero_passengers": 1,
    }


def test_gate_passes_good_silver_and_empty_silver(silver):
    quality.enforce(quality.silver_gate(quality.silver_metrics(silver({}))))
    quality.enforce(quality.silver_gate(quality.silver_metrics(silver({}).limit(0))))


@pytest.mark.parametrize(
    ("fault", "check"),
    [
        ({"seconds": -5}, "negative_duration"),
        ({"miles": 0.0}, "invalid_distance"),
        ({"seconds": None}, "null_duration"),
        ({"miles": None}, "null_distance"),
    ],
)
def test_gate_names_what_failed(silver, fault, check):
    gate = quality.silver_gate(quality.silver_metrics(silver({}, fault)))
    assert {r.check_name for r in gate.collect() if not r.passed} == {check}
    with pytest.raises(quality.QualityError, match=rf"{check} \(1 rows\)"):
        quality.enforce(gate)


@pytest.mark.parametrize("harmless", [{"passengers": -1}, {"seconds": 9000}, {"miles": 99.0}, {"passengers": None}])
def test_gate_lets_other_faults_through(silver, harmless):
    quality.enforce(quality.silver_gate(quality.silver_metrics(silver(harmless))))


def test_profile_counts_nulls(bronze):
    profile = quality.table_profile(bronze({}, {"pickup": None}, {"miles": None, "pickup": None})).first().asDict()
    assert profile["row_count"] == 3 and profile["column_count"] == 6
    assert profile["null_tpep_pickup_datetime"] == 2 and profile["null_trip_distance"] == 1


def test_sample_is_the_same_every_time(bronze):
    trips = bronze(*[{"pu": n} for n in range(40)])
    samples = {tuple(rows(quality.sample(trips.repartition(n)))) for n in (1, 5, 9)}
    assert len(samples) == 1 and len(samples.pop()) == 5


def test_null_profile_and_row_counts(spark):
    tables = {
        "a": spark.createDataFrame([(1, None), (2, "x")], "n INT, s STRING"),
        "b": spark.createDataFrame([], "m INT"),
    }
    assert sorted(rows(quality.null_profile(tables))) == [("a", "n", 2, 0), ("a", "s", 2, 1), ("b", "m", 0, 0)]
    assert sorted(rows(quality.row_counts(tables))) == [("a", 2), ("b", 0)]


def test_hours_present(spark):
    hours = spark.createDataFrame([(0, 1), (23, 1)], "hour INT, ride_count LONG")
    assert [h for h, there in rows(quality.hours_present(hours)) if there] == [0, 23]
    assert quality.hours_present(hours).count() == 24


def test_nonpositive_routes(spark):
    data = [("A", "B", 0), ("A", "C", 1), ("A", "D", -3)]
    routes = spark.createDataFrame(data, "Borough STRING, DO_Borough STRING, ride_count LONG")
    assert {r[1] for r in rows(quality.nonpositive_routes(routes))} == {"B", "D"}


def _rides(spark, *counts):
    return spark.createDataFrame([("Q", c) for c in counts], "Borough STRING, ride_count LONG")


def test_gold_totals(spark):
    hourly, borough, routes = _rides(spark, 5, 6), _rides(spark, 9), _rides(spark, 4, 4)
    assert rows(quality.gold_totals(hourly, borough, routes)) == [(11, 9, 8, True)]
    assert rows(quality.gold_totals(routes, borough, hourly)) == [(8, 9, 11, False)]


def test_gold_totals_recheck_leaves_placeholders_out(spark):
    borough = spark.createDataFrame([("Queens", 3), ("Unknown", 4), ("N/A", 5)], "Borough STRING, ride_count LONG")
    assert rows(quality.recheck_boroughs(borough)) == [("Queens", 3)]


def test_layers(spark, silver):
    silver_rows, bronze_rows = silver({}, {}, {}), silver({}, {}, {}, {})
    report = quality.layer_reconciliation(bronze_rows, silver_rows, _rides(spark, 1, 2))
    assert rows(report) == [(4, 3, 1, 25.0, True, 3, True)]
    report = quality.layer_reconciliation(silver_rows, silver_rows, _rides(spark, 1))
    assert rows(report) == [(3, 3, 0, 0.0, False, 1, False)]


def test_layers_on_empty_input_give_null_not_failure(spark, silver):
    nothing = silver({}).limit(0)
    report = quality.layer_reconciliation(nothing, nothing, _rides(spark, 1).limit(0))
    assert rows(report) == [(0, 0, 0, None, False, 0, True)]


def test_schema_report(silver):
    odd = silver({}).withColumn("trip_distance", F.col("trip_distance").cast("float")).drop("duration_sec")
    odd = odd.withColumn("fare", F.lit(None).cast("double"))
    report = {r.column_name: r for r in quality.schema_report({"silver": odd}, {"silver": SILVER_TRIPS}).collect()}
    assert report["pickup_datetime"].type_ok and report["pickup_datetime"].null_count == 0
    assert not report["trip_distance"].type_ok and report["trip_distance"].actual_type == "float"
    assert not report["duration_sec"].type_ok and report["duration_sec"].actual_type is None
    assert report["fare"].type_ok and report["fare"].expected_type is None and report["fare"].null_count == 1


def test_month_coverage(spark, bronze):
    trips = bronze({}, {"pickup": "2025-12-31 23:00:00"}, {"pickup": "2031-01-01 00:00:00"}, {"pickup": None})
    coverage = rows(quality.month_coverage(pickup_month_counts(trips), expected_months(spark)))
    assert len(coverage) == 12 and coverage[2] == ("2025-03", 1, False) and coverage[11] == ("2025-12", 1, False)
    assert sum(missing for _, _, missing in coverage) == 10
