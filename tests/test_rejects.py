from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from kerbside.operators import cleaning, rejects
from kerbside.plans import jobs
from kerbside.registry import fixture
from kerbside.settings import LakeLayout
from kerbside.sources.lake import read_table, write_bronze

SF = "/root/testdata/sf0.001"


def test_bits_of_every_rule(bronze):
    cases = [
        ({}, 0),
        ({"pickup": "2026-01-01 00:00:00", "dropoff": "2026-01-01 00:10:00"}, 1),
        ({"pickup": None}, 1 | 2 | 8),
        ({"dropoff": "2025-03-01 09:59:00"}, 2 | 8),
        ({"dropoff": "2025-03-01 09:59:01"}, 8),  # repaired to the pickup: a trip of no time
        ({"miles": -1.0}, 4 | 16),
        ({"miles": None}, 4 | 16),
        ({"miles": float("nan")}, 16),
        ({"miles": 0.0}, 16),
        ({"dropoff": "2025-03-01 12:00:00", "miles": 30.0}, 8 | 16),
        ({"passengers": None}, 0),
    ]
    marked = rejects.with_reject_reasons(bronze(*[case for case, _ in cases]).coalesce(1))
    assert [r.reject_reasons for r in marked.collect()] == [bits for _, bits in cases]


def test_reasons_account_for_the_funnel(spark):
    trips = fixture.bronze_trips(spark, SF)
    marked = rejects.with_reject_reasons(trips)
    funnel = {r.step: r.row_count for r in cleaning.cleaning_funnel(trips).collect()}
    steps = ["bronze", "in_period", "duration_valid", "distance_valid", "duration_usual", "distance_usual"]
    dropped = {r.reason: r.dropped_here for r in rejects.reject_counts(marked).collect()}
    assert list(dropped.values()) == [funnel[a] - funnel[b] for a, b in zip(steps, steps[1:])]
    kept = marked.filter("reject_reasons = 0").drop("reject_reasons")
    wanted = cleaning.filtered_trips(trips).select(kept.columns)
    assert kept.exceptAll(wanted).count() == wanted.exceptAll(kept).count() == 0
    assert {r.dropped_here for r in rejects.reject_counts(marked.limit(0)).collect()} == {0}


def test_marked_trips_are_stored_apart(spark, tmp_path):
    lake = LakeLayout(str(tmp_path))
    trips = fixture.bronze_trips(spark, SF)
    write_bronze(trips.withColumn("source_month", F.date_trunc("month", F.lit("2025-01-01").cast("date")).cast("date")), lake.bronze)
    assert jobs.build_marked(spark, lake) == jobs.build_marked(spark, lake) == 1050
    stored = read_table(spark, lake.marked)
    assert dict(rows(stored.groupBy("rejected").count())) == {0: 806, 1: 244}
    reports = jobs.check_rejects(spark, lake)
    assert sum(r.dropped_here for r in reports["reasons"].collect()) == 244 and reports["sample"].count() == 5
