"""Benchmark: the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is planned and run in full into Spark's ``noop`` sink, best of ``$BENCH_RUNS`` passes over
all queries after one warm-up pass.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kerbside.functions import known_borough  # noqa: E402
from kerbside.operators import demand  # noqa: E402
from kerbside.operators.cleaning import clean_trips  # noqa: E402
from kerbside.operators.zones import with_boroughs  # noqa: E402
from kerbside.registry import fixture  # noqa: E402
from kerbside.registry.queries import QUERIES  # noqa: E402
from kerbside.session import BASE_CONF  # noqa: E402

HEADLINE = (
    "silver_clean_trips",
    "silver_funnel",
    "trips_with_boroughs",
    "gold_hourly_demand",
    "gold_demand_by_borough",
    "gold_popular_routes",
    "gold_avg_duration",
    "gold_avg_distance",
    "gold_avg_passengers",
    "gold_base_rollup",
    "serve_popular_routes",
    "dash_monthly_averages",
    "dq_silver_metrics",
    "dq_layer_reconciliation",
)


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def separate_tables(silver: DataFrame, lookup: DataFrame) -> None:
    """The six gold tables one after the other, each from its own scan of the joined trips.

    This is the plan shape that the measured baseline has, kept as small as it is there.
    """
    joined = with_boroughs(silver, lookup)
    known, known_end = known_borough(F.col("Borough")), known_borough(F.col("DO_Borough"))
    month, rides = F.month("pickup_datetime").alias("month"), F.count("*").alias("ride_count")
    for table in (
        joined.groupBy(F.hour("pickup_datetime").alias("hour")).agg(rides).orderBy("hour"),
        joined.filter(known).groupBy("Borough").agg(rides).orderBy(F.desc("ride_count")),
        joined.filter(known & known_end).groupBy("Borough", "DO_Borough").agg(rides).orderBy(F.desc("ride_count")),
        joined.groupBy(month).agg(F.avg("duration_sec") / 60).orderBy("month"),
        joined.groupBy(month).agg(F.avg("trip_distance")).orderBy("month"),
        joined.filter("passenger_count > 0").groupBy(month).agg(F.avg("passenger_count")).orderBy("month"),
    ):
        table.write.format("noop").mode("overwrite").save()


def shared_rollup(silver: DataFrame, lookup: DataFrame) -> None:
    """The six gold tables from one stored rollup."""
    path = _work_folder(silver.sparkSession, "rollup")
    demand.activity_rollup(silver).write.parquet(path)
    for table in demand.gold_from_rollup(silver.sparkSession.read.parquet(path), lookup).values():
        table.write.format("noop").mode("overwrite").save()


def _work_folder(spark: SparkSession, name: str) -> str:
    return f"{os.environ.get('BENCH_WORK_DIR', spark.conf.get('spark.sql.warehouse.dir'))}/bench-{name}-{uuid.uuid4().hex}"


def six_tables(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """Seconds for all six gold tables from stored silver, in both shapes."""
    path = _work_folder(spark, "silver")
    clean_trips(fixture.bronze_trips(spark, sf_dir)).write.parquet(path)
    silver, lookup = spark.read.parquet(path), fixture.zones(spark, sf_dir)

    def best(build) -> float:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            build(silver, lookup)
            times.append(time.perf_counter() - start)
        return round(min(times[1:]), 3)

    return {"separate_joined_scans": best(separate_tables), "shared_rollup": best(shared_rollup)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("kerbside bench")
    local = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    for key, value in {**BASE_CONF, **local, "spark.ui.showConsoleProgress": "false"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    passes = [{name: seconds(spark, name, sf_dir) for name in HEADLINE} for _ in range(runs + 1)]
    taken = {name: round(min(done[name] for done in passes[1:]), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(taken.values()), 3),
                "unit": "sec",
                "queries": taken,
                "six_gold_tables_from_silver": six_tables(spark, sf_dir, runs),
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
