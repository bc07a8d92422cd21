"""Trial at a larger scale: ``python tools/scale_run.py <sf_dir> <copies> <work_dir>``.

Multiplies the derived trips (each copy moves to another time), gives a third of all rows one and the same trip key, writes
monthly raw files, runs raw to gold, and prints seconds and files per job.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bench import separate_tables  # noqa: E402
from kerbside.operators import demand  # noqa: E402
from kerbside.plans import jobs  # noqa: E402
from kerbside.registry import fixture  # noqa: E402
from kerbside.session import BASE_CONF  # noqa: E402
from kerbside.settings import LakeLayout, Period  # noqa: E402
from kerbside.sources.lake import read_table  # noqa: E402


def many_trips(trips: DataFrame, copies: int) -> DataFrame:
    seconds = F.pmod(F.xxhash64("copy", "tpep_pickup_datetime"), F.lit(86_400)).cast("int")
    copied = trips.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = F.col("copy") % 3 == 0
    moved = copied.withColumn("moved_by", seconds)
    time_of = {
        "tpep_pickup_datetime": "2025-06-01 08:00:00",
        "tpep_dropoff_datetime": "2025-06-01 08:20:00",
    }
    for name, fixed in time_of.items():
        later = F.timestamp_add("SECOND", F.col("moved_by"), F.col(name))
        moved = moved.withColumn(name, F.when(hot, F.lit(fixed).cast("timestamp_ntz")).otherwise(later))
    for name, fixed in {"PULocationID": 1, "DOLocationID": 2}.items():
        moved = moved.withColumn(name, F.when(hot, F.lit(fixed)).otherwise(F.col(name)))
    return moved.drop("copy", "moved_by").withColumn("fare_amount", F.round(F.col("trip_distance") * 2.5 + 3, 2))


def timed(label: str, job) -> None:
    start = time.perf_counter()
    result = job()
    print(f"{label}: {time.perf_counter() - start:.1f} s {result if result is not None else ''}", flush=True)


def files(path: str) -> str:
    found = list(Path(path).rglob("*.parquet"))
    return f"{len(found)} files, {sum(f.stat().st_size for f in found) / 2**20:.0f} MiB"


def main() -> None:
    sf_dir, copies, work = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    builder = SparkSession.builder.master("local[8]").appName("kerbside scale run")
    local = {
        "spark.sql.shuffle.partitions": "64",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.local.dir": f"{work}/local",
    }
    for key, value in {**BASE_CONF, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    lake = LakeLayout(f"{work}/lake")

    trips = many_trips(fixture.bronze_trips(spark, sf_dir), copies).withColumn(
        "m", F.coalesce(F.date_format("tpep_pickup_datetime", "yyyy-MM"), F.lit("2025-01"))
    )
    by_month = f"{work}/by_month"
    timed("make trips", lambda: trips.write.partitionBy("m").parquet(by_month))
    stray = [p.name[2:] for p in Path(by_month).glob("m=*") if p.name[2:] not in Period().months]
    for month in Period().months:
        take = [f"{by_month}/m={month}"] + ([f"{by_month}/m={m}" for m in stray] if month == "2025-01" else [])
        spark.read.parquet(*take).write.parquet(f"{lake.raw}/yellow_tripdata_{month}.parquet")
    zones = fixture.raw_zones(spark, sf_dir).toPandas()
    zones.to_csv(lake.zones, index=False, na_rep="")

    timed("bronze", lambda: jobs.build_bronze(spark, lake))
    print("  ", files(lake.bronze))
    timed("silver", lambda: jobs.build_silver(spark, lake))
    print("  ", files(lake.silver))
    timed("gold by one rollup", lambda: jobs.build_gold(spark, lake))
    silver = read_table(spark, lake.silver)
    lookup = fixture.zones(spark, sf_dir)
    timed("rollup alone", lambda: demand.activity_rollup(silver).write.format("noop").mode("overwrite").save())
    timed("six tables from six joined scans", lambda: separate_tables(silver, lookup))
    march = Period(Period().start.replace(month=3), Period().start.replace(month=4))
    timed("silver, March alone", lambda: jobs.build_silver(spark, lake, march, only_these_months=True))
    for name, check in (("silver", jobs.check_silver), ("gold", jobs.check_gold), ("layers", jobs.check_layers)):
        timed(f"check {name}", lambda check=check: [r.collect() for r in check(spark, lake).values()] and None)
    print(jobs.check_layers(spark, lake)["layers"].collect())
    spark.stop()


if __name__ == "__main__":
    main()
