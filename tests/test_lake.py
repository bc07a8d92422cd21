from __future__ import annotations

import glob
import json
import shutil
import subprocess
import sys
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import ROOT, rows
from pyspark.sql import functions as F

from kerbside.operators import cleaning, demand
from kerbside.operators.quality import QualityError
from kerbside.plans import jobs
from kerbside.registry import fixture
from kerbside.schemas import BRONZE_TRIPS
from kerbside.settings import GOLD_TABLES, LakeLayout, Period
from kerbside.sources.lake import (
    aligned_with_bronze,
    layer_measures,
    read_bronze,
    read_silver,
    read_table,
    replace_bronze_month,
    replace_silver_month,
    replace_silver_months,
    schema_if_present,
    stored_schemas,
)
from kerbside.sources.monthly_files import conform, found_months, read_monthly_files
from kerbside.sources.zone_file import read_zones

SF = "/root/testdata/sf0.001"
MARCH = Period(date(2025, 3, 1), date(2025, 4, 1))


def month_file(lake, month):
    return f"{lake.raw}/yellow_tripdata_{month}.parquet"


def put_months(trips, lake, months):
    """Raw files by pickup month; what belongs to none of them goes into the first file as strays."""
    of = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    for n, month in enumerate(months):
        mine = of == month
        if n == 0:
            mine = mine | of.isNull() | ~of.isin(*months)
        trips.filter(mine).coalesce(1).write.mode("overwrite").parquet(month_file(lake, month))


@pytest.fixture(scope="module")
def raw_files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw_files")
    layout = LakeLayout(str(root))
    put_months(fixture.bronze_trips(spark, SF), layout, Period().months)
    raw = fixture.raw_zones(spark, SF).select("LocationID", "Borough", F.lit("z, 1").alias("Zone"))
    lines = ["LocationID,Borough,Zone"] + [f'{i},{b},"{z}"' for i, b, z in rows(raw)]
    (root / "raw" / "taxi_zone_lookup.csv").write_text("\n".join(lines) + "\n")
    return layout


@pytest.fixture
def lake(raw_files, tmp_path):
    shutil.copytree(raw_files.raw, tmp_path / "raw")
    return LakeLayout(str(tmp_path))


@pytest.fixture(scope="module")
def built_files(spark, raw_files):
    jobs.build_bronze(spark, raw_files)
    jobs.build_silver(spark, raw_files)
    return raw_files


@pytest.fixture
def built(built_files, tmp_path):
    """A lake of its own with bronze and silver in place."""
    for layer in ("raw", "bronze", "silver"):
        shutil.copytree(f"{built_files.root}/{layer}", tmp_path / layer)
    return LakeLayout(str(tmp_path))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_whole_way_through(spark, lake):
    assert jobs.build_bronze(spark, lake) == 1050
    assert same(read_bronze(spark, lake.bronze), fixture.bronze_trips(spark, SF))
    assert jobs.build_silver(spark, lake) == 764
    silver = read_silver(spark, lake.silver).drop("pickup_month")
    assert same(silver, cleaning.clean_trips(fixture.bronze_trips(spark, SF)).select(silver.columns))
    written = jobs.build_gold(spark, lake)
    assert written["hourly_demand"] == 24 and written["popular_routes"] == 25 and written["avg_distance"] == 12
    lookup = fixture.zones(spark, SF)
    assert rows(jobs.serve(spark, lake, "hourly-demand")) == sorted(rows(demand.hourly_demand(silver)))
    assert same(jobs.read_gold(spark, lake)["popular_routes"], demand.popular_routes(silver, lookup))
    assert jobs.serve(spark, lake, "popular-routes").count() == 20
    assert jobs.serve(spark, lake, "dash-monthly-averages").count() == 12
    for checks in (jobs.check_bronze, jobs.check_silver, jobs.check_gold, jobs.check_layers):
        reports = {name: rows(report) for name, report in checks(spark, lake).items()}
        assert all(reports[n] for n in reports if n != "nonpositive_routes")
        if "schema" in reports:
            assert all(r[4] for r in reports["schema"]), reports["schema"]
        if "layers" in reports:
            assert reports["layers"][0][:3] == (1050, 764, 286) and reports["layers"][0][-1]


def test_running_everything_twice_changes_nothing(spark, lake):
    for _ in range(2):
        assert jobs.build_bronze(spark, lake) == 1050
        assert jobs.build_silver(spark, lake) == 764
        jobs.build_gold(spark, lake)
    assert read_bronze(spark, lake.bronze).count() == 1050
    assert read_table(spark, lake.silver).count() == 764
    assert sum(r[1] for r in rows(jobs.serve(spark, lake, "hourly-demand"))) == 764


def test_replacing_a_month_leaves_the_others(spark, built):
    before = read_table(spark, built.silver).cache()
    in_march = before.filter("pickup_month = DATE'2025-03-01'").count()
    assert before.count() == 764 and in_march > 1
    # Rebuilding the month from unchanged files gives the same rows.
    jobs.build_bronze(spark, built, MARCH, only_these_months=True)
    assert jobs.build_silver(spark, built, MARCH, only_these_months=True) == in_march
    assert same(read_table(spark, built.silver), before)
    # A corrected file replaces its own rows, here by two trips, one of which is a stray pickup of May.
    base = fixture.bronze_trips(spark, SF).limit(1).drop("tpep_pickup_datetime", "tpep_dropoff_datetime")
    fixed = base.selectExpr(
        "explode(array(TIMESTAMP_NTZ'2025-03-05 08:00:00', TIMESTAMP_NTZ'2025-05-05 08:00:00')) AS tpep_pickup_datetime",
        "tpep_pickup_datetime + INTERVAL '5' MINUTE AS tpep_dropoff_datetime",
        "1L AS passenger_count", "2.0D AS trip_distance", "1 AS PULocationID", "2 AS DOLocationID",
    )
    fixed.write.mode("overwrite").parquet(month_file(built, "2025-03"))
    jobs.build_bronze(spark, built, MARCH, only_these_months=True)
    assert jobs.build_silver(spark, built, MARCH, only_these_months=True) == 1
    after = read_table(spark, built.silver)
    assert same(after.filter("pickup_month <> DATE'2025-03-01'"), before.filter("pickup_month <> DATE'2025-03-01'"))
    assert jobs.build_silver(spark, built) == 764 - in_march + 2
    before.unpersist()


def test_replacing_a_month_with_nothing_empties_it(spark, built):
    read_monthly_files(spark, built.raw, MARCH).limit(0).drop("source_month").write.mode("overwrite").parquet(
        month_file(built, "2025-03-empty")
    )
    spark.read.parquet(month_file(built, "2025-03-empty")).write.mode("overwrite").parquet(month_file(built, "2025-03"))
    jobs.build_bronze(spark, built, MARCH, only_these_months=True)
    assert jobs.build_silver(spark, built, MARCH, only_these_months=True) == 0
    assert read_table(spark, built.silver).filter("pickup_month = DATE'2025-03-01'").count() == 0


def test_first_build_may_be_a_single_month(spark, lake):
    assert jobs.build_bronze(spark, lake, MARCH, only_these_months=True) > 0
    assert jobs.build_silver(spark, lake, MARCH, only_these_months=True) > 0


def test_missing_months_are_reported_and_do_not_stop_the_rest(spark, tmp_path):
    lake = LakeLayout(str(tmp_path))
    put_months(fixture.bronze_trips(spark, SF), lake, ["2025-02", "2025-11"])
    assert jobs.build_bronze(spark, lake) == 1050
    coverage = {r.month: r.missing for r in jobs.check_bronze(spark, lake)["months"].collect()}
    assert len(coverage) == 12 and {m for m, gone in coverage.items() if not gone} == {"2025-02", "2025-11"}


def test_no_month_at_all_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_monthly_files(spark, str(tmp_path))


def test_a_broken_file_is_an_error_not_a_missing_month(spark, tmp_path):
    lake = LakeLayout(str(tmp_path))
    put_months(fixture.bronze_trips(spark, SF), lake, ["2025-02"])
    (tmp_path / "raw" / "yellow_tripdata_2025-03.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception, match="2025-03"):
        jobs.build_bronze(spark, lake)


def test_types_that_drift_between_months(spark, tmp_path):
    lake = LakeLayout(str(tmp_path))
    trips = fixture.bronze_trips(spark, SF)
    put_months(trips, lake, ["2025-01", "2025-02", "2025-03"])
    drifted = read_monthly_files(spark, lake.raw, MARCH).drop("source_month")
    drifted = drifted.select(
        F.col("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime"),
        F.col("passenger_count").cast("double"),
        F.col("trip_distance"),
        F.col("PULocationID").cast("long").alias("pulocationid"),
        F.col("DOLocationID").cast("long"),
        F.lit(1.25).alias("airport_fee"),
    ).coalesce(1)
    drifted.write.parquet(month_file(lake, "2025-04"))
    period = Period(date(2025, 1, 1), date(2025, 5, 1))
    read = read_monthly_files(spark, lake.raw, period)
    assert {f.name: f.dataType for f in read.schema}.items() >= {f.name: f.dataType for f in BRONZE_TRIPS}.items()
    assert read.count() == 1050 + drifted.count()
    by_month = dict(rows(read.groupBy("source_month").agg(F.count("airport_fee"))))
    assert by_month[date(2025, 4, 1)] == drifted.count() and by_month[date(2025, 1, 1)] == 0
    assert jobs.build_bronze(spark, lake, period) == read.count()
    assert "airport_fee" in read_bronze(spark, lake.bronze).columns


def test_a_later_month_is_aligned_with_stored_bronze(spark, tmp_path):
    lake = LakeLayout(str(tmp_path))
    trips = fixture.bronze_trips(spark, SF).withColumn("fee", F.lit(1.5))
    put_months(trips, lake, ["2025-02"])
    jobs.build_bronze(spark, lake)
    put_months(trips.withColumn("Fee", F.lit(2)).withColumn("tip", F.lit(3)), lake, ["2025-03"])
    jobs.build_bronze(spark, lake, MARCH, only_these_months=True)
    bronze = read_bronze(spark, lake.bronze)
    assert bronze.agg(F.sum("fee"), F.sum("tip")).first() == (1050 * 3.5, 1050 * 3)


def test_a_file_without_a_needed_column_is_an_error(spark):
    with pytest.raises(ValueError, match="trip_distance"):
        conform(fixture.bronze_trips(spark, SF).drop("trip_distance"))


def test_zone_file_by_header_and_literal_na(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"Borough","LocationID","Zone"\n"N/A",264,"x"\n"Queens",7,"a, b"\n')
    zones = read_zones(spark, str(path))
    assert zones.dtypes == [("zone_LocationID", "int"), ("Borough", "string")]
    assert sorted(rows(zones)) == [(7, "Queens"), (264, "N/A")]


def test_repeated_zone_ids_stop_the_gold_build(spark, built):
    with open(built.zones, "a") as file:
        file.write('3,Twice,"x"\n')
    with pytest.raises(QualityError, match="zone_id_unique"):
        jobs.build_gold(spark, built)


def test_silver_files_do_not_multiply(spark, built):
    per_month = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{built.silver}/pickup_month=*")]
    assert len(per_month) == 12 and max(per_month) == 1


def test_schema_if_present(spark, tmp_path):
    assert schema_if_present(spark, str(tmp_path / "nowhere")) is None


@pytest.mark.parametrize("period", [(date(2025, 1, 2), date(2025, 2, 1)), (date(2025, 2, 1), date(2025, 2, 1))])
def test_periods_are_whole_months(period):
    with pytest.raises(ValueError):
        Period(*period)


def test_period_months():
    period = Period(date(2024, 11, 1), date(2025, 3, 1))
    assert period.months == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert [m.months for m in period.each_month()] == [[m] for m in period.months]


def test_command_line(spark, built):
    def run(*args):
        command = [sys.executable, "-m", "kerbside", *args, "--lake", built.root]
        done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout

    out = run("gold")
    assert {line.split()[0] for line in out.splitlines() if line.endswith(tuple("0123456789"))} >= set(GOLD_TABLES)
    first = json.loads(run("serve", "--view", "popular-routes").splitlines()[0])
    assert set(first) == {"from", "to", "ride_count"}


def test_a_column_of_some_months_only_keeps_bronze_readable(spark, lake):
    """February brings a column that January lacks, March another type of it."""
    trips = fixture.bronze_trips(spark, SF).limit(20)
    jobs.build_bronze(spark, lake)
    for month, kind in ((2, "double"), (3, "bigint")):
        day = date(2025, month, 1)
        own = trips.withColumn("source_month", F.lit(day)).withColumn("fee", F.lit(5).cast(kind))
        replace_bronze_month(aligned_with_bronze(own, lake.bronze), lake.bronze, day)
    assert dict(read_bronze(spark, lake.bronze).dtypes)["fee"] == "double"
    assert read_bronze(spark, lake.bronze).filter("fee = 5").count() == 40


def test_columns_come_change_type_and_vanish_and_no_footer_is_opened_to_plan(spark, lake, tmp_path):
    trips = fixture.bronze_trips(spark, SF).limit(20)
    jobs.build_bronze(spark, lake)
    kinds = {4: "bigint", 5: "double", 6: None, 7: "string"}
    for month, kind in kinds.items():
        day = date(2025, month, 1)
        own = trips.withColumn("source_month", F.lit(day))
        own = own.withColumn("Fee", F.lit("7.5" if kind == "string" else 7).cast(kind)) if kind else own
        replace_bronze_month(own, lake.bronze, day)
    schemas = stored_schemas(spark, lake.bronze)
    assert {m.month: s["Fee"].dataType.simpleString() for m, s in schemas.items() if "Fee" in s.names} == {4: "bigint", 5: "double", 7: "string"}
    bronze = read_bronze(spark, lake.bronze)
    # A number beside text is text; a month without the column has nulls.
    assert dict(bronze.dtypes)["Fee"] == "string" and bronze.filter("Fee IS NOT NULL").count() == 60
    assert bronze.filter("CAST(Fee AS DOUBLE) = 7").count() == 40 and bronze.columns[:6] == BRONZE_TRIPS.names
    text = bronze._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 4
    # With all footers broken planning still works: it lists files and reads the schema table.
    for file in glob.glob(f"{lake.bronze}/**/*.parquet", recursive=True):
        with open(file, "r+b") as out:
            out.truncate(3)
    assert read_bronze(spark, lake.bronze, MARCH).columns == bronze.columns


def test_a_month_without_stored_schema_is_read_from_its_files(spark, lake):
    jobs.build_bronze(spark, lake)
    before = read_bronze(spark, lake.bronze)
    schema = before.schema
    shutil.rmtree(f"{lake.bronze}_schemas")
    assert read_bronze(spark, lake.bronze).schema == schema and read_bronze(spark, lake.bronze).count() == 1050


def scanned_rows(frame):
    """Rows that came out of the scans of a query, after what Parquet's bounds skip."""
    frame.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run = frame._jdf.queryExecution()
        run.toRdd().count()
        leaves = run.executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        frame.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def many_trips(spark, rows=600_000):
    """Trips of every minute of March, in no order."""
    start = "timestampadd(SECOND, CAST(pmod(id * 7919, 2678400) AS INT), TIMESTAMP_NTZ'2025-03-01 00:00:00')"
    return spark.range(rows).selectExpr(
        f"{start} AS tpep_pickup_datetime", f"timestampadd(SECOND, 600, {start}) AS tpep_dropoff_datetime",
        "1L AS passenger_count", "CAST(1 + id % 20 AS DOUBLE) AS trip_distance", "CAST(id % 27 AS INT) AS PULocationID",
        "CAST(id % 25 AS INT) AS DOLocationID",
    )


def test_a_read_of_one_day_skips_the_rest_of_the_month(spark, tmp_path):
    trips = many_trips(spark).repartition(2)
    replace_silver_month(cleaning.clean_trips(trips, MARCH), str(tmp_path / "silver"), MARCH.start)
    day, following = date(2025, 3, 12), date(2025, 3, 13)
    silver = read_silver(spark, str(tmp_path / "silver"), day, following)
    wanted = read_silver(spark, str(tmp_path / "silver")).filter("CAST(pickup_datetime AS DATE) = DATE'2025-03-12'")
    assert same(silver, wanted) and silver.count() > 15_000
    month = read_silver(spark, str(tmp_path / "silver")).count()
    assert scanned_rows(silver.select("trip_distance")) < 0.1 * month


def test_strays_are_skipped_by_their_days(spark, tmp_path):
    """A file of February full of pickups in March: a build of one other month reads next to nothing of it."""
    path = str(tmp_path / "bronze")
    trips = many_trips(spark).coalesce(2).withColumn("source_month", F.lit(date(2025, 2, 1)))
    replace_bronze_month(trips, path, date(2025, 2, 1))
    april = Period(date(2025, 4, 1), date(2025, 5, 1))
    assert read_bronze(spark, path, MARCH).count() == 600_000 and read_bronze(spark, path, april).count() == 0
    assert scanned_rows(read_bronze(spark, path, april).select("trip_distance")) == 0


def gold_rows(spark, lake):
    return {name: sorted(rows(table), key=repr) for name, table in jobs.read_gold(spark, lake).items()}


def test_gold_of_a_changed_month_scans_that_month_alone(spark, built):
    jobs.build_gold(spark, built)
    (march,) = glob.glob(f"{built.silver}/pickup_month=2025-03-01")
    changed = read_silver(spark, built.silver).filter("pickup_month = DATE'2025-03-01'").drop("pickup_month")
    changed.filter("hour(pickup_datetime) < 12").write.parquet(f"{built.root}/kept")
    kept = spark.read.parquet(f"{built.root}/kept")
    replace_silver_month(kept, built.silver, MARCH.start)
    full = LakeLayout(f"{built.root}/full")
    shutil.copytree(f"{built.root}/silver", f"{full.root}/silver")
    shutil.copytree(f"{built.root}/raw", f"{full.root}/raw")
    jobs.build_gold(spark, full)
    # The other months' trips are out of reach: only their states are left.
    for folder in glob.glob(f"{built.silver}/pickup_month=*"):
        if folder != march:
            for file in glob.glob(f"{folder}/*.parquet"):
                with open(file, "r+b") as out:
                    out.truncate(3)
    jobs.build_gold(spark, built, period=MARCH, only_these_months=True)
    assert gold_rows(spark, built) == gold_rows(spark, full)
    # A month without trips leaves no states behind.
    replace_silver_month(kept.limit(0), built.silver, MARCH.start)
    jobs.build_gold(spark, built, period=MARCH, only_these_months=True)
    assert {r[0] for r in gold_rows(spark, built)["avg_distance"]} == {*range(1, 13)} - {3}


def many_months(folder, months, parts_of=()):
    """A file of two trips per month, whose ids are long until the middle of the months and int from there on."""
    for n, month in enumerate(months):
        kind = pa.int64() if n < len(months) // 2 else pa.int32()
        pickup = datetime.fromisoformat(f"{month}-02")
        table = pa.table(
            {
                "tpep_pickup_datetime": pa.array([pickup, pickup], pa.timestamp("us")),
                "tpep_dropoff_datetime": pa.array([pickup, pickup], pa.timestamp("us")),
                "passenger_count": pa.array([n, None], pa.float64()),
                "trip_distance": pa.array([1.0, 2.0]),
                "PULocationID": pa.array([n, n], kind),
                "DOLocationID": pa.array([1, 2], kind),
            }
        )
        path = folder / f"yellow_tripdata_{month}.parquet"
        if month in parts_of:
            path.mkdir()
            for part in (0, 1):
                pq.write_table(table.slice(part, 1), path / f"part-{part}.parquet")
        else:
            pq.write_table(table, path)


def test_two_hundred_months_of_two_kinds(spark, tmp_path):
    period = Period(date(2009, 1, 1), date(2025, 9, 1))
    folder = tmp_path / "a yellow_tripdata_2001-01 b"
    folder.mkdir()
    many_months(folder, period.months, parts_of=("2009-03", "2025-08"))
    read = read_monthly_files(spark, str(folder), period)
    assert len(period.months) == 200
    assert dict(read.dtypes)["PULocationID"] == BRONZE_TRIPS["PULocationID"].dataType.simpleString()
    seen = read.groupBy("source_month").agg(F.count("*"), F.min("PULocationID"), F.max("PULocationID"))
    expected = [(date.fromisoformat(f"{month}-01"), 2, n, n) for n, month in enumerate(period.months)]
    assert sorted(rows(seen)) == expected
    # One month more, with a column of its own; the month between is absent.
    extra = Period(date(2009, 1, 1), date(2025, 12, 1))
    odd = pq.read_table(folder / "yellow_tripdata_2009-01.parquet").append_column("airport_fee", pa.array([1.25, None]))
    pq.write_table(odd, folder / "yellow_tripdata_2025-10.parquet")
    assert list(found_months(spark, str(folder), extra)) == [*period.months, "2025-10"]
    wider = read_monthly_files(spark, str(folder), extra)
    assert wider.count() == 402
    assert rows(wider.filter("airport_fee IS NOT NULL").select("source_month", "airport_fee")) == [(date(2025, 10, 1), 1.25)]


def test_a_month_without_a_needed_column_is_an_error_beside_whole_ones(spark, tmp_path):
    period = Period(date(2025, 1, 1), date(2025, 5, 1))
    many_months(tmp_path, period.months)
    broken = tmp_path / "yellow_tripdata_2025-03.parquet"
    pq.write_table(pq.read_table(broken).drop_columns(["trip_distance"]), broken)
    with pytest.raises(ValueError, match="trip_distance"):
        read_monthly_files(spark, str(tmp_path), period)


def test_several_months_are_replaced_at_once(spark, built):
    before = read_table(spark, built.silver).cache()
    assert before.count() == 764
    counts = {m: seen.counts["rows"] for m, seen in layer_measures(spark, built.silver, "pickup_month").items()}
    spring = Period(date(2025, 2, 1), date(2025, 6, 1))
    in_spring = sum(n for month, n in counts.items() if spring.start <= month < spring.end)
    bronze = {m: seen.counts["rows"] for m, seen in layer_measures(spark, built.bronze, "source_month").items()}
    assert jobs.build_bronze(spark, built, spring, only_these_months=True) == sum(
        n for month, n in bronze.items() if spring.start <= month < spring.end
    )
    assert jobs.build_silver(spark, built, spring, only_these_months=True) == in_spring > 0
    assert same(read_table(spark, built.silver), before)
    assert {m: seen.counts["rows"] for m, seen in layer_measures(spark, built.silver, "pickup_month").items()} == counts
    assert {m: seen.counts["rows"] for m, seen in layer_measures(spark, built.bronze, "source_month").items()} == bronze
    before.unpersist()


def test_a_month_that_fails_leaves_the_others_whole(spark, built):
    months = {m: read_silver(spark, built.silver).filter(F.month("pickup_datetime") == m).drop("pickup_month") for m in (2, 3)}
    counted = {m: trips.count() for m, trips in months.items()}
    copies = {m: spark.createDataFrame(trips.collect(), trips.schema) for m, trips in months.items()}
    broken = copies[3].withColumn("trip_distance", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        replace_silver_months({date(2025, 2, 1): copies[2], date(2025, 3, 1): broken}, built.silver)
    assert layer_measures(spark, built.silver, "pickup_month")[date(2025, 2, 1)].counts["rows"] == counted[2]
    assert replace_silver_months({date(2025, 2, 1): copies[2], date(2025, 3, 1): copies[3]}, built.silver) == sum(counted.values())
    stored = layer_measures(spark, built.silver, "pickup_month")
    assert stored[date(2025, 3, 1)].counts["rows"] == counted[3] and stored[date(2025, 2, 1)].counts["rows"] == counted[2]
    assert read_silver(spark, built.silver).filter(F.month("pickup_datetime") == 3).count() == counted[3]
