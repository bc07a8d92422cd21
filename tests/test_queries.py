from __future__ import annotations

import pytest
from compare import duck, matches

from __spark_entry__ import entry, oracle_sql, queries
from kerbside.registry.oracle import ORACLE
from kerbside.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) == set(ORACLE)


def test_flagship(spark):
    result = entry(spark)
    assert result.columns == ["from", "to", "ride_count"] and result.count() == 20


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_oracle(spark, connection, name):
    good, detail = matches(spark, connection, SF, name)
    assert good, detail


@pytest.mark.parametrize(
    "name", ["bronze_trips", "bronze_month_coverage", "silver_clean_trips", "gold_hourly_demand", "gold_avg_duration"]
)
def test_the_session_zone_changes_nothing(spark, connection, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        good, detail = matches(spark, connection, SF, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert good, detail


@pytest.mark.parametrize("name", list(QUERIES))
def test_column_types_match_the_oracle(spark, connection, name):
    shown = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DECIMAL(38,9)": "decimal(38,9)"}
    answer = connection.execute(ORACLE[name])
    wanted = {c[0]: shown[str(c[1])] for c in answer.description}
    assert dict(QUERIES[name](spark, SF).dtypes) == wanted
