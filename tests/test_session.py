from __future__ import annotations

from kerbside.session import BASE_CONF, CLUSTER_CONF, object_store_conf, size_shuffles


def test_object_store_settings():
    conf = object_store_conf("http://host:9000")
    assert conf == {
        "spark.hadoop.fs.s3a.endpoint": "http://host:9000",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    }
    keys = object_store_conf("https://host", "name", "word", path_style=False, tls=True)
    assert keys["spark.hadoop.fs.s3a.access.key"] == "name" and keys["spark.hadoop.fs.s3a.secret.key"] == "word"
    assert keys["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_settings_are_known_to_spark(spark):
    for key in {**BASE_CONF, **CLUSTER_CONF}:
        assert spark.conf.get(key) is not None


def test_shuffles_follow_the_size_of_the_table(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(100_000).write.parquet(str(tmp_path / "table"))
    try:
        assert size_shuffles(spark, str(tmp_path / "table"), partition_bytes=4096) > 50
        assert int(spark.conf.get(key)) > 50
        assert size_shuffles(spark, str(tmp_path / "none")) == 8
    finally:
        spark.conf.unset(key)
