"""Spark settings that the jobs rely on. The session itself belongs to the caller."""

from __future__ import annotations

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Fixed values. Adaptive execution sizes the shuffles: the initial number of partitions is an upper bound.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task that writes a few partitions keeps their files open instead of sorting all its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Recording a Python call site per expression takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Sizes for large tables. Files and tasks of 256 MiB instead of as many as there are cores.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
    tls: bool = False,
) -> dict[str, str]:
    """Settings for ``s3a://`` paths on an S3-compatible store. Without keys Hadoop's credential providers apply."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(app_name: str, *confs: dict[str, str]) -> SparkSession:
    """A session with the base settings and any others. What ``spark-submit`` was given goes first: master,
    resources, and any of these settings too."""
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    for conf in (BASE_CONF, *confs):
        for key, value in conf.items():
            if not submitted.contains(key):
                builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, path: str, partition_bytes: int = 256 << 20) -> int:
    """Give shuffles of a table stored under ``path`` as many initial partitions as it takes to keep them at
    ``partition_bytes``; adaptive execution merges partitions but never adds any to an aggregate. Returns that number.

    A number given to ``spark-submit`` stays. Compressed bytes grow in a shuffle, so the table counts double.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if SparkConf().contains(key):
        return int(spark.conf.get(key))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stored = files.getContentSummary(target).getLength() if files.exists(target) else 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * stored // partition_bytes))
    spark.conf.set(key, str(width))
    return width
