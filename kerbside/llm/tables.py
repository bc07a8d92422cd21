"""Intermediate tables and column helpers that the text operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, one in the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/kerbside_scratch"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as written to the shared folder and read back: the lineage is cut, and no work is done twice.

    Files that a result reads outlive the query, as those of ``checkpoint()`` do; whoever owns the folder empties it.
    """
    path = f"{shared_folder(frame.sparkSession)}/kerbside-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the files of stored frames from which everything that is still needed has been stored in turn."""
    for frame in frames:
        jvm, conf = frame.sparkSession._jvm, frame.sparkSession._jsc.hadoopConfiguration()
        for folder in {path.rpartition("/")[0] for path in frame.inputFiles()}:
            target = jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(conf).delete(target, True)


def few_or_shuffled(frame: DataFrame, most_rows: int) -> DataFrame:
    """A broadcast hint for a stored frame that has few rows; a larger one is left to a shuffled join."""
    return F.broadcast(frame) if frame.limit(most_rows + 1).count() <= most_rows else frame


def fresh(frame: DataFrame, name: str) -> str:
    """The name, made longer until no column of ``frame`` has it, without regard to case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pick(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found without regard to case; other columns, however named, play no part."""
    return frame.select(*[F.col(f"`{name}`") for name in names])


def give_back() -> None:
    """Return what this worker has freed to the system: Spark keeps idle workers, and an executor's limit counts them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other libraries than glibc have none
    if trim:
        trim(0)


def id_and_bytes(batches: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8) of a (doc_id, text) stream in pieces of about ``most_bytes``; a null text is empty."""
    for batch in batches:
        texts = batch.column(1).cast(pa.binary() if batch.column(1).type == pa.string() else pa.large_binary())
        rows = max(1, min(batch.num_rows, int(batch.num_rows * most_bytes / max(1, texts.nbytes))))
        for at in range(0, batch.num_rows, rows):
            ids = batch.column(0).slice(at, rows).to_pylist()
            yield ids, [x or b"" for x in texts.slice(at, rows).to_pylist()]
    batch = texts = ids = None
    give_back()
