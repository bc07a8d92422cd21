"""Token counts by a two-tier lookup on the map side: a broadcast table of frequent pieces, then worker caches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import forget, id_and_bytes, stored
from kerbside.llm.tokens import Encoder, count_of_spaced, public_path, spaced_pieces

# The first tier: at most so many pieces of at most so many bytes (about 3 MB), merged from the longest lists of the tasks.
FREQUENT_PIECES = 65_536
FREQUENT_BYTES = 24
LISTED_PIECES = 16_384
# Different pieces that a task counts at a time; beyond them the rarer half is forgotten.
COUNTED_PIECES = 400_000
_LOCAL: dict[int, Encoder] = {}


def frequent_pieces(docs: DataFrame) -> list[bytes]:
    """The pieces that stand after a space most often in all of ``docs``.

    Every task counts the pieces of all its texts and lists its most frequent ones; only these lists are summed. The cut is a
    count: as many pieces as the table holds occur at least so often, and no more than those come to the driver. Which pieces
    these are changes no result, only which tier answers.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in id_and_bytes(batches):
            for x in texts:
                seen.update(spaced_pieces(x)[1:])
            if len(seen) > COUNTED_PIECES:
                seen = Counter(dict(seen.most_common(COUNTED_PIECES // 2)))
        top = [(p, n) for p, n in seen.most_common(LISTED_PIECES) if len(p) <= FREQUENT_BYTES]
        if top:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"]
            )

    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    summed = stored(whole.mapInArrow(counted, "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n")), "pieces")
    # Eight classes to each doubling of the count: at most 500 rows, whatever the corpus.
    level = F.floor(8 * F.log2(F.col("n").cast("double")))
    room, least = FREQUENT_PIECES, None
    for row in summed.groupBy(level.alias("level")).agg(F.count("*").alias("pieces")).orderBy(F.desc("level")).collect():
        if row["pieces"] > room:
            break
        room, least = room - row["pieces"], row["level"]
    top = [] if least is None else summed.filter(level >= least).select("piece").collect()
    forget(summed)
    return [bytes(r["piece"]) for r in top]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs`` (doc_id, text), whole texts.

    The ids are the library's: no begin or end tokens, special strings as its default, no cut. A null or empty text has
    0 bytes and 0 tokens. Rows with a repeated or null doc_id are counted each for itself. No shuffle: a text is counted
    by the task that reads it, whatever the frequency of its words.
    """
    path = path or public_path("byte_bpe_50k.json")
    spark = docs.sparkSession
    pieces = frequent_pieces(docs)
    encoder = Encoder(path, len, cased=True, before=" ")
    table = spark.sparkContext.broadcast({p: encoder[p] for p in pieces})

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _LOCAL.get(id(table.value))
        if own is None:
            _LOCAL.clear()
            own = _LOCAL[id(table.value)] = Encoder(path, len, cased=True, before=" ", frequent=table.value)
        for ids, texts in id_and_bytes(batches):
            tokens = [count_of_spaced(own, x) if x else 0 for x in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = whole.mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
