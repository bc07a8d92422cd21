"""Importance resampling towards a target: Gumbel top-k over hashed n-gram weights, drawn by threshold bisection.

A document's weight is the mean gain of its features: how much likelier each feature's bucket is in the target texts than in
the corpus. Adding Gumbel noise and taking the highest scores draws without replacement in proportion to exp(weight).
The k-th highest score is found by bisection: count jobs over the stored scores, first on the score, then on the order of the
documents that tie there. So nothing is sorted but what is drawn, and no list of documents leaves the executors.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.decontamination import contract_words
from kerbside.llm.tables import id_and_bytes, stored

# Fixed by the contract.
BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
# Bytes of a text that are cut into words at a time; a longer word is taken whole.
PIECE_BYTES = 1 << 20
# Drawn rows that a partition ranks.
RANKED_ROWS = 1_000_000
_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def word_pieces(text: bytes, most: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of the text in order, in lists from pieces of ``most`` bytes and the rest of a word."""
    at = 0
    while at < len(text):
        found = _SEPARATOR.search(text, at + most)
        end = found.start() if found else len(text)
        yield contract_words(text[at:end])
        at = end


def text_features(text: bytes, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs of one word and of two words that end with them) for each piece of the text."""
    last = None
    for words in word_pieces(text):
        if not words:
            continue
        single = list(map(zlib.crc32, words))
        before = [last, *single[:-1]]
        spaced = [b" " + w for w in words]
        if last is None:
            before, spaced = before[1:], spaced[1:]
        # The checksum of "a b" goes on from that of "a".
        double = list(map(zlib.crc32, spaced, before))
        last = single[-1]
        yield len(words), np.array(single + double, np.int64) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts of (doc_id, text) fall into each bucket.

    Every task adds up its own texts, so a frequent word costs a task one row.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, batch in id_and_bytes(batches):
            held, size = [], 0
            for text in batch:
                for _, found in text_features(text, buckets):
                    held.append(found)
                    size += len(found)
                if size > 1 << 20:
                    total += np.bincount(np.concatenate(held), minlength=buckets)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    return texts.mapInArrow(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(own: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln of the smoothed likelihood ratio) of every bucket; ``buckets`` rows at most come to the driver."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for array, frame in ((s, own), (t, target)):
        for row in frame.collect():
            array[row["bucket"]] = row["n"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of (doc_id, text): the floored mean gain, 0 without features."""
    table = docs.sparkSession.sparkContext.broadcast(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, buckets = table.value, len(table.value)
        for ids, texts in id_and_bytes(batches):
            words, features, mean = [], [], []
            for text in texts:
                n, many, total = 0, 0, 0
                for count, found in text_features(text, buckets):
                    n, many, total = n + count, many + len(found), total + int(gain[found].sum())
                words.append(n)
                features.append(many)
                mean.append(total // many if many else 0)
            columns = [pa.array(x, pa.int64()) for x in (ids, words, features, mean)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(weighed, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the digest of the seed and the id (a null id counts as an empty one)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def least_of_highest(frame: DataFrame, value: str, wanted: int) -> int:
    """The greatest x such that at least ``wanted`` rows have a value of x or more. Each step is an exact count job."""
    low, high = frame.agg(F.min(value), F.max(value)).first()
    while low < high:
        middle = (low + high + 1) // 2
        if frame.filter(F.col(value) >= middle).count() >= wanted:
            low = middle
        else:
            high = middle - 1
    return low


def _turned_id() -> Column:
    """Greater for smaller ids; a null id counts as the greatest id there can be."""
    return F.coalesce(F.expr("~doc_id"), F.lit(-(1 << 63)))


def is_drawn(scored: DataFrame, wanted: int) -> Column:
    """Whether a row of ``scored`` (score, doc_id, row) is among the ``wanted`` first by score down, doc_id, row.

    Bisection on the score leaves the rows that tie at the cutoff; bisection on their doc_ids (turned, as the smaller ones are
    drawn) those that share one; bisection on the row number ends it.
    """
    if wanted <= 0:
        return F.lit(False)
    cutoff = least_of_highest(scored, "score", wanted)
    drawn = F.col("score") > cutoff
    back = _turned_id()
    tied = scored.filter(F.col("score") == cutoff).select(back.alias("back"), F.expr("~row").alias("turned"))
    wanted -= scored.filter(drawn).count()
    if tied.count() == wanted:
        return F.col("score") >= cutoff
    edge = least_of_highest(tied, "back", wanted)
    wanted -= tied.filter(F.col("back") > edge).count()
    row_edge = least_of_highest(tied.filter(F.col("back") == edge), "turned", wanted)
    return drawn | ((F.col("score") == cutoff) & ((back > edge) | ((back == edge) & (F.expr("~row") >= row_edge))))


def ranked(drawn: DataFrame, rows: int) -> DataFrame:
    """``drawn`` (score, doc_id, row) with ``rank`` from 1 by score down, doc_id, row.

    Range partitions are sorted each for itself; the numbers of rows before them, one per partition, are summed up.
    """
    width = max(int(drawn.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANKED_ROWS))
    order = [F.desc("score"), _turned_id().desc(), F.asc("row")]
    ordered = drawn.repartitionByRange(width, *order).sortWithinPartitions(*order)
    # The id holds the number of the partition above 33 bits and the place in it below them.
    placed = stored(ordered.withColumn("spot", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("spot", 33)
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, at = {}, 0
    for key, n in counts:
        before[key], at = at, at + n
    if not before:
        return placed.withColumn("rank", F.lit(None).cast("bigint")).drop("spot")
    starts = F.broadcast(drawn.sparkSession.createDataFrame(list(before.items()), "of_part BIGINT, start BIGINT"))
    rank = F.col("start") + F.col("spot") - F.shiftleft(part, 33) + 1
    return placed.join(starts, part == F.col("of_part")).withColumn("rank", rank).drop("spot", "of_part", "start")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every row of ``docs`` (doc_id, text).

    ``target`` is any table with a ``text``. Of the N documents with at least ``least_words`` words floor(percent * N / 100)
    are drawn: the highest scores, ties to the smaller doc_id. ``rank`` counts them from 1 and is null for all others. Null
    and empty texts have no features and weight 0. Rows that share a doc_id and a score rank one after the other in any order;
    a null doc_id counts as the greatest. Other columns are left out. An empty table gives no rows; an empty target
    leaves the smoothed ratios of the corpus alone.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted_texts = target.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(own), bucket_counts(wanted_texts))
    scored = weights(own, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = F.col("n_words") >= least_words
    pool = scored.filter(able)
    wanted = percent * pool.count() // 100
    drawn = able & is_drawn(pool, wanted)
    first = ranked(scored.filter(drawn), wanted)
    others = scored.filter(~drawn).withColumn("rank", F.lit(None).cast("bigint"))
    return first.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
