"""Fingerprints of documents, of edited documents, and how alike they are to each other and to the next document's."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.improbable_features import CLASSES, as_text, class_counts, digests, likeness, rarity_ranks
from kerbside.llm.tables import id_and_bytes

# Bytes of texts that one task puts in order.
PART_BYTES = 64 << 20


def corpus_ranks(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(rank of every entropy class, bytes of text) of all of ``docs`` (doc_id, text); at most 231 classes occur."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = np.zeros(CLASSES, np.int64), 0
        for _, texts in id_and_bytes(batches):
            total += class_counts(texts)
            size += sum(map(len, texts))
        some = np.flatnonzero(total)
        kinds, numbers = [-1, *some.tolist()], [size, *total[some].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(numbers, pa.int64())], ["class", "n"])

    found = docs.mapInArrow(counted, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = {row["class"]: row["n"] for row in found}
    size = counts.pop(-1, 0)
    return rarity_ranks(counts), size


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row of ``docs`` (doc_id, text).

    ``ranks`` are those of the corpus itself unless given; digests are to be compared with others made by the same ranks. Equal
    texts have equal digests; a null or empty text has an empty one.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = own.sparkSession.sparkContext.broadcast(corpus_ranks(own)[0] if ranks is None else ranks)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_and_bytes(batches):
            columns = [pa.array(ids, pa.int64()), pa.array([len(t.decode()) for t in texts], pa.int64())]
            columns.append(pa.array(map(as_text, digests(texts, table.value)), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "fingerprint"])

    return own.mapInArrow(made, "doc_id bigint, n_chars bigint, fingerprint string")


def _edited(text: bytes, n_chars: int, following: bytes) -> bytes:
    """The text with its last third replaced by the first as many characters of the following one."""
    cut = n_chars // 3
    if len(text) == n_chars and following[: 4 * cut].isascii():
        return text[: n_chars - cut] + following[:cut]
    return (text.decode()[: n_chars - cut] + following[: 4 * cut].decode(errors="ignore")[:cut]).encode()


def compared_with_edited(docs: DataFrame) -> DataFrame:
    """The contract's row for every row of ``docs`` (doc_id, text): fingerprints of the text and of the text whose last third
    is replaced from the next document (descending doc_id, after the last the first), and their likeness.

    Rows with equal doc_ids follow each other in the order of their texts. A row without a doc_id has no place in the order:
    its next document is empty. A null or empty text has an empty fingerprint, which is like an empty one only. A document
    alone is its own next one. Other columns are left out; an empty table gives no rows.

    Texts are dealt out once, by ranges of doc_id. Ranges begin at ids that occur (quantiles), so a copy of the row that a range
    begins with also goes to the range before it and every row meets its next one; the first of all goes to the last range too.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranks, size = corpus_ranks(own)
    table = spark.sparkContext.broadcast(ranks)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    shares = F.array(*[F.lit(x / width) for x in range(1, width)]) if width > 1 else F.array(F.lit(1.0))
    top, cuts = own.agg(F.max("doc_id"), F.percentile_approx("doc_id", shares, 20 * width)).first()
    # The greatest id of each range, ascending: the last one is the greatest of all.
    heads = np.array(sorted({top, *(cuts or [])}) if top is not None else [0], np.int64)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_and_bytes(batches):
            made = digests(texts, table.value)
            rows = []
            for doc, text, digest in zip(ids, texts, made):
                row = (doc, text, len(text.decode()), digest)
                if doc is None:
                    rows.append((*row, len(text) % len(heads), False))
                    continue
                part = int(np.searchsorted(heads, doc))
                rows.append((*row, part, False))
                if heads[part] == doc:
                    # Ranges go down: what begins a range follows the end of the one above it.
                    rows.append((*row, (part + 1) % len(heads), True))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.bool_()]
            names = ["doc_id", "text", "n_chars", "digest", "part", "copy"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "doc_id bigint, text binary, n_chars bigint, digest binary, part int, copy boolean"
    dealt = own.mapInArrow(marked, schema).repartitionById(len(heads), F.col("part"))
    ordered = dealt.sortWithinPartitions("copy", F.desc_nulls_last("doc_id"), "text").drop("part")

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, done = None, False
        for batch in batches:
            rows_in = max(1, min(batch.num_rows, int(batch.num_rows * (4 << 20) / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, rows_in):
                pairs = []
                for doc, text, n, digest, copy in zip(*[c.to_pylist() for c in batch.slice(at, rows_in).columns]):
                    row = (doc, text, n, digest)
                    if copy and (done or waiting is None):
                        continue
                    if doc is None:
                        pairs.append((row, (None, b"", 0, b"")))
                        continue
                    if waiting is not None:
                        pairs.append((waiting, row))
                    waiting, done = row, copy
                if pairs:
                    yield _compared(pairs, table.value)

    return ordered.mapInArrow(paired, SCHEMA)


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(pairs: list[tuple], ranks: np.ndarray) -> pa.RecordBatch:
    texts = [_edited(row[1], row[2], following[1]) for row, following in pairs]
    made = digests(texts, ranks)
    columns = [
        pa.array([row[0] for row, _ in pairs], pa.int64()),
        pa.array([row[2] for row, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        pa.array([as_text(row[3]) for row, _ in pairs], pa.string()),
        pa.array(map(as_text, made), pa.string()),
        pa.array([likeness(row[3], d) for (row, _), d in zip(pairs, made)], pa.float64()),
        pa.array([likeness(row[3], following[3]) for row, following in pairs], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in SCHEMA.split(", ")])
