"""Token ids as shards of wavelet matrices: bit planes with rank and select in one compressed file per partition.

A shard holds the ids of consecutive documents. Plane k holds bit k of every id, highest bit first, each plane in the order
that the planes above it have sorted the ids to: those with bit 0 first. That is enough to read a single id, to count an id up
to a place and to find its n-th occurrence without reading the others' planes apart.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.tables import id_and_bytes, shared_folder
from kerbside.llm.tokens import ids_of_texts, public_path, word_encoder

# Ids in a shard (one row of a file), and bits between two stored ranks.
SHARD_IDS, RANK_BITS = 1 << 20, 512
SCHEMA = (
    "shard bigint, doc_ids array<bigint>, lengths array<int>, n_tokens bigint, zeros array<int>, "
    "planes array<binary>, ranks array<binary>"
)


class WaveletMatrix:
    """A sequence of ids below 2 ** planes."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        zeros, planes, ranks = [], [], []
        for k in range(bits - 1, -1, -1):
            ones = (ids & ids.dtype.type(1 << k)) != 0
            packed = np.packbits(ones, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (RANK_BITS // 8), np.uint8)])
            blocks = np.bitwise_count(packed.reshape(-1, RANK_BITS // 8)).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(blocks, dtype=np.uint32)]))
            planes.append(packed)
            zeros.append(int(len(ids) - ones.sum()))
            # By places, whose time does not depend on how the bits alternate.
            ids = np.concatenate([ids.take(np.flatnonzero(~ones)), ids.take(np.flatnonzero(ones))])
        return cls(len(ids), zeros, planes, ranks)

    def rank(self, plane: int, place: int) -> int:
        """Ones of a plane before a place."""
        block, rest = divmod(place, RANK_BITS)
        begin = block * RANK_BITS // 8
        part = self.planes[plane][begin : begin + (rest + 7) // 8].copy()
        if rest % 8:
            part[-1] &= (1 << rest % 8) - 1
        return int(self.ranks[plane][block]) + int(np.bitwise_count(part).sum())

    def select(self, plane: int, bit: int, nth: int) -> int:
        """Place of the nth (from 0) zero or one of a plane, by bisection over ranks."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self.rank(plane, middle + 1)
            if (ones if bit else middle + 1 - ones) > nth:
                high = middle
            else:
                low = middle + 1
        return low

    def access(self, place: int) -> int:
        """The id at a place."""
        value = 0
        for plane, zeros in enumerate(self.zeros):
            bit = int(self.planes[plane][place >> 3] >> (place & 7) & 1)
            ones = self.rank(plane, place)
            place = zeros + ones if bit else place - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        low, high = 0, end
        for plane, zeros in enumerate(self.zeros):
            one_low, one_high = self.rank(plane, low), self.rank(plane, high)
            if value >> (len(self.zeros) - 1 - plane) & 1:
                low, high = zeros + one_low, zeros + one_high
            else:
                low, high = low - one_low, high - one_high
        return low, high

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id before a place (default: all)."""
        if value >> len(self.zeros):
            return 0
        low, high = self._range(value, self.n if end is None else end)
        return high - low

    def find(self, value: int, nth: int) -> int:
        """Place of the nth (from 0) occurrence of an id."""
        if not 0 <= nth < self.count(value):
            raise IndexError(f"id {value} has no occurrence {nth}")
        place = self._range(value, self.n)[0] + nth
        for plane in range(len(self.zeros) - 1, -1, -1):
            if value >> (len(self.zeros) - 1 - plane) & 1:
                place = self.select(plane, 1, place - self.zeros[plane])
            else:
                place = self.select(plane, 0, place)
        return place

    def ids(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        kind = np.uint16 if len(self.zeros) <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for up, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").astype(bool)
            merged = np.empty(self.n, kind)
            merged[np.flatnonzero(~ones)] = values[:zeros]
            merged[np.flatnonzero(ones)] = values[zeros:] | kind(1 << up)
            values = merged
        return values.astype(np.uint32)


def packed_shard(shard: int, docs: list[int], parts: list[bytes], bits: int) -> pa.RecordBatch:
    joined = np.frombuffer(b"".join(parts), np.uint32)
    if len(joined) and int(joined.max()) >> bits:
        raise ValueError(f"id {joined.max()} needs more than {bits} bits")
    matrix = WaveletMatrix.of(joined.astype(np.uint16) if bits <= 16 else joined, bits)
    press = zstandard.ZstdCompressor(level=1).compress
    columns = [
        ([shard], pa.int64()),
        ([docs], pa.list_(pa.int64())),
        ([[len(p) // 4 for p in parts]], pa.list_(pa.int32())),
        ([len(joined)], pa.int64()),
        ([matrix.zeros], pa.list_(pa.int32())),
        ([[press(p.tobytes()) for p in matrix.planes]], pa.list_(pa.binary())),
        ([[press(r.tobytes()) for r in matrix.ranks]], pa.list_(pa.binary())),
    ]
    names = ["shard", "doc_ids", "lengths", "n_tokens", "zeros", "planes", "ranks"]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns], names)


def opened_shard(row: dict) -> WaveletMatrix:
    open_ = zstandard.ZstdDecompressor().decompress
    planes = [np.frombuffer(open_(x), np.uint8) for x in row["planes"]]
    return WaveletMatrix(row["n_tokens"], row["zeros"], planes, [np.frombuffer(open_(x), np.uint32) for x in row["ranks"]])


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2, bits: int | None = None, most: int = SHARD_IDS) -> None:
    """Encodes every whole text, adds the end id, and writes shards in ascending doc_id order: a file per partition, a row
    per shard. A document is never parted; one with more ids than ``most`` is a shard of its own.

    ``bits`` of an id are as many as the vocabulary and the end id need, unless given; an id that needs more is an error. Rows
    without a doc_id come first; rows with equal doc_ids are ordered by their texts. A null text is its end id alone.
    """
    path, end = path or public_path("word_bpe_49k.json"), np.uint32(end_id).tobytes()
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The text takes part in the range and the order so that many rows with one doc_id are no single partition.
    sorted_docs = own.withColumn("mark", F.xxhash64("text")).repartitionByRange(width, "doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, base, nth = word_encoder(path), TaskContext.get().partitionId() << 32, 0
        planes = bits or max(end_id, *encoder.tokenizer.get_vocab().values()).bit_length()
        held, parts, size = [], [], 0
        for ids, texts in id_and_bytes(batches):
            for doc, part in zip(ids, ids_of_texts(encoder, texts)):
                part += end
                if parts and size + len(part) // 4 > most:
                    yield packed_shard(base + nth, held, parts, planes)
                    held, parts, size, nth = [], [], 0, nth + 1
                held.append(doc)
                parts.append(part)
                size += len(part) // 4
        if parts:
            yield packed_shard(base + nth, held, parts, planes)

    ordered = sorted_docs.select("doc_id", "text").mapInArrow(packed, SCHEMA)
    ordered.write.option("compression", "none").parquet(folder)


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards; ``start`` counts all ids before it."""
    sizes = shards.select("shard", "n_tokens")
    # One row per shard: places of shards by a running sum within files, then over files, so neither sum is large.
    files = sizes.withColumn("file", F.shiftright("shard", 32))
    per_file = files.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before_file = per_file.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("shard")) - F.col("n_tokens")
    starts = files.withColumn("within", within).join(before_file, "file").select(
        F.col("shard").alias("of_shard"), (F.col("within") + F.col("file_start")).alias("base")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = opened_shard(row).ids()
                ends = np.cumsum(row["lengths"])
                begins = ends - row["lengths"]
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(ends), pa.int64()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(begins, pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["shard", "doc_id", "begin", "n_tokens", "ids_crc32"],
                )

    schema = "shard bigint, doc_id bigint, begin bigint, n_tokens bigint, ids_crc32 bigint"
    found = shards.mapInArrow(read, schema)
    placed = found.join(starts, F.col("shard") == F.col("of_shard"))
    return placed.select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, path: str | None = None) -> DataFrame:
    """What ``read_documents`` finds in shards written to the shared folder."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/kerbside-shards-{uuid.uuid4().hex}"
    write_shards(docs, folder, path)
    return read_documents(spark.read.schema(SCHEMA).parquet(folder))
