"""Best-fit packing by linear grouping: few rounded sizes, optimised configurations, actual documents, best fit for the rest.

Only the histogram of lengths (at most ``capacity`` rows) reaches the driver. The plan made from it says, for a range of ranks
among the pieces of one length, which sequences they go to; its size follows the number of lengths, not of pieces. Pieces
are ranked and looked up in Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.tables import give_back, id_and_bytes, stored
from kerbside.llm.tokens import ids_of_words, public_path, word_encoder

CAPACITY = 4096
# Lengths above this share of the capacity are large; they are rounded up within so many groups of equal cardinality.
LARGE_SHARE = 1 / 4
GROUPS = 160
STEPS_PER_SIZE = 8
# Pieces of one length are ranked within so many parts per shuffle partition, so that no length is one task.
PARTS_PER_PARTITION = 4


def document_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and its end id, cut only if over the capacity."""
    path = path or public_path("word_bpe_49k.json")
    end, step = np.uint32(end_id).tobytes(), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for ids, texts in id_and_bytes(batches):
            rows: list[tuple] = []
            for doc, text in zip(ids, texts):
                data = ids_of_words(encoder, text) + end
                for nth, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    rows.append((doc, nth, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        encoder.start_anew()  # a worker that waits for its next task keeps no pieces
        give_back()

    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return whole.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


# The plan ---------------------------------------------------------------------------------------------------------


def equal_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Large lengths, longest first, in groups of equal cardinality: (rounded length, [(length, pieces)])."""
    total, out, room = sum(counts.values()), [], 0
    target = -(-total // groups) if total else 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if room == 0:
                out.append((length, []))
                room = target
            taken = min(left, room)
            out[-1][1].append((length, taken))
            left, room = left - taken, room - taken
    return out


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits and is worth most, by adding one item at a time."""
    most = int(capacity // sizes.min())
    best, chosen = np.zeros(capacity + 1), []
    for _ in range(most):
        grown, pick = best.copy(), np.full(capacity + 1, -1, np.int32)
        for k in np.flatnonzero(values > 1e-12):
            s = int(sizes[k])
            worth = best[: capacity + 1 - s] + values[k]
            better = worth > grown[s:] + 1e-12
            grown[s:][better] = worth[better]
            pick[s:][better] = k
        if not (pick >= 0).any():
            break
        chosen.append(pick)
        best = grown
    counts, room = np.zeros(len(sizes), np.int64), capacity
    for pick in reversed(chosen):
        if pick[room] >= 0:
            counts[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return float(best[capacity]), counts


def few_size_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """[(items of each size in a sequence, sequences)] that use few sequences, by linear programming over
    configurations: a revised simplex that makes the columns it needs, then the whole parts of its solution."""
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    for _ in range(STEPS_PER_SIZE * m):  # any basis is a valid answer, a later one is a better one
        amounts = (inverse * demand).sum(axis=1)
        worth, column = best_configuration(sizes, inverse.sum(axis=0), capacity)
        if worth <= 1 + 1e-4:
            break
        along = (inverse * column).sum(axis=1)
        ratios = np.where(along > 1e-9, amounts / np.where(along > 1e-9, along, 1), np.inf)
        out = int(np.argmin(ratios))
        columns[:, out] = column
        row = inverse[out] / along[out]
        inverse -= np.outer(along, row)
        inverse[out] = row
    amounts = (inverse * demand).sum(axis=1)
    return [(columns[:, j].astype(np.int64), int(np.floor(amounts[j] + 1e-7))) for j in range(m)]


class Plan:
    """Classes of sequences that hold the same lengths, and the placements that made them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rank: dict[int, int] = {}
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.rooms: dict[int, list[tuple[int, int]]] = {}
        self.keys: list[int] = []
        self.sequences = 0

    def open(self, count: int) -> int:
        first, self.sequences = self.sequences, self.sequences + count
        return first

    def keep(self, room: int, first: int, count: int) -> None:
        if count and room:
            if room not in self.rooms:
                insort(self.keys, room)
                self.rooms[room] = []
            self.rooms[room].append((first, count))

    def place(self, length: int, first: int, count: int, each: int, offset: int) -> None:
        """``each`` pieces of the length into every one of ``count`` sequences, from the offset on."""
        rank = self.rank.get(length, 0)
        self.rows.append((length, rank, rank + each * count, first, each, offset))
        self.rank[length] = rank + each * count

    def best_fit(self, length: int, pieces: int) -> None:
        """All pieces of one length into the fullest sequences that still have room, then into new ones."""
        while pieces:
            at = bisect_left(self.keys, length)
            if at == len(self.keys):
                each = self.capacity // length
                count = max(1, pieces // each)
                self.keep(self.capacity, self.open(count), count)
                at = bisect_left(self.keys, length)
            room = self.keys[at]
            first, count = self.rooms[room].pop()
            if not self.rooms[room]:
                del self.rooms[room], self.keys[at]
            each = min(room // length, pieces)
            used = min(count, max(1, pieces // each))
            self.place(length, first, used, each, self.capacity - room)
            self.keep(room - each * length, first, used)
            self.keep(room, first + used, count - used)
            pieces -= each * used


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Placements of all pieces: ``rows`` of (length, rank_from, rank_to, first_sequence, each, offset)."""
    plan = Plan(capacity)
    for length, pieces in histogram.items():
        if length == capacity:
            plan.place(length, plan.open(pieces), pieces, 1, 0)
    large = {s: n for s, n in histogram.items() if capacity * LARGE_SHARE < s < capacity}
    rest = {s: n for s, n in histogram.items() if s <= capacity * LARGE_SHARE}
    grouped = equal_groups(large, groups)
    merged: dict[int, dict[int, int]] = {}  # rounded length: pieces left of each length, longest first
    for size, runs in grouped:
        own = merged.setdefault(size, {})
        for length, pieces in runs:
            own[length] = own.get(length, 0) + pieces
    sizes = np.array(list(merged), np.int64)
    if len(sizes):
        demand = np.array([sum(merged[s].values()) for s in sizes], float)
        for items, count in few_size_configurations(sizes, demand, capacity):
            if count:
                _substitute(plan, [int(s) for s, k in zip(sizes, items) for _ in range(k)], count, merged)
    for runs in merged.values():
        for length, pieces in runs.items():
            rest[length] = rest.get(length, 0) + pieces
    for length in sorted(rest, reverse=True):
        plan.best_fit(length, rest[length])
    return plan


def _substitute(plan: Plan, slots: list[int], count: int, merged: dict[int, dict[int, int]]) -> None:
    """Actual lengths in place of the rounded ones, in ``count`` sequences of one configuration.

    Each slot takes the shortest lengths that its group still has. Sequences that take the same ones are placed at once.
    """
    while count:
        chosen: list[tuple[int, int, int]] = []  # (rounded length, length, pieces in each sequence)
        used = count
        for size in set(slots):
            left = slots.count(size)
            for length, pieces in reversed(merged[size].items()):
                each = min(left, pieces)
                if each:
                    chosen.append((size, length, each))
                    used, left = min(used, pieces // each), left - each
        if not chosen:
            return
        first, offset = plan.open(used), 0
        for size, length, each in sorted(chosen, key=lambda c: -c[1]):
            plan.place(length, first, used, each, offset)
            offset += length * each
            merged[size][length] -= each * used
        plan.keep(plan.capacity - offset, first, used)
        count -= used


# Ranks and places -------------------------------------------------------------------------------------------------


def best_fit_packed(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """The pieces with (sequence_id, offset): sequences of at most ``capacity``, without gaps from 0 on.

    ``pieces`` is a stored table with a ``length`` from 1 to the capacity. Pieces of one length are interchangeable, so each
    needs only its rank among them. Ranks are counted within parts of a length, however frequent that length is.
    """
    spark = pieces.sparkSession
    parts = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts)).cast("int"))
    sizes = keyed.groupBy("length", "part").agg(F.count("*").alias("pieces"))
    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("part")) - F.col("pieces")
    bases = sizes.select(F.col("length").alias("of_length"), F.col("part").alias("of_part"), before.alias("base"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = packing_plan(histogram, capacity, groups).rows
    schema = "plan_length bigint, rank_from bigint, rank_to bigint, first_sequence bigint, each bigint, at bigint"
    plan = spark.createDataFrame(rows or [(0, 0, 0, 0, 1, 0)], schema)
    # One row per length with its placements in rank order: at most `capacity` rows of arrays, so a broadcast is bounded.
    steps = plan.groupBy("plan_length").agg(
        F.sort_array(F.collect_list(F.struct("rank_from", "rank_to", "first_sequence", "each", "at"))).alias("steps")
    )
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start")) - 1
    ranked = keyed.withColumn("within", within).join(
        bases, (F.col("length") == F.col("of_length")) & (F.col("part") == F.col("of_part"))
    )
    ranked = ranked.withColumn("rank", F.col("within") + F.col("base"))
    placed = ranked.join(F.broadcast(steps), F.col("length") == F.col("plan_length")).withColumn(
        "step", F.filter("steps", lambda s: (F.col("rank") >= s["rank_from"]) & (F.col("rank") < s["rank_to"]))[0]
    )
    nth = F.col("rank") - F.col("step.rank_from")
    each = F.col("step.each")
    return placed.select(
        *[F.col(c) for c in pieces.columns],
        (F.col("step.first_sequence") + F.floor(nth / each)).cast("bigint").alias("sequence_id"),
        (F.col("step.at") + F.pmod(nth, each) * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Pieces of all documents (doc_id, text) with their sequences and places in them.

    A null or empty text is its end id alone. Rows that share a doc_id are packed each for itself, null ids too; other
    columns are left out. An empty table gives no rows.
    """
    return best_fit_packed(stored(document_pieces(docs, path, capacity), "pieces"), capacity, groups)
