"""Exact Jaccard join of documents by their word shingles, as a metric-space join over regions around pivots.

Among whole corpora nearly every distance is exactly 1, so Voronoi cells of a few far pivots would hold everything. Regions
are therefore found by what documents share, without losing a link, and pivots work inside them:

1. Two linked sets share at least 80 % of either, so they share part of their first shingles in any common order. Sets too
   few of whose first shingles occur elsewhere have no links and drop out.
2. What remains is ordered by rarity; sets that share one of their rarest shingles lie in one region. The least document of
   each shingle is a pivot: all its sharers' distances to it are exact, and links to it are links.
3. In a region that these links leave in several parts, every document outside the largest part meets the whole region, in
   blocks: blocks form Voronoi cells around pivots of their own, the triangle inequality keeps those documents that can lie
   within reach of a cell, and cells are joined recursively down to exact comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from kerbside.llm.components import components
from kerbside.llm.tables import few_or_shuffled, forget, fresh, id_and_bytes, stored
from kerbside.llm.words import shingle_set

# Fixed: links need 100 * shared >= 80 * united.
PERCENT = 80
# Documents in a block, on either side; pairs that a cell compares without further pivots.
BLOCK, DIRECT_PAIRS, PIVOTS = 512, 4096, 8
BROADCAST_ROWS = 500_000
# Bytes of text that a worker takes at a time: about ten times as much is its memory.
BATCH_BYTES = 8 << 20
# Sets whose counts one task sums up.
COUNTED_SETS = 10_000


def needed(n: int) -> int:
    """The least number of shared shingles that a link of a set of n shingles has."""
    return -(-PERCENT * n // 100)


def first_shingles(n: int) -> tuple[int, int]:
    """(how many shingles a set of n shows, how many of them a linked set must show too).

    Linked sets share ``needed`` shingles, the first s of which stand among the first n - needed + s of either.
    """
    shown = 1 + n // 10
    return n - needed(n) + shown, 1 + needed(n) // 10


def profiles(docs: DataFrame, parts: int) -> DataFrame:
    """From (key, text, doc_id) rows of three kinds, told by ``part``: a document (-1), shown shingles of a batch that fall to a part (0 on), and
    numbers of shown shingles that other sets of the batch show too (-2).

    A shingle that several sets of a batch show goes on as one entry that no set owns, so however common, it costs a batch
    one entry.
    """

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, keys_of in _with_ids(batches):
            sizes, high, low, shown, owners, seen = [], [], [], [], [], set()
            for text in texts:
                s = shingle_set(text)
                mark = xxhash.xxh3_128_intdigest(s.tobytes())
                sizes.append(len(s))
                high.append((mark >> 64) - (1 << 63))
                low.append((mark & (1 << 64) - 1) - (1 << 63))
                if len(s) and mark not in seen:
                    seen.add(mark)
                    first = s[: first_shingles(len(s))[0]].copy()
                    shown.append(first)
                    owners.append(high[-1])
            docs_part = [ids, pa.array(keys_of, pa.int64()), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())]
            yield _rows(docs_part, pa.array([-1] * len(ids), pa.int32()), None, None)
            if not shown:
                continue
            keys, own = np.concatenate(shown), np.repeat(np.array(owners, np.int64), [len(x) for x in shown])
            texts = shown = None
            order = np.argsort(keys, kind="stable")
            keys, own = keys[order], own[order]
            again = np.r_[False, keys[1:] == keys[:-1]]
            common = again | np.r_[again[1:], False]
            who, times = np.unique(own[common], return_counts=True)
            none = pa.nulls(len(who), pa.int64())
            yield _rows([none, none, pa.array(times, pa.int64()), pa.array(who, pa.int64()), none], pa.array([-2] * len(who), pa.int32()), None, None)
            own = np.where(common, 0, own)[~again]
            keys = keys[~again]
            part = (keys % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            keys, own, part = keys[order], own[order], part[order]
            again = common = order = None
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[cuts[1:], len(part)]
            none = pa.nulls(len(cuts), pa.int64())
            yield _rows(
                [none] * 5,
                pa.array(part[cuts], pa.int32()),
                [keys[a:b].tobytes() for a, b in zip(cuts, ends)],
                [own[a:b].tobytes() for a, b in zip(cuts, ends)],
            )

    schema = "doc_id bigint, key bigint, n bigint, high bigint, low bigint, part int, keys binary, owners binary"
    return docs.mapInArrow(profiled, schema)


def _rows(columns: list[pa.Array], part: pa.Array, keys: list | None, owners: list | None) -> pa.RecordBatch:
    blobs = [pa.nulls(len(part), pa.binary()) if x is None else pa.array(x, pa.binary()) for x in (keys, owners)]
    return pa.RecordBatch.from_arrays([*columns, part, *blobs], ["doc_id", "key", "n", "high", "low", "part", "keys", "owners"])


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes], list[int]]]:
    """(doc_ids, texts, keys) of a (key, text, doc_id) stream."""
    for batch in batches:
        at = 0
        for keys, texts in id_and_bytes([batch], BATCH_BYTES):
            yield batch.column(2).slice(at, len(keys)), texts, keys
            at += len(keys)


def shown_elsewhere(table: pa.Table, buckets: int) -> pa.Table:
    """(bucket, sets, times): for the sets that show some of a part's shingles which another set shows too, how many.

    Sets are packed by the bucket that sums them up, so a part makes a row for a bucket and not for a set.
    """
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
    own = np.concatenate([np.frombuffer(x, np.int64) for x in table["owners"].to_pylist()])
    order = np.lexsort((own, keys))
    keys, own = keys[order], own[order]
    once = np.r_[True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])]
    keys, own = keys[once], own[once]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.r_[starts, len(keys)])
    unowned = np.logical_or.reduceat(own == 0, starts)
    common = np.repeat((counts > 1) | unowned, counts) & (own != 0)
    return _packed(*np.unique(own[common], return_counts=True), buckets)


def _packed(who: np.ndarray, times: np.ndarray, buckets: int) -> pa.Table:
    home = who % buckets
    order = np.argsort(home, kind="stable")
    who, times, home = who[order], times[order], home[order]
    cuts = np.flatnonzero(np.r_[True, home[1:] != home[:-1]])[: len(home)]
    ends = [*cuts[1:].tolist(), len(home)]
    return pa.table(
        {
            "bucket": pa.array(home[cuts], pa.int64()),
            "sets": pa.array([who[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "times": pa.array([times[a:b].astype(np.int64).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


def summed(table: pa.Table) -> pa.Table:
    """(high, common) of the sets of one bucket."""
    who = np.concatenate([np.frombuffer(x, np.int64) for x in table["sets"].to_pylist()])
    times = np.concatenate([np.frombuffer(x, np.int64) for x in table["times"].to_pylist()])
    sets, nth = np.unique(who, return_inverse=True)
    total = np.zeros(len(sets), np.int64)
    np.add.at(total, nth, times)
    return pa.table({"high": pa.array(sets, pa.int64()), "common": pa.array(total, pa.int64())})


def candidate_sets(docs: DataFrame, sets: DataFrame, profile: DataFrame, repeated: bool) -> DataFrame:
    """(node, n, s): sets that can have links, with their shingles ascending. A stored table.

    ``docs`` is (key, text, doc_id), ``sets`` has one row per distinct set (high, low, n, key, node). What is counted may be
    too high, never too low. ``repeated`` tells whether rows may share a key.
    """
    buckets = -(-sets.count() // COUNTED_SETS) or 1
    blocks = profile.filter("part >= 0").select("part", "keys", "owners")
    elsewhere = blocks.groupBy("part").applyInArrow(lambda table: shown_elsewhere(table, buckets), "bucket bigint, sets binary, times binary")
    here = profile.filter("part = -2").select("high", "n")
    there = elsewhere.groupBy("bucket").applyInArrow(summed, "high bigint, common bigint")
    counts = there.union(here).groupBy("high").agg(F.sum("common").alias("common"))
    least = 1 + F.floor(F.ceil(F.col("n") * PERCENT / 100) / 10)
    able = sets.join(counts, "high").filter(F.col("common") >= least)
    able = stored(able.select("key", "high", "node"), "able")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2).to_pylist()
            at = 0
            for nodes, texts in id_and_bytes([batch]):
                rows = []
                for node, text, high in zip(nodes, texts, wanted[at : at + len(nodes)]):
                    s = shingle_set(text)
                    if (xxhash.xxh3_128_intdigest(s.tobytes()) >> 64) - (1 << 63) == high:
                        rows.append((node, len(s), s.view(np.int64)))
                at += len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    ],
                    ["node", "n", "s"],
                )

    texts = docs.join(few_or_shuffled(able, BROADCAST_ROWS), "key").select("node", "text", "high")
    found = texts.mapInArrow(listed, "node bigint, n bigint, s array<bigint>")
    # Rows that share a key and a text show their set twice.
    found = stored(found.dropDuplicates(["node"]) if repeated else found, "sets")
    forget(able)
    return found


def rarest_first(sets: DataFrame) -> DataFrame:
    """(s, node): for each set the shingles of its prefix that other candidates have too, the rarest first.

    The prefix of n - needed + 1 shingles is as long as a link between sets requires. Shingles that no other set has come
    first in it and take up its length, but lead nowhere.
    """
    entries = sets.select("node", "n", F.explode("s").alias("s"))
    often = entries.groupBy("s").agg(F.count("*").alias("sharers")).filter("sharers > 1")
    own = entries.join(often, "s").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("sharers", "s"))).alias("own"))
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("n") - F.size("own"))
    shown = own.filter(length > 0).select("node", F.explode(F.slice("own", F.lit(1), length.cast("int"))).alias("e"))
    return shown.select("node", F.col("e.s").alias("s"))


def links_to_pivots(entries: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all pairs of a document and a pivot that share a rare shingle, those of them that are links), both stored."""
    pivots = entries.groupBy("s").agg(F.min("node").alias("pivot"))
    near = entries.join(pivots, "s").filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    near = stored(near.distinct(), "near")
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    both = near.join(left, "a").join(right, "b").withColumn("shared", shared)
    linked = both.filter(100 * F.col("shared") >= PERCENT * (F.col("na") + F.col("nb") - F.col("shared")))
    return near, stored(linked.select("a", "b"), "linked")


# Blocks -----------------------------------------------------------------------------------------------------------


def shared_counts(x: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Shingles that ``x`` shares with each of the sets laid end to end in ``flat``."""
    at = np.searchsorted(x, flat)
    at[at == len(x)] = 0
    return np.add.reduceat((x[at] == flat).astype(np.int64), starts)


def block_links(outside: list[tuple], inside: list[tuple]) -> set[tuple[int, int]]:
    """Links between two lists of (node, label, set) under different labels, one for each node and label."""
    found: dict[tuple[int, int], int] = {}

    def against(x: np.ndarray, docs: list[tuple]) -> np.ndarray:
        flat = np.concatenate([d[2] for d in docs])
        sizes = np.array([len(d[2]) for d in docs])
        return shared_counts(x, flat, np.cumsum(sizes) - sizes)

    def distances(x: np.ndarray, docs: list[tuple]) -> np.ndarray:
        shared = against(x, docs)
        return 1 - shared / (len(x) + np.array([len(d[2]) for d in docs]) - shared)

    def joined(left: list[tuple], right: list[tuple]) -> None:
        if not left or not right:
            return
        if len(left) * len(right) > DIRECT_PAIRS and len(right) > 2 * PIVOTS:
            pivots = [right[k * len(right) // PIVOTS] for k in range(PIVOTS)]
            to_right = np.array([distances(p[2], right) for p in pivots])
            to_left = np.array([distances(p[2], left) for p in pivots])
            home = to_right.argmin(axis=0)
            cells = [np.flatnonzero(home == k) for k in range(PIVOTS)]
            reach = 1 - PERCENT / 100 + 1e-9
            if max(map(len, cells)) < len(right):
                for k, cell in enumerate(cells):
                    if len(cell):
                        window = np.flatnonzero(
                            (to_left[k] <= to_right[k, cell].max() + reach) & (to_left[k] >= to_right[k, cell].min() - reach)
                        )
                        joined([left[i] for i in window], [right[i] for i in cell])
                return
        sizes = np.array([len(d[2]) for d in right])
        for node, label, x in left:
            shared = against(x, right)
            for i in np.flatnonzero(100 * shared >= PERCENT * (len(x) + sizes - shared)):
                if right[i][1] != label:
                    found.setdefault((node, right[i][1]), right[i][0])

    joined(outside, inside)
    return {(node, other) for (node, _), other in found.items()}


def joined_block(table: pa.Table) -> pa.Table:
    nodes, labels, outer = (table[c].to_pylist() for c in ("node", "label", "outside"))
    sets = [np.sort(np.array(x.as_py(), np.int64)) for x in table["s"]]
    rows = list(zip(nodes, labels, sets))
    links = block_links([r for r, o in zip(rows, outer) if o], [r for r, o in zip(rows, outer) if not o])
    ordered = sorted(links)
    return pa.table({"a": pa.array([x for x, _ in ordered], pa.int64()), "b": pa.array([y for _, y in ordered], pa.int64())})


def links_within_regions(sets: DataFrame, regions: DataFrame, parts: DataFrame) -> DataFrame:
    """Links (a, b) between different parts of one region: whoever is not in its largest part meets everyone in it.

    Regions are cut into blocks of about ``BLOCK`` documents on either side, so no region is one task.
    """
    label = F.coalesce("component", "node").alias("label")
    placed = regions.select("node", F.col("component").alias("region")).join(parts, "node", "left").select("node", "region", label)
    weights = placed.groupBy("region", "label").agg(F.count("*").alias("weight"))
    largest = weights.groupBy("region").agg(
        F.max(F.struct("weight", "label")).alias("top"), F.sum("weight").alias("size"), F.count("*").alias("labels")
    )
    open_regions = largest.filter("labels > 1").select("region", F.col("top.label").alias("main"), "size", F.expr("size - top.weight").alias("rest"))
    members = placed.join(open_regions, "region").join(sets.select("node", "s"), "node")
    rows, columns = F.ceil(F.col("rest") / BLOCK).cast("int"), F.ceil(F.col("size") / BLOCK).cast("int")
    spot = F.xxhash64("node")
    # Only large regions are cut; a block holds about BLOCK documents of either side.
    inside = members.select("node", "label", "s", "region", F.explode(F.sequence(F.lit(0), rows - 1)).alias("i"), F.pmod(spot, columns).cast("int").alias("j"), F.lit(False).alias("outside"))
    outside = members.filter("label <> main").select(
        "node", "label", "s", "region", F.pmod(spot, rows).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("j"), F.lit(True).alias("outside")
    )
    return inside.union(outside).groupBy("region", "i", "j").applyInArrow(joined_block, "a bigint, b bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, text, doc_id): the key finds a row's text again; it is the doc_id, or a hash of the text where that is null."""
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    return docs.select(F.coalesce(doc_id, F.xxhash64(text)).alias("key"), text.alias("text"), doc_id.alias("doc_id"))


def linked_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, sets), both stored: (doc_id, key, n, high, low) of every row of ``docs``, and of every distinct set that is not
    empty (h, l, key, least_id, component): where its text is found, its smallest doc_id, and the number that all sets share
    which links tie together."""
    own = _keyed(docs)
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    profile = stored(profiles(own, parts), "profiles")
    rows = stored(profile.filter("part = -1").select("doc_id", "key", "n", "high", "low"), "rows")
    sets = rows.filter("n > 0").groupBy("high", "low").agg(F.min("key").alias("key"), F.min("doc_id").alias("least_id"), F.first("n").alias("n"))
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "distinct")
    repeated = not rows.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").isEmpty()
    listed = candidate_sets(own, sets, profile, repeated)
    forget(profile)
    entries = stored(rarest_first(listed), "entries")
    near, linked = links_to_pivots(entries, listed)
    regions, parts_now = components(near, "regions"), components(linked, "parts")
    more = stored(links_within_regions(listed, regions, parts_now), "more")
    forget(listed, entries)
    whole = components(linked.union(more), "components")
    classes = stored(whole.select(F.col("node").alias("of_node"), "component"), "classes")
    named = sets.join(few_or_shuffled(classes, BROADCAST_ROWS), F.col("node") == F.col("of_node"), "left").select(
        F.col("high").alias("h"), F.col("low").alias("l"), "key", "least_id", F.coalesce("component", "node").alias("component")
    )
    return rows, stored(named, "named")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Texts of fewer than five words are one shingle, texts without words none; those are linked with nothing. Equal sets are
    one node from the start, so copies never meet each other. Rows are linked by their texts alone, whether doc_ids repeat or
    are null; ``component_id`` is the smallest doc_id that is not null among the linked rows, null if there is none. Other
    columns are left out. An empty table gives no rows.
    """
    rows, sets = linked_sets(docs)
    least = sets.groupBy("component").agg(F.min("least_id").alias("component_id")).withColumnRenamed("component", "of_component")
    named = sets.join(least, F.col("component") == F.col("of_component")).select("h", "l", "component_id")
    # Copies make a fingerprint frequent: the join is on one row per fingerprint, and adaptive execution splits the other side.
    found = rows.join(named, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")), "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


@F.arrow_udf(BinaryType())
def _mark(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text's set, as ``profiles`` has it."""
    return pa.array([xxhash.xxh3_128_digest(shingle_set((t or "").encode()).tobytes()) for t in texts.to_pylist()], pa.binary())


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row, with all its columns, of each group of rows that links tie together: that with the smallest doc_id.

    Links alone drop rows: of different texts with one doc_id both stay, of equal texts without doc_ids one does, and rows
    without words all stay. A null doc_id comes after all others; among equal rows any one stays. An empty table stays empty.
    """
    rows, sets = linked_sets(docs)
    # A group's set with the smallest id, and the key under which a row with it is found.
    order = F.struct(F.col("least_id").isNull(), "least_id", "key", "h", "l")
    chosen = sets.groupBy("component").agg(F.min(order).alias("c")).select(
        F.coalesce("c.least_id", "c.key").alias("key"), F.col("c.h").alias("high"), F.col("c.l").alias("low")
    )
    empty = rows.filter("n = 0").select("key", F.lit(None).cast("bigint").alias("high"), F.lit(None).cast("bigint").alias("low")).distinct()
    # Keys that several rows share are told apart by their texts; usually there are none.
    shared = stored(rows.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key"), "shared")
    wanted = stored(chosen.unionByName(empty), "wanted")
    key, mark = (fresh(docs, name) for name in ("kept_key", "kept_mark"))
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string"))))
    alone = wanted.join(few_or_shuffled(shared, BROADCAST_ROWS), "key", "left_anti").select(F.col("key").alias(key))
    single = keyed.join(few_or_shuffled(stored(alone, "alone"), BROADCAST_ROWS), key, "left_semi").drop(key)
    if shared.isEmpty():
        return single
    several = keyed.join(few_or_shuffled(shared.select(F.col("key").alias(key)), BROADCAST_ROWS), key, "left_semi")
    several = several.withColumn(mark, _mark(F.col("text").cast("string")))
    blank = several.filter(F.col(mark) == F.lit(xxhash.xxh3_128_digest(b""))).drop(key, mark)
    marks = wanted.join(few_or_shuffled(shared, BROADCAST_ROWS), "key", "left_semi").filter("high IS NOT NULL")
    halves = [F.lpad(F.hex(F.col(c).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0") for c in ("high", "low")]
    marks = marks.select(F.col("key").alias(key), F.unhex(F.concat(*halves)).alias(mark))
    first = several.join(marks, [key, mark], "left_semi").dropDuplicates([key, mark]).drop(key, mark)
    return single.unionByName(blank).unionByName(first)
