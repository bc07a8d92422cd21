"""Removal of long byte strings that occur more than once in a corpus (suffix-array deduplication).

One suffix array of a whole corpus cannot be built in parts, but its long common prefixes can: every string of ``least`` bytes
holds an anchor, the ``ANCHOR``-byte string in it with the least hash, and equal strings hold equal anchors at equal places. So
each start of a string belongs to one run of starts with one anchor, and two equal strings meet under their anchor:

1. runs are listed for each distinct text; anchors of a single run drop out, which is nearly all of them;
2. the bytes around the runs left are compared within their anchor: equal contexts settle each other, what no other context
   could reach is trimmed off;
3. what is left goes, by anchor, into buckets of bounded size. A bucket's Burrows-Wheeler transform is expanded up to ``least``
   letters, and starts that share that much with a neighbour are repeats. Anchors with more contexts than a bucket should
   hold count every start's string by its hash instead, which combines before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.bwt import repeated_starts
from kerbside.llm.tables import few_or_shuffled, forget, fresh, id_and_bytes, stored
from kerbside.llm.words import mixed

LEAST, ANCHOR = 200, 50
# Fixed: the multiplier of the rolling hash, odd so that it has an inverse.
BASE = 0x9E3779B97F4A7C15
PLACE_BITS = 28
# Bytes of contexts in a bucket, and contexts of one anchor from which on its starts are counted by hash.
BUCKET_BYTES, HOT_CONTEXTS = 2 << 20, 20_000
BROADCAST_ROWS = 500_000


def anchor_runs(data: np.ndarray, least: int = LEAST, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(anchor hash at each place, place of the anchor of the string that starts at each place)."""
    n, wide = len(data), least - size + 1
    powers = np.full(n, BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    inverse = np.full(n - size + 1, pow(BASE, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers, out=sums[1:])
    hashes = mixed((sums[size:] - sums[:-size]) * inverse)
    # The hash above, the place below: the least value names the least hash and, among equal ones, the first place.
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.concatenate([keys, np.full(-len(keys) % wide, ~np.uint64(0))]).reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(keys) - wide + 1
    return hashes, (np.minimum(behind[:starts], ahead[wide - 1 : len(keys)]) & low).astype(np.int64)


def runs_of(texts: list[bytes], least: int = LEAST) -> list[tuple[np.ndarray, ...]]:
    """(anchors, their places, first starts, numbers of starts) of each text."""
    lengths = np.array([len(t) for t in texts])
    nothing = np.empty(0, np.int64)
    out = [(nothing,) * 4] * len(texts)
    if lengths.sum() < least:
        return out
    ends = np.cumsum(lengths)
    hashes, anchor = anchor_runs(np.frombuffer(b"".join(texts), np.uint8), least)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + least <= ends[owner])
    place, doc = anchor[starts], owner[starts]
    cut = np.flatnonzero(np.r_[len(starts) > 0, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])
    counts = np.diff(np.r_[cut, len(starts)])
    base = (ends - lengths)[doc[cut]]
    columns = hashes[place[cut]].view(np.int64), place[cut] - base, starts[cut] - base, counts
    edges = np.searchsorted(doc[cut], np.arange(len(texts) + 1))
    return [tuple(c[a:b] for c in columns) for a, b in zip(edges[:-1], edges[1:])]


def text_runs(docs: DataFrame, least: int) -> DataFrame:
    """(node, n_bytes, copies, doc_id, runs) of each distinct text; a node is the hash of a text. A stored table."""
    piece = 1 << 20  # each byte takes about a hundred while its runs are found

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "node", "anchors", "places", "starts", "counts"]
        for keys, texts in id_and_bytes(batches, piece):
            runs = runs_of(texts, least)
            lists = [pa.array([r[k] for r in runs], pa.list_(kind)) for k, kind in enumerate((pa.int64(), *[pa.int32()] * 3))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k["doc_id"] for k in keys], pa.int64()),
                    pa.array(map(len, texts), pa.int64()),
                    pa.array([k["node"] for k in keys], pa.int64()),
                    *lists,
                ],
                names,
            )

    schema = "doc_id bigint, n_bytes bigint, node bigint, anchors array<bigint>, places array<int>, starts array<int>, counts array<int>"
    keyed = docs.select(F.struct("doc_id", "node").alias("keys"), "text")
    rows = stored(keyed.mapInArrow(listed, schema), "runs")
    zipped = F.arrays_zip("anchors", "places", "starts", "counts")
    grouped = rows.groupBy("node", "n_bytes").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first(zipped).alias("runs")
    )
    texts = stored(grouped, "texts")
    forget(rows)
    return texts


def shared_contexts(docs: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """(anchor, mark, node, start, size, at, weight, context) of each run whose anchor other runs have too. Stored.

    ``mark`` is the context's hash; a batch sends the bytes of equal contexts once.
    """
    runs = texts.select("node", "doc_id", "copies", F.inline("runs"))
    runs = runs.select("node", "doc_id", "copies", *[F.col(a).alias(b) for a, b in (("anchors", "anchor"), ("places", "place"), ("starts", "start"), ("counts", "starts"))])
    often = runs.groupBy("anchor").agg(F.count("*").alias("runs")).filter("runs > 1").select("anchor")
    hits = runs.join(often, "anchor").groupBy("node", "doc_id", "copies").agg(
        F.collect_list(F.struct("anchor", "place", "start", "starts")).alias("hits")
    )
    hits = stored(hits, "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "mark", "node", "start", "size", "at", "weight", "context"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            copies, hit = (batch.column(k).to_pylist() for k in (2, 3))
            at, rows, sent = 0, [], set()
            for nodes, pieces in id_and_bytes([batch.select([0, 1])]):
                for node, text in zip(nodes, pieces):
                    weight, own = copies[at], hit[at]
                    at += 1
                    for h in own:
                        context = text[h["start"] : h["start"] + h["starts"] + least - 1]
                        mark = xxhash.xxh3_64_intdigest(context) - (1 << 63)
                        known = (h["anchor"], mark) in sent
                        sent.add((h["anchor"], mark))
                        rows.append((h["anchor"], mark, node, h["start"], len(context), h["place"] - h["start"], weight, None if known else context))
                    if len(rows) > 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, sent = [], set()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    wanted = docs.join(few_or_shuffled(stored(hits.select("node"), "wanted"), BROADCAST_ROWS), "node", "left_semi")
    # One row of each text: the one with the doc_id that its node has kept.
    first = hits.withColumnRenamed("node", "of_node").withColumnRenamed("doc_id", "of_doc")
    joined = wanted.join(first, (F.col("node") == F.col("of_node")) & F.col("doc_id").eqNullSafe(F.col("of_doc")))
    joined = joined.select("node", "text", "copies", "hits")
    schema = "anchor bigint, mark bigint, node bigint, start int, size int, at int, weight bigint, context binary"
    found = stored(joined.mapInArrow(cut, schema), "contexts")
    forget(hits)
    return found


def _reach(sides: list[bytes], groups: list[bytes], width: int) -> np.ndarray:
    """How many bytes of each side the side most like it in its group shares with it, from the anchor outwards."""
    rows = np.frombuffer(b"".join(g + s.ljust(width, b"\0") for g, s in zip(groups, sides)), np.uint8).reshape(len(sides), -1)
    order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
    ranked = rows[order]
    same = ranked[1:] == ranked[:-1]
    shared = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1)) - 8
    best = np.zeros(len(sides), np.int64)
    best[order] = np.maximum(np.r_[shared, -8], np.r_[-8, shared])
    return np.minimum(best, [len(s) for s in sides])


def bucket_repeats(table: pa.Table, least: int = LEAST) -> pa.Table:
    """(anchor, mark, begin, end): byte ranges of a bucket's contexts that lie in repeated strings."""
    anchors, marks, at, weights = (table[c].to_pylist() for c in ("anchor", "mark", "at", "weight"))
    contexts = table["context"].to_pylist()
    out: list[tuple[int, int, int, int]] = []
    groups = [a.to_bytes(8, "big", signed=True) for a in anchors]
    left = _reach([c[:p][::-1] for c, p in zip(contexts, at)], groups, least - ANCHOR)
    right = _reach([c[p + ANCHOR :] for c, p in zip(contexts, at)], groups, least - ANCHOR)
    trimmed: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
    for k, context in enumerate(contexts):
        begin, end = int(at[k] - left[k]), int(at[k] + ANCHOR + right[k])
        if weights[k] > 1:
            out.append((anchors[k], marks[k], 0, len(context)))
        if end - begin >= least:
            trimmed.setdefault((anchors[k], context[begin:end]), []).append((k, begin))
    alone = set()
    for (anchor, string), members in trimmed.items():
        if len(members) > 1:
            out += [(anchor, marks[k], begin, begin + len(string)) for k, begin in members if weights[k] == 1]
        elif weights[members[0][0]] == 1:
            alone.add(anchor)
    strings = [key for key in trimmed if key[0] in alone]
    if strings:
        for key, starts in zip(strings, repeated_starts([s for _, s in strings], least)):
            members = trimmed[key]
            if len(members) == 1 and len(starts):
                k, begin = members[0]
                for a, b in _merged([(int(s), int(s) + least) for s in starts]):
                    out.append((key[0], marks[k], begin + a, begin + b))
    columns = list(zip(*out)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "mark", "begin", "end"])


def _merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Ranges as maximal runs: those that touch or overlap are one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def hot_repeats(contexts: DataFrame, least: int) -> DataFrame:
    """As ``bucket_repeats`` for anchors with very many contexts: each start's string is counted by a 128-bit hash."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "mark", "begin", "high", "low", "weight"]
        for batch in batches:
            for anchor, mark, context, weight in zip(*(batch.column(c).to_pylist() for c in ("anchor", "mark", "context", "weight"))):
                n = max(0, len(context) - least + 1)
                hashes = [xxhash.xxh3_128_intdigest(context[i : i + least]) for i in range(n)]
                columns = [[anchor] * n, [mark] * n, range(n), [(h >> 64) - (1 << 63) for h in hashes], [(h & (1 << 64) - 1) - (1 << 63) for h in hashes], [weight] * n]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    starts = contexts.select("anchor", "mark", "context", "weight").mapInArrow(
        opened, "anchor bigint, mark bigint, begin bigint, high bigint, low bigint, weight bigint"
    )
    often = starts.groupBy("high", "low").agg(F.sum("weight").alias("times")).filter("times > 1").select("high", "low")
    begin = F.col("begin").cast("int")
    return starts.join(often, ["high", "low"]).select("anchor", "mark", begin.alias("begin"), (begin + least).alias("end"))


def repeated_ranges(docs: DataFrame, texts: DataFrame, least: int, hot: int = HOT_CONTEXTS) -> DataFrame:
    """(node, begin, end): byte ranges of texts with a single copy that lie in repeated strings. A stored table."""
    found = shared_contexts(docs, texts, least)
    distinct = stored(
        found.groupBy("anchor", "mark").agg(F.sum("weight").alias("weight"), F.first("at").alias("at"), F.max("size").alias("size"), F.first("context", True).alias("context")),
        "distinct",
    )
    groups = distinct.groupBy("anchor").agg(F.count("*").alias("contexts"), F.min("weight").alias("least_weight"))
    groups = stored(groups, "anchors")
    settled = distinct.filter("weight > 1").select("anchor", "mark", F.lit(0).alias("begin"), F.col("size").alias("end"))
    unsettled = groups.filter("contexts > 1 AND least_weight = 1")
    total = distinct.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, total // BUCKET_BYTES + 1)
    open_contexts = distinct.join(unsettled, "anchor")
    few = open_contexts.filter(F.col("contexts") <= hot).withColumn("bucket", F.pmod("anchor", F.lit(buckets)))
    by_transform = few.groupBy("bucket").applyInArrow(
        lambda table: bucket_repeats(table, least), "anchor bigint, mark bigint, begin int, end int"
    )
    ranges = settled.union(by_transform)
    if groups.filter(F.col("contexts") > hot).limit(1).count():
        ranges = ranges.union(hot_repeats(open_contexts.filter(F.col("contexts") > hot), least))
    ranges = ranges.groupBy("anchor", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    single = found.filter("weight = 1").select("anchor", "mark", "node", "start")
    placed = single.join(ranges, ["anchor", "mark"]).select("node", "start", F.explode("ranges").alias("r"))
    spots = placed.select("node", (F.col("start") + F.col("r.begin")).alias("begin"), (F.col("start") + F.col("r.end")).alias("end"))
    spots = stored(spots, "spots")
    forget(found, distinct)
    return spots


def with_spans(docs: DataFrame, least: int = LEAST, hot: int = HOT_CONTEXTS) -> DataFrame:
    """The rows of ``docs`` with ``repeat_spans`` (under a longer name if a column has this one), the byte ranges [begin, end)
    to remove, or null where there are none.

    Strings are judged on the texts as they are given, not on what is left; matches never cross texts.
    """
    node, spans = fresh(docs, "repeat_node"), fresh(docs, "repeat_spans")
    keyed = docs.withColumn(node, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    own = keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(node).alias("node"))
    texts = text_runs(own, least)
    single = repeated_ranges(own, texts.filter(F.col("n_bytes") >= least), least, hot)
    # A text with copies is repeated as a whole.
    copied = texts.filter((F.col("copies") > 1) & (F.col("n_bytes") >= least))
    whole = copied.select("node", F.lit(0).alias("begin"), F.col("n_bytes").cast("int").alias("end"))
    cuts = single.union(whole).groupBy("node").agg(F.collect_set(F.struct("begin", "end")).alias(spans))
    cuts = stored(cuts.withColumnRenamed("node", node), "cuts")
    forget(texts, single)
    nodes = few_or_shuffled(stored(cuts.select(node), "cut_nodes"), BROADCAST_ROWS)
    cut = keyed.join(nodes, node, "left_semi").join(cuts, node)
    left = keyed.join(nodes, node, "left_anti").withColumn(spans, F.lit(None).cast(cuts.schema[spans].dataType))
    return cut.unionByName(left).drop(node)


def _kept(text: bytes, spans: list[list[int]]) -> bytes:
    ends = [0, *[b for _, b in spans]]
    return b"".join(text[a:b] for a, b in zip(ends, [*[a for a, _ in spans], len(text)]))


def removal_digest(docs: DataFrame, least: int = LEAST, hot: int = HOT_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs`` (doc_id, text).

    A null text counts as empty; an empty or short text loses nothing. Rows with a repeated or null doc_id are texts of their
    own, so a repeated row loses all its bytes where it has ``least`` or more. Other columns are left out.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        for keys, texts in id_and_bytes(batches):
            rows = []
            for key, text in zip(keys, texts):
                spans = _merged([(s["begin"], s["end"]) for s in key["repeat_spans"] or []])
                kept = _kept(text, spans)
                rows.append((key["doc_id"], len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = with_spans(own, least, hot).select(F.struct("doc_id", "repeat_spans").alias("keys"), "text")
    return keyed.mapInArrow(digested, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, least: int = LEAST, hot: int = HOT_CONTEXTS) -> DataFrame:
    """The rows and columns of ``docs`` with repeated strings cut from ``text``.

    A cut may fall inside a character: what is left of it goes too, so that the text stays valid. A null text stays null, and a
    text that is cut whole stays as an empty one.
    """

    names, extra = list(docs.columns), fresh(docs, "repeat_spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index(extra)).to_pylist()
            at = batch.schema.get_field_index("text")
            texts = [
                t if t is None or not s else _kept(t.encode(), _merged([(x["begin"], x["end"]) for x in s])).decode(errors="ignore")
                for t, s in zip(batch.column(at).to_pylist(), spans)
            ]
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_spans(docs, least, hot).mapInArrow(cut, docs.schema)
