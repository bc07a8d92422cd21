"""Benchmark decontamination: a prefix-filtered set join of documents with windows of benchmark items.

A window occurs in a document only if every shingle of it does, so one shingle is enough to find it: the rarest one among all
windows. Documents look their shingles up among these; a match says where the window would have to lie, the bounds of the
document are checked, then every word of the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import id_and_bytes
from kerbside.llm.words import shingles, word_hashes

WINDOW, SHINGLE = 10, 5
# Windows that one pass over the documents looks for: 2 ** 20 of them are about 100 MB in a worker. More take more passes.
WINDOWS_A_PASS = 1 << 20
# Words are runs of ASCII letters and digits and of all other characters above ASCII.
_WORD_BYTES = bytes(b if chr(b).isascii() and chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def contract_words(text: bytes) -> list[bytes]:
    return text.lower().translate(_WORD_BYTES).split()


def _windows(items: list[tuple[str, bytes]]) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """(words of each distinct window as hashes padded with 0, its length, the items that hold it)."""
    found: dict[bytes, list[str]] = {}
    for item, text in items:
        hashes = word_hashes(contract_words(text))
        size = min(WINDOW, len(hashes))
        for at in range(len(hashes) - size + 1 if size else 0):
            holders = found.setdefault(hashes[at : at + size].tobytes(), [])
            if not holders or holders[-1] != item:
                holders.append(item)
    table = np.zeros((len(found), WINDOW), np.uint64)
    for row, key in zip(table, found):
        own = np.frombuffer(key, np.uint64)
        row[: len(own)] = own
    return table, np.array([len(k) // 8 for k in found], np.int64), list(found.values())


class Lookup:
    """Windows by their rarest shingle: sorted keys, and for each the windows and the shingle's place in them."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.words, self.length, self.items = _windows(items)
        own = [shingles(w[:n], SHINGLE) for w, n in zip(self.words, self.length)]
        every, counts = np.unique(np.concatenate([np.unique(s) for s in own]), return_counts=True) if own else (np.empty(0, np.uint64), np.empty(0))
        chosen = [int(np.lexsort((s, counts[np.searchsorted(every, s)]))[0]) for s in own]
        keys = np.array([s[c] for s, c in zip(own, chosen)], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.place, self.window = keys[order], np.array(chosen, np.int64)[order], order
        # Windows shorter than a shingle: their lengths, so that documents make runs of these lengths too.
        self.short = sorted({int(n) for n in self.length if n < SHINGLE})
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def starts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place in the document) of every occurrence."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for size in [*self.short, SHINGLE]:
            if size > len(hashes):
                continue
            own = shingles(hashes, size)
            maybe = np.flatnonzero(self.filter[(own & np.uint64((1 << 20) - 1)).astype(np.int64)])
            low, high = np.searchsorted(self.keys, own[maybe]), np.searchsorted(self.keys, own[maybe], "right")
            times = high - low
            at = np.repeat(maybe, times)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
            window, start = self.window[nth], at - self.place[nth]
            fits = (start >= 0) & (start + self.length[window] <= len(hashes))
            window, start = window[fits], start[fits]
            words = hashes[np.minimum(start[:, None] + np.arange(WINDOW), len(hashes) - 1)]
            beyond = np.arange(WINDOW) >= self.length[window][:, None]
            same = ((words == self.words[window]) | beyond).all(axis=1)
            found.append((window[same], start[same]))
        return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def slices_of(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Items in lists of at most ``WINDOWS_A_PASS`` windows (or of one item that has more), read one after the other."""
    held, windows = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8"))
    for item, text in rows.filter(F.col("item_id").isNotNull()).toLocalIterator():
        size = max(1, len(contract_words(bytes(text))) - WINDOW + 1)
        if held and windows + size > WINDOWS_A_PASS:
            yield held
            held, windows = [], 0
        held.append((item, bytes(text)))
        windows += size
    yield held


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) for every row of ``docs`` (doc_id, text).

    Items (item_id, text) of fewer than ten words are one window, items without words none; items without an id are left out,
    items that share one are one item. A null text has no words. Rows that share a doc_id are checked each for itself; other
    columns are left out. Empty tables: no rows, or nothing contaminated.

    Each broadcast holds one slice of the benchmark. A benchmark of several slices takes one step after the other over the same
    rows, which carry the words hit so far (a bit each) and the items found so far.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    state = F.struct(F.lit(None).cast("binary").alias("hit"), F.lit(None).cast("array<string>").alias("items"))
    rows = docs.select(F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), state.alias("state")).alias("keys"), text.alias("text"))
    schema = "keys struct<doc_id: bigint, state: struct<hit: binary, items: array<string>>>, text string"
    slices = slices_of(benchmark)
    held, coming = next(slices), next(slices, None)
    while coming is not None:
        rows = rows.mapInArrow(_step(docs.sparkSession.sparkContext.broadcast(held), False), schema)
        held, coming = coming, next(slices, None)
    digest = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, items array<string>"
    return rows.mapInArrow(_step(docs.sparkSession.sparkContext.broadcast(held), True), digest)


def _step(items, last: bool):
    """Adds the hits of one slice of items to the rows; the last step turns them into the result."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(items.value)
        for keys, texts in id_and_bytes(batches):
            rows = []
            for key, text in zip(keys, texts):
                hashes = word_hashes(contract_words(text))
                n = len(hashes)
                before = key["state"]["hit"]
                hit = np.zeros(n, bool) if before is None else np.unpackbits(np.frombuffer(before, np.uint8), count=n).astype(bool)
                found = set(key["state"]["items"] or [])
                windows, starts = lookup.starts(hashes)
                for window, start in zip(windows.tolist(), starts.tolist()):
                    hit[start : start + lookup.length[window]] = True
                    found.update(lookup.items[window])
                named = sorted(found)
                if last:
                    digest = hashlib.sha256(",".join(named).encode()).hexdigest()
                    rows.append((key["doc_id"], n, int(hit.sum()), len(named), digest, bool(hit.any()), named))
                else:
                    rows.append((key["doc_id"], np.packbits(hit).tobytes(), named))
            columns = list(zip(*rows))
            if last:
                kinds = [*[pa.int64()] * 4, pa.string(), pa.bool_(), pa.list_(pa.string())]
                names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            else:
                state = pa.StructArray.from_arrays([pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.list_(pa.string()))], ["hit", "items"])
                carried = pa.StructArray.from_arrays([pa.array(columns[0], pa.int64()), state], ["doc_id", "state"])
                yield pa.RecordBatch.from_arrays([carried, pa.array([t.decode() for t in texts], pa.string())], ["keys", "text"])

    return step


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` in which no window of any item occurs. Null texts stay."""

    def cleared(items):
        def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = Lookup(items.value)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                clean = [not len(lookup.starts(word_hashes(contract_words((t or "").encode())))[0]) for t in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return clear

    for held in slices_of(benchmark):
        docs = docs.mapInArrow(cleared(docs.sparkSession.sparkContext.broadcast(held)), docs.schema)
    return docs
