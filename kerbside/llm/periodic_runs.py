"""Periodic run detection: runs of each whole text's words, and the text with every run cut down to its first period."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.grammar_runs import runs
from kerbside.llm.tables import id_and_bytes

# Bytes of texts that go through the grammar together.
BATCH_BYTES = 2 << 20
SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, n_words bigint, n_dropped bigint"
)
Words = list[bytes]


def as_they_are(doc_id: int | None, words: Words) -> Words:
    return words


def with_planted_runs(doc_id: int | None, words: Words) -> Words:
    """The contract's words: of documents whose checksum ends in 0 the rest from some word on repeats its first part."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def numbered(texts: list[Words]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words of all texts, end of each text): equal words of a text have one number, no two texts share any."""
    numbers, ends, used, at = [], [], 0, 0
    for words in texts:
        own = dict.fromkeys(words)
        for word in own:
            own[word] = used
            used += 1
        numbers.append(np.fromiter(map(own.__getitem__, words), np.int64, len(words)))
        at += len(words)
        ends.append(at)
    return np.concatenate([np.empty(0, np.int64), *numbers]), np.array(ends, np.int64)


def digest(words: Words, found: list[tuple[int, int, int]], dropped: np.ndarray | None) -> tuple:
    """The contract's columns for one text and its runs (start, length, period)."""
    top: tuple = (None,) * 4
    if found:
        start, length, period = found[0]
        for s, n, q in found[1:]:
            if n * period > length * q:
                start, length, period = s, n, q
        top = (start, length, period, 1000 * length // period)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = words if dropped is None else [w for w, gone in zip(words, dropped.tolist()) if not gone]
    return (
        len(found), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
        len(words), len(words) - len(kept),
    )


def periodic_runs(docs: DataFrame, words_of: Callable[[int | None, Words], Words] = as_they_are) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its number of runs, the run of the most periods (ties: the first, then the
    shortest period; four nulls without a run), and digests of all runs and of the text without what runs repeat.

    Words stand between ASCII white space. A run is a stretch of at least 24 words and three of its smallest periods that no
    neighbouring word goes on with. ``words_of`` may replace the words of a document. A null, empty or blank text has no words
    and no runs; rows with equal or null doc_ids are judged each for itself; other columns are left out; an empty table gives
    no rows. Texts are judged by the task that reads them, without a shuffle, some megabytes at a time; a longer text takes
    about 400 bytes of memory a word.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in id_and_bytes(batches, BATCH_BYTES):
            words = [words_of(doc, text.split()) for doc, text in zip(ids, texts)]
            numbers, ends = numbered(words)
            begin, end, period = runs(numbers, ends)
            change = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(change, begin + period, 1)
            np.add.at(change, end, -1)
            repeats = np.cumsum(change)[:-1] > 0
            cuts = np.searchsorted(begin, np.r_[0, ends])
            rows = []
            for nth, own in enumerate(words):
                start, a, b = int(ends[nth]) - len(own), cuts[nth], cuts[nth + 1]
                found = list(zip((begin[a:b] - start).tolist(), (end[a:b] - begin[a:b]).tolist(), period[a:b].tolist()))
                rows.append((ids[nth], *digest(own, found, repeats[start : start + len(own)] if found else None)))
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(judged, SCHEMA)
