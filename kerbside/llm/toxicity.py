"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values.

Log-odds of a token compare its counts in toxic and other labelled documents, with the counts of both as an informative
Dirichlet prior. Copies of a document count once, and only tokens whose counts differ by more than the chance of all tokens
together allows have a score. Scores of ordinary tokens are negative on average, so sums over passages are local. One linear
scan finds every maximal segment; a segment's score S counts by how unlikely the best of a text of n tokens is to reach it
by chance, which falls as n * exp(-lambda * S).
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import forget, id_and_bytes, stored

# The classifier is fitted on at most about this many labelled documents (by the hash of their ids, per label).
FITTED_DOCUMENTS = 20_000
# Tokens with a score of their own: at most so many, seen in so many documents; so many of them by chance, as expected.
SCORED_TOKENS, LEAST_DOCUMENTS, CHANCE_TOKENS = 100_000, 3, 0.05
# Copies are found by bands of least hashes over runs of so many tokens: 0.999 of those that share 0.8 of their runs, 0.74 of
# those that share half of them, 0.08 of those that share a fifth.
RUN_TOKENS, COPY_BANDS, BAND_HASHES = 5, 10, 3
# Bytes of the stems that stand in for a word without a score, longest first.
STEMS = (7, 6, 5, 4)
PRIOR_WEIGHT, SIGNIFICANT = 10.0, 0.05
# Evidence beyond this adds nothing to a score.
MOST_EVIDENCE = 60.0
# Words are runs of ASCII letters and digits, of characters above ASCII, and of exclamation marks with what they follow.
_WORD_BYTES = bytes(b if chr(b).isascii() and chr(b).isalnum() or b >= 128 or b == 33 else 32 for b in range(256))
SHOUTED = b"*!!"


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learnt from: crc32 of the id as text leaves no rest mod 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_WORD_BYTES).split()


def stand_ins(token: bytes) -> list[bytes]:
    """What is scored in place of a token without a score, in this order: a mark of shouting, then its stems."""
    stems = [token[:n] + b"*" for n in STEMS if len(token) >= n]
    return [SHOUTED, *stems] if b"!!" in token else stems


def log_odds(table: list[tuple[bytes, int, int]], toxic: int, other: int) -> dict[bytes, float]:
    """Scores of tokens from their document counts under either label.

    A token's prior is its share of all documents, worth ``PRIOR_WEIGHT`` documents.
    """
    scores = {}
    for token, a, b in table:
        prior = PRIOR_WEIGHT * (a + b) / (toxic + other)
        here, there = a + prior, b + prior
        weight = math.log(here / max(1e-9, toxic + PRIOR_WEIGHT - here)) - math.log(there / max(1e-9, other + PRIOR_WEIGHT - there))
        scores[token] = max(-4.0, min(8.0, weight))
    return scores


def likelihood_ratio(toxic: int, other: int) -> Column:
    """Twice the log likelihood ratio of different and equal rates of a token in ``toxic`` and ``other`` documents.

    Unlike log-odds over their deviation it is also right for tokens that one label never has. Tokens with equal rates reach
    a value of x with a chance below exp(-x / 2).
    """
    seen = F.col("toxic") + F.col("other")
    cells = [(F.col("toxic"), seen * toxic), (F.col("other"), seen * other)]
    cells += [(toxic - F.col("toxic"), (toxic + other - seen) * toxic), (other - F.col("other"), (toxic + other - seen) * other)]
    terms = [F.when(n > 0, n * F.log(n * (toxic + other) / expected)).otherwise(0.0) for n, expected in cells]
    return 2 * (terms[0] + terms[1] + terms[2] + terms[3])


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [begin, end) with positive sums, in one pass (Ruzzo and Tompa).

    Only positive scores open or close a segment, so the pass visits them alone, with sums of all scores before them.
    """
    before = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[list] = []  # [begin, end, sum before, sum after]
    back: list[int] = []  # for each the nearest earlier one whose sum before is smaller, or -1
    for at in np.flatnonzero(scores > 0).tolist():
        own = [at, at + 1, before[at], before[at + 1]]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= own[2]:
                j = back[j]
            if j < 0 or found[j][3] >= own[3]:
                found.append(own)
                back.append(j)
                break
            own = [found[j][0], own[1], found[j][2], own[3]]
            del found[j:], back[j:]
    return [(b, e, float(after - start)) for b, e, start, after in found]


def decay(values: list[tuple[float, float]]) -> float:
    """The lambda > 0 with sum of p * exp(lambda * s) = 1 over (score, probability); scores must be negative on average."""
    low, high = 1e-6, 1.0
    total = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in values)
    while total(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return (low + high) / 2


class Model:
    """Token scores, the score of all other tokens, the decay and the constant of the extreme values, and the calibration."""

    def __init__(self, scores: dict[bytes, float], drift: float, decay_: float = 1.0, constant: float = 1.0):
        self.scores, self.drift, self.decay, self.constant = scores, drift, decay_, constant
        self.weights = (-3.0, 0.0, 0.0, 0.0)
        self.cache: dict[bytes, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def of_tokens(self, tokens: list[bytes]) -> np.ndarray:
        cache = self.cache
        if len(cache) > 500_000:
            cache.clear()
        for t in set(tokens).difference(cache):
            cache[t] = next((self.scores[x] for x in (t, *stand_ins(t)) if x in self.scores), self.drift)
        return np.fromiter(map(cache.__getitem__, tokens), float, len(tokens))

    def features(self, tokens: list[bytes]) -> tuple[float, float, list[tuple[int, int, float, float]]]:
        """(evidence of the best segment, of all significant ones, these as [begin, end), score, chance)."""
        if not tokens:
            return 0.0, 0.0, []
        size = self.constant * len(tokens)
        best, total, passages = 0.0, 0.0, []
        for begin, end, score in maximal_segments(self.of_tokens(tokens)):
            expected = size * math.exp(-self.decay * score)
            evidence = math.log1p(1 / max(expected, 1e-12))
            best = max(best, evidence)
            if expected <= SIGNIFICANT:
                total += evidence
                passages.append((begin, end, score, -math.expm1(-expected)))
        return best, total, passages

    def score(self, best: float, total: float) -> float:
        a, *others = self.weights
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + sum(w * x for w, x in zip(others, measures(best, total)))))))


def measures(best: float, total: float) -> tuple[float, float, float]:
    """What the logistic weights apply to. Passages are as good as independent, so their evidence also counts as a sum."""
    return best, math.log1p(total), min(MOST_EVIDENCE, total)


def logistic(rows: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic regression with a small penalty, by Newton's method."""
    x = np.column_stack([np.ones(len(rows)), rows])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip((x * w).sum(axis=1), -60, 60)))
        slope = (x * (labels - p)[:, None]).sum(axis=0) - 0.01 * w
        bend = (x[:, :, None] * x[:, None, :] * (p * (1 - p))[:, None, None]).sum(axis=0) + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def copy_marks(tokens: list[bytes]) -> list[int]:
    """A mark for each band; texts that share most runs of tokens have one in common. Without tokens there are none."""
    if not tokens:
        return []
    last = max(1, len(tokens) - RUN_TOKENS + 1)
    runs = np.fromiter((zlib.crc32(b" ".join(tokens[i : i + RUN_TOKENS])) for i in range(last)), np.uint64, last)
    least = []
    for factor, shift in np.random.default_rng(5).integers(1 << 63, size=(COPY_BANDS * BAND_HASHES, 2), dtype=np.uint64):
        least.append(int(((runs * (factor | np.uint64(1)) + shift) >> np.uint64(20)).min()))
    bands = [least[i : i + BAND_HASHES] for i in range(0, len(least), BAND_HASHES)]
    digests = [hashlib.blake2b(repr((i, band)).encode(), digest_size=8).digest() for i, band in enumerate(bands)]
    return [int.from_bytes(x, "little", signed=True) for x in digests]


def without_copies(texts: DataFrame) -> DataFrame:
    """The rows of a stored (doc_id, label, text) table that are no copies of a row with another doc_id.

    Of rows that share a mark, those whose doc_id has the smallest hash stay, so something of every group is left. A toxic
    text with fifty copies would else make each of its rare words look toxic.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in id_and_bytes(batches):
            marks = [copy_marks(tokens_of(t)) for t in own]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.list_(pa.int64()))], ["doc_id", "marks"])

    marks = texts.select("doc_id", "text").mapInArrow(marked, "doc_id bigint, marks array<bigint>")
    # Of the training table alone: at most COPY_BANDS rows of two numbers for each of its documents.
    marks = stored(marks.select(F.col("doc_id").alias("of_doc"), F.explode("marks").alias("mark")), "marks")
    first = marks.groupBy("mark").agg(F.min(F.struct(F.xxhash64("of_doc").alias("order"), "of_doc")).alias("first"))
    copies = marks.join(first, "mark").filter(F.col("first.of_doc") != F.col("of_doc")).select("of_doc").distinct()
    kept = stored(texts.join(F.broadcast(copies), F.col("doc_id") == F.col("of_doc"), "left_anti"), "training")
    forget(marks)
    return kept


def training_texts(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(label, text) of labelled documents that are not held out, at most about ``most``, without copies; a stored table."""
    marks = labels.select(F.col("doc_id").cast("bigint").alias("of_doc"), F.col("toxic").cast("int").alias("label"))
    marks = marks.filter(~held_out(F.col("of_doc")) & F.col("label").isin(0, 1) & F.col("of_doc").isNotNull()).distinct()
    chosen = marks.orderBy(F.xxhash64("of_doc"), "of_doc", "label").limit(most)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most `most` rows of two numbers: bounded, so broadcast.
    labelled = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("of_doc")).select("doc_id", "label", "text")
    labelled = stored(labelled, "labelled")
    kept = without_copies(labelled)
    forget(labelled)
    return kept.select("label", "text")


def fitted(training: DataFrame) -> Model:
    """The model of a training table. Without documents of both labels nothing counts as toxic."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, texts in id_and_bytes(batches):
            counts: dict[bytes, list[int]] = {}
            for label, text in zip(labels, texts):
                own = set(tokens_of(text))
                for token in own.union(*map(stand_ins, own)):
                    counts.setdefault(token, [0, 0])[label] += 1
            kinds = (pa.binary(), pa.int64(), pa.int64())
            columns = [list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["token", "toxic", "other"])

    sizes = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return Model({}, -1.0)
    summed = training.mapInArrow(counted, "token binary, toxic bigint, other bigint").groupBy("token")
    summed = summed.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    often = stored(summed.filter(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS), "tokens")
    # Only tokens whose rates differ by more than chance leave the cluster, with regard to how many were compared.
    ratio, least = likelihood_ratio(toxic, other), 2 * math.log(max(1, often.count()) / CHANCE_TOKENS)
    top = often.filter(ratio >= least).orderBy(F.desc(ratio), "token").limit(SCORED_TOKENS).collect()
    forget(often)
    scores = log_odds([(bytes(r["token"]), r["toxic"], r["other"]) for r in top], toxic, other)
    model = Model(scores, -0.5)
    broadcast = training.sparkSession.sparkContext.broadcast(model)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rounded scores of the tokens of documents that are not toxic."""
        counts: dict[float, int] = {}
        for labels, texts in id_and_bytes(batches):
            for label, text in zip(labels, texts):
                if label == 0:
                    values, times = np.unique(np.round(broadcast.value.of_tokens(tokens_of(text)), 1), return_counts=True)
                    for v, n in zip(values.tolist(), times.tolist()):
                        counts[v] = counts.get(v, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.float64()), pa.array(list(counts.values()), pa.int64())], ["s", "n"])

    spread = training.mapInArrow(drawn, "s double, n bigint").groupBy("s").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in spread) or 1
    shares = [(r["s"], r["n"] / total) for r in spread]
    mean = sum(s * p for s, p in shares)
    # Sums over passages are local only if scores are negative on average and some are positive.
    model.cache = {}
    model.scores = {t: s - max(0.0, mean + 0.25) for t, s in scores.items()}
    model.drift -= max(0.0, mean + 0.25)
    shares = [(s - max(0.0, mean + 0.25), p) for s, p in shares]
    model.decay = decay(shares) if any(s > 0 and p > 0 for s, p in shares) else 1.0
    return calibrated(training, model)


def calibrated(training: DataFrame, model: Model) -> Model:
    """Sets the constant from the best segments of documents that are not toxic, then the logistic weights."""
    spark = training.sparkSession

    def measured(shared):
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for labels, texts in id_and_bytes(batches):
                own = [tokens_of(t) for t in texts]
                found = [shared.value.features(t) for t in own]
                best = [max((s for _, _, s in maximal_segments(shared.value.of_tokens(t))), default=0.0) for t in own]
                columns = [(labels, pa.int32()), ([f[0] for f in found], pa.float64()), ([f[1] for f in found], pa.float64()), (best, pa.float64()), (map(len, own), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in columns], ["label", "best", "total", "score", "n"])

        return training.mapInArrow(measure, "label int, best double, total double, score double, n bigint")

    # By the extreme-value law the mean of lambda * S - ln(n) is ln(K) plus Euler's constant.
    calm = measured(spark.sparkContext.broadcast(model)).filter("label = 0 AND n > 0")
    mean = calm.agg(F.avg(model.decay * F.col("score") - F.log("n"))).first()[0]
    model.constant = math.exp(max(-20.0, min(5.0, (mean or 0.0) - 0.5772156649)))
    # As many rows as the training table has: bounded by its parameter.
    rows = measured(spark.sparkContext.broadcast(model)).select("label", "best", "total").collect()
    data = np.array([measures(r["best"], r["total"]) for r in sorted(rows)], float)
    model.weights = logistic(data, np.array([r["label"] for r in sorted(rows)], float))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, most: int = FITTED_DOCUMENTS) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of every row of ``docs`` (doc_id, text), whole texts.

    ``labels`` (doc_id, toxic) may cover some documents; labels other than 0 and 1 and those of held-out documents are not
    learnt from. Null and empty texts get the score of a text without passages. Rows with a repeated doc_id are scored each
    for itself; a null doc_id is not held out. Other columns are left out. No labels: nothing is predicted toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted(training_texts(docs, labels, most)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        passage = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("chance", pa.float64())])
        for ids, texts in id_and_bytes(batches):
            found = [model.features(tokens_of(t)) for t in texts]
            rows = [[{"begin": b, "end": e, "score": s, "chance": p} for b, e, s, p in f[2]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([model.score(f[0], f[1]) for f in found], pa.float64()), pa.array(rows, pa.list_(passage))],
                ["doc_id", "score", "passages"],
            )

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = own.mapInArrow(scored, "doc_id bigint, score double, passages array<struct<begin: bigint, end: bigint, score: double, chance: double>>")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return result.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "passages")
