"""Quality by weak supervision: rules vote or abstain on an aspect of quality, expectation-maximisation estimates how far each
can be trusted, and the posterior probability of being good in every aspect decides. Built-in column functions only.

What leaves the cluster are counts of vote patterns: at most 3 ** rules rows, whatever the number of documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import stored

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
ROUNDS = 100
# Rules of one aspect depend on each other: they see the same fault.
ASPECTS = (
    ("vote_length", "vote_lines", "vote_repeats"),
    ("vote_word_size", "vote_digits"),
    ("vote_symbols",),
    ("vote_sentences",),
)


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window which occurs at least twice in the text."""

    def of_windows(hashes: Column) -> Column:
        # Windows sorted by content stand beside their equals; the places of those that have one, in text order.
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = _once(
            pairs,
            lambda p: F.sort_array(
                F.transform(
                    F.filter(p, lambda e, j: (e["h"] == F.get(p, j - 1)["h"]) | (e["h"] == F.get(p, j + 1)["h"])),
                    lambda e: e["i"],
                )
            ),
        )
        # A window covers three words, or as many as there are before the next one begins.
        return _once(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda at, j: F.least(F.lit(3), F.coalesce(F.get(s, j + 1) - at, F.lit(3)))),
                F.lit(0).cast("bigint"),
                lambda total, n: total + n,
            ),
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    counted = _once(
        windows,
        lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            of_windows(hashes)
        ),
    )
    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(counted)


def with_text_measures(docs: DataFrame) -> DataFrame:
    """(row, measures) for every row of ``docs``, which ``row`` holds; a null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"))
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+", -1), lambda w: w != "")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    split = base.select("row", "text", words.alias("words"), lines.alias("lines"))
    size = F.length("text").cast("bigint")
    return split.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (size - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (size - F.length(F.translate("text", ".!?", ""))).cast("bigint").alias("n_stops"),
        (size - F.length(F.translate("text", "0123456789", ""))).cast("bigint").alias("n_digits"),
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes() -> dict[str, Column]:
    """Each rule's vote on the measures: 1 for good, -1 for bad, 0 to abstain."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "vote_length": _vote(words < 50, words >= 100),
        "vote_word_size": _vote((chars < 3 * words) | (chars > 10 * words), words > 0),
        "vote_symbols": _vote(10 * F.col("n_symbols") > words, 100 * F.col("n_symbols") <= words),
        "vote_lines": _vote(10 * F.col("n_dup_lines") > 3 * F.col("n_lines"), F.col("n_dup_lines") == 0),
        "vote_repeats": _vote(10 * F.col("n_repeat_words") > 3 * words, 10 * F.col("n_repeat_words") <= words),
        "vote_sentences": _vote(F.col("n_stops") == 0, 100 * F.col("n_stops") >= words),
        "vote_digits": _vote(10 * F.col("n_digits") > 3 * chars, 20 * F.col("n_digits") <= chars),
    }


def estimated(patterns: list[tuple[tuple[int, ...], int]], rules: int) -> tuple[float, list[dict[int, float]]]:
    """(log-odds of good quality, per rule the log-likelihood ratio of each vote) if all rules judge one aspect."""
    priors, ratios = estimated_by_aspect(patterns, [list(range(rules))])
    return priors[0], ratios


def estimated_by_aspect(
    patterns: list[tuple[tuple[int, ...], int]], aspects: list[list[int]]
) -> tuple[list[float], list[dict[int, float]]]:
    """(per aspect the log-odds of good against bad in that aspect, per rule the log-likelihood ratio of each vote) by
    expectation-maximisation; ``aspects`` holds the places of each aspect's rules.

    A document is good or bad in one aspect. The rules of other aspects vote on it as on a good one, so that one decisive vote
    is not outweighed by good votes on other matters. Starts from rules that are right four times out of five. One vote of
    that kind is added to what was seen, so that no likelihood becomes zero. No rule gets worse than chance: a vote that would
    speak for the other side says nothing. No patterns: the start.
    """
    start = {1: {1: 0.8, -1: 0.1, 0: 0.1}, 0: {1: 0.1, -1: 0.8, 0: 0.1}}
    aspect_of = {j: a for a, own in enumerate(aspects) for j in own}
    rules = len(aspect_of)
    ratios = [{v: math.log(start[1][v] / start[0][v]) for v in (1, -1, 0)} for _ in range(rules)]
    shares = [0.8] + [0.2 / len(aspects)] * len(aspects)
    total = sum(n for _, n in patterns)
    for _ in range(ROUNDS if total else 0):
        soft = [{k: {v: start[k][v] for v in (1, -1, 0)} for k in (1, 0)} for _ in range(rules)]
        sums = [1.0] + [1.0 / len(aspects)] * len(aspects)
        for cast, n in patterns:
            odds = [math.log(shares[0] / shares[a + 1]) + sum(ratios[j][cast[j]] for j in own) for a, own in enumerate(aspects)]
            parts = [1.0] + [math.exp(-max(-500.0, min(500.0, o))) for o in odds]
            whole = sum(parts)
            for k, part in enumerate(parts):
                sums[k] += n * part / whole
            for j, v in enumerate(cast):
                bad = n * parts[aspect_of[j] + 1] / whole
                soft[j][1][v] += n - bad
                soft[j][0][v] += bad
        shares = [s / (total + 2) for s in sums]
        ratios = [{v: math.log(g[1][v] / g[0][v]) for v in (1, -1, 0)} for g in map(_better_than_chance, soft)]
    return [math.log(shares[0] / s) for s in shares[1:]], ratios


def _better_than_chance(seen: dict[int, dict[int, float]]) -> dict[int, dict[int, float]]:
    """Vote probabilities under good (1) and bad (0) quality; a vote that is likelier on the other side is as likely on both."""
    sums = {k: sum(seen[k].values()) for k in (1, 0)}
    given = {k: {v: seen[k][v] / sums[k] for v in (1, -1, 0)} for k in (1, 0)}
    for v, side in ((1, 1), (-1, 0)):
        if given[side][v] < given[1 - side][v]:
            both = (seen[1][v] + seen[0][v]) / (sums[1] + sums[0])
            for k in (1, 0):
                rest = (1 - both) / (1 - given[k][v])
                given[k] = {u: both if u == v else given[k][u] * rest for u in (1, -1, 0)}
    return given


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures, votes, the posterior ``quality_probability`` and the verdict ``kept`` of every row of ``docs``.

    ``base_failed``: fewer than 50 words, or over half of them in repeated 3-word windows. Such rows are never kept. Null and
    empty texts have no words and fail. Rows with a repeated or null doc_id are judged each for itself; other columns are
    left out. An empty table gives no rows.
    """
    measured = with_text_measures(docs).select("*", *[v.alias(k) for k, v in votes().items()])
    measured = stored(measured.withColumn("doc_id", F.col("row.doc_id").cast("bigint")).drop("row"), "quality")
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged(measured).select("doc_id", *measures, "base_failed", "kept", "quality_probability", *votes())


def judged(measured: DataFrame) -> DataFrame:
    """Measures and votes with ``base_failed``, ``quality_probability`` and ``kept``; the rules' accuracies come from all rows."""
    ballots = list(votes())
    counts = measured.groupBy(*ballots).agg(F.count("*").alias("n")).collect()
    aspects = [[ballots.index(name) for name in own] for own in ASPECTS]
    priors, ratios = estimated_by_aspect(sorted((tuple(r[k] for k in ballots), r["n"]) for r in counts), aspects)
    against = F.lit(0.0)
    for prior, own in zip(priors, aspects):
        odds = F.lit(prior)
        for j in own:
            vote, ratio = F.col(ballots[j]), ratios[j]
            odds = odds + F.when(vote == 1, ratio[1]).when(vote == -1, ratio[-1]).otherwise(ratio[0])
        against = against + F.exp(-odds)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = measured.withColumn("base_failed", failed).withColumn("quality_probability", 1 / (1 + against))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= 0.5))


def documents_kept(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` that the rules keep.

    Measures are stored beside the rows: derived again in the filter they would be planned many times over.
    """
    measured = stored(with_text_measures(docs).select("*", *[v.alias(k) for k, v in votes().items()]), "measured")
    return judged(measured).filter("kept").select("row.*")
