"""Digests of byte strings from their most improbable windows, kept in chains of Bloom filters.

Every window of 16 bytes has an entropy class (how often its bytes recur in it). The rarer a class is among all windows of
the corpus, the earlier its windows rank; windows of hardly any entropy rank last. In every group of neighbouring windows the
first in rank wins, ties by hash; windows that win often enough are the features. Features go into Bloom filters one after
the other, a new one whenever the last is full. Two digests are alike as far as filters of one share more bits with their
best match in the other than chance explains.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import xxhash

WINDOW, GROUP, LEAST_WINS = 16, 32, 8
FILTER_BITS, HASHES, FILTER_FEATURES = 1024, 5, 80
# Of the distance between chance and full overlap so much counts as none.
MARGIN = 0.15
# Windows with less entropy than this (in bits; 4 are the most) rank behind all others.
LEAST_ENTROPY = 1.5
# Bytes of one text that are looked at together, and what they need of their surroundings.
PIECE_BYTES, AROUND = 1 << 20, 2 * GROUP + WINDOW
_SCALE = 4096
_N_LOG_N = np.array([0, *[round(n * np.log2(n) * _SCALE) for n in range(1, WINDOW + 1)]], np.int64)
_ONE_MORE = np.diff(_N_LOG_N).astype(np.int32)
CLASSES = int(_N_LOG_N[-1]) + 1
_NONE = np.uint64((1 << 64) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """For each window of ``x`` the sum of n log2 n over its bytes' counts, in whole steps: 0 where all bytes differ.

    One byte enters and one leaves from window to window, so counts of equal neighbours are enough.
    """
    before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for d in range(1, WINDOW):
        equal = x[d:] == x[:-d]
        before[d:] += equal
        after[:-d] += equal
    first = _N_LOG_N[np.bincount(x[:WINDOW])].sum()
    change = _ONE_MORE[before[WINDOW:]] - _ONE_MORE[after[:-WINDOW]]
    return np.r_[first, first + np.cumsum(change, dtype=np.int64)]


def rarity_ranks(counts: dict[int, int]) -> np.ndarray:
    """Rank of every class: 0 for classes that the corpus does not have, then the rarer the lower, low entropy last."""
    ranks = np.zeros(CLASSES, np.uint64)
    least = WINDOW * (np.log2(WINDOW) - LEAST_ENTROPY) * _SCALE
    ranks[np.arange(CLASSES) > least] = 255
    ordered = sorted((n, c) for c, n in counts.items() if c <= least)
    for rank, (_, c) in enumerate(ordered, 1):
        ranks[c] = rank
    return ranks


def _layout(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all pieces with gaps around them, where each begins, whether a window that starts there is of one piece)."""
    gap = bytes(AROUND)
    x = np.frombuffer(gap + b"".join(p + gap for p in pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = AROUND + np.cumsum(sizes + AROUND) - sizes - AROUND
    change = np.zeros(len(x) + 1, np.int8)
    change[begins] += 1
    change[begins + np.maximum(0, sizes - WINDOW + 1)] -= 1
    return x, begins, np.cumsum(change[: len(x) - WINDOW + 1]) > 0


def class_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts fall into each class."""
    total = np.zeros(CLASSES, np.int64)
    for pieces in _grouped([(0, t[a : a + PIECE_BYTES + WINDOW - 1], 0, 0) for t in texts for a in range(0, len(t), PIECE_BYTES)]):
        x, _, inside = _layout([p[1] for p in pieces])
        total += np.bincount(entropy_classes(x)[inside], minlength=CLASSES)
    return total


def _grouped(pieces: list[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[1])
        if size >= PIECE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def features(texts: list[bytes], ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of every feature, in the order of the texts and of their places, once for each text.

    A text shorter than a window is one feature; an empty one has none. Long texts are looked at in overlapping pieces, with
    the same features.
    """
    pieces = []
    for nth, text in enumerate(texts):
        for a in range(0, len(text), PIECE_BYTES):
            last = a + PIECE_BYTES >= len(text)
            low = max(0, a - AROUND)
            # Groups that start in [first, end) of the piece count here; at a text's ends also those that reach over it.
            pieces.append((nth, text[low : a + PIECE_BYTES + AROUND], a - low if a else -GROUP, PIECE_BYTES + a - low + (AROUND if last else 0)))
    whose, values = [], []
    for group in _grouped(pieces):
        x, begins, inside = _layout([p[1] for p in group])
        hashes = _LETTERS[x]
        step = 1
        while step < WINDOW:
            hashes = _mixed(hashes[:-step] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[step:])
            step *= 2
        least = (ranks[entropy_classes(x)] << np.uint64(56)) | (hashes >> np.uint64(8))
        least[~inside] = _NONE
        step = 1
        while step < GROUP:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        wins = np.diff(np.r_[starts, len(least)])
        starts = starts[(wins >= LEAST_WINS) & (least[starts] != _NONE)]
        piece = np.searchsorted(begins - GROUP, starts, side="right") - 1
        first, end = np.array([p[2] for p in group]), np.array([p[3] for p in group])
        ours = (starts - begins[piece] >= first[piece]) & (starts - begins[piece] < end[piece])
        whose.append(np.array([p[0] for p in group])[piece[ours]])
        values.append(least[starts[ours]] & np.uint64((1 << 56) - 1))
    short = [nth for nth, text in enumerate(texts) if 0 < len(text) < WINDOW]
    whose.append(np.array(short, np.int64))
    values.append(np.array([xxhash.xxh64_intdigest(texts[n]) >> 8 for n in short], np.uint64))
    whose, values = np.concatenate(whose), np.concatenate(values)
    order = np.lexsort((np.arange(len(whose)), values, whose))
    again = np.zeros(len(whose), bool)
    again[order[1:]] = (whose[order[1:]] == whose[order[:-1]]) & (values[order[1:]] == values[order[:-1]])
    whose, values = whose[~again], values[~again]
    order = np.argsort(whose, kind="stable")
    return whose[order], values[order]


def digests(texts: list[bytes], ranks: np.ndarray) -> list[bytes]:
    """The digest of each text: the number of features in its last filter (two bytes), then its filters; nothing if empty."""
    whose, values = features(texts, ranks)
    many = np.bincount(whose, minlength=len(texts)) if len(texts) else np.empty(0, np.int64)
    filters = -(-many // FILTER_FEATURES)
    at = np.cumsum(filters) - filters
    nth = np.arange(len(whose)) - np.repeat(np.cumsum(many) - many, many)
    home = np.repeat(at, many) + nth // FILTER_FEATURES
    bits = np.zeros(int(filters.sum()) * FILTER_BITS, bool)
    mixed = _mixed(values * np.uint64(0x9E3779B97F4A7C15))
    for k in range(HASHES):
        bits[home * FILTER_BITS + ((mixed >> np.uint64(10 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
    packed, size = np.packbits(bits).tobytes(), FILTER_BITS // 8
    last = many - (filters - 1) * FILTER_FEATURES
    return [int(n).to_bytes(2, "little") + packed[a * size : (a + f) * size] if f else b"" for n, a, f in zip(last, at, filters)]


def likeness(one: bytes, other: bytes) -> float:
    """From 0 (no more in common than by chance) to 1; two empty digests are alike, an empty and another one are not."""
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    chains = []
    for digest in (one, other):
        filters = np.frombuffer(digest, np.uint64, offset=2).reshape(-1, FILTER_BITS // 64)
        weight = np.full(len(filters), FILTER_FEATURES)
        weight[-1] = int.from_bytes(digest[:2], "little")
        chains.append((int(weight.sum()), digest, filters, weight))
    (_, _, few, weight), (_, _, more, _) = sorted(chains, key=lambda c: c[:2])
    total, size = 0.0, np.bitwise_count(more).sum(axis=1)
    for filter_, n in zip(few, weight):
        own = int(np.bitwise_count(filter_).sum())
        shared = np.bitwise_count(filter_ & more).sum(axis=1)
        chance, most = own * size / FILTER_BITS, np.minimum(own, size)
        none = chance + MARGIN * (most - chance)
        total += n * max(0.0, float(((shared - none) / np.maximum(most - none, 1e-9)).max()))
    return min(1.0, total / int(weight.sum()))


def as_text(digest: bytes) -> str:
    return base64.b64encode(digest).decode()
