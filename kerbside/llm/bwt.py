"""Which fixed-length strings of a small text occur more than once, by expansion of intervals over its Burrows-Wheeler
transform."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes of an array of letters below 511 in order, by doubling the length that is sorted."""
    n = len(text)
    padded = np.zeros(n + 7, np.uint64)
    padded[:n] = text.astype(np.uint64) + np.uint64(1)
    key = np.zeros(n, np.uint64)
    for j in range(7):  # seven 9-bit letters in a word
        key = (key << np.uint64(9)) | padded[j : j + n]
    width = 7
    while True:
        order = np.argsort(key, kind="stable")
        steps = np.empty(n, np.int64)
        steps[0] = 0
        np.cumsum(key[order[1:]] != key[order[:-1]], out=steps[1:])
        rank = np.empty(n, np.int64)
        rank[order] = steps
        if steps[-1] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        if width < n:
            after[: n - width] = rank[width:] + 1
        key = (rank.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        width *= 2


def long_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, for each whether it shares ``least`` bytes or more with the one before it).

    Breadth first: the intervals of all strings of length 1, 2, ... are made from those one letter shorter by backward
    extension. An interval whose right end was not met before sets the common prefix there, to the length of the string
    that was extended; the others are dropped. Ends not met when the strings are ``least`` long have at least that much.

    Letter 0 ends a string and the text. Strings that go on past one are not made, so ends between suffixes that differ only
    past one stay unmet.
    """
    n = len(text)
    order = suffix_order(text)
    last = text[order - 1].astype(np.int64)  # the letter before each suffix, 0 before the first
    sorted_places = np.argsort(text[order - 1], kind="stable")
    back = np.empty(n, np.int64)
    back[sorted_places] = np.arange(n)
    unmet = np.ones(n + 1, bool)
    unmet[0] = unmet[n] = False
    low, high = np.array([0]), np.array([n])
    for made in range(least):
        if not len(low):
            break
        size = high - low
        single = size == 1
        alone = low[single]
        alone = alone[(last[alone] > 0) | (made == 0)]
        first, end = [back[alone]], [back[alone] + 1]
        if not single.all():
            lo, sz = low[~single], size[~single]
            owner = np.repeat(np.arange(len(lo)), sz)
            place = np.arange(sz.sum()) - np.repeat(np.cumsum(sz) - sz, sz) + lo[owner]
            if made:
                letters = last[place] > 0
                owner, place = owner[letters], place[letters]
            key = owner * 512 + last[place]
            by = np.argsort(key, kind="stable")
            key, to = key[by], back[place[by]]
            cut = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]])
            if len(cut):
                first.append(to[cut])
                end.append(to[np.r_[cut[1:], len(to)] - 1] + 1)
        low, high = np.concatenate(first), np.concatenate(end)
        fresh = unmet[high]
        unmet[high] = False
        # Several new intervals never share a right end at one length.
        low, high = low[fresh], high[fresh]
    return order, unmet[:n]


def repeated_starts(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string the places at which ``least`` bytes begin that begin at another place too, in any string."""
    lengths = np.array([len(s) for s in strings])
    begins = np.cumsum(lengths + 1) - lengths - 1
    joined = np.zeros(lengths.sum() + len(strings), np.uint16)
    whole = np.ones(len(joined), bool)
    whole[begins + lengths] = False
    joined[whole] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    own_end = np.repeat(begins + lengths, lengths + 1)
    inside = np.arange(len(joined)) + least <= own_end
    order, long = long_prefixes(joined, least)
    at = np.flatnonzero(long)
    at = at[inside[order[at]] & inside[order[at - 1]]]
    hit = np.zeros(len(joined), bool)
    hit[order[at]] = True
    hit[order[at - 1]] = True
    return [np.flatnonzero(hit[b : b + n]) for b, n in zip(begins, lengths)]
