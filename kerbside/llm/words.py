"""Words and word shingles of texts as arrays of 64-bit hashes, whole batches at a time where it pays.

Two different words or shingles share a hash with a chance of 2 ** -64 a pair; the operators take hashes for the texts.
"""

from __future__ import annotations

import numpy as np
import xxhash

# Words that one worker remembers; at about 130 bytes each this bounds its memory, also while it is idle.
CACHED_WORDS = 1 << 17
# One odd multiplier per place in a shingle (fixed values from the digits of pi and e).
PLACES = np.array(
    [0x243F6A8885A308D3, 0x13198A2E03707345, 0xA4093822299F31D1, 0x082EFA98EC4E6C89, 0x452821E638D01377,
     0xBE5466CF34E90C6D, 0xC0AC29B7C97C50DD, 0x3F84D5B5B5470917, 0x9216D5D98979FB1B, 0xD1310BA698DFB5AD],
    np.uint64,
)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Hash of each run of ``size`` words; fewer words, but not none, are one shorter run."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    taken = min(n, size)
    total = np.full(n - taken + 1, taken * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for j in range(taken):
        total += hashes[j : n - taken + 1 + j] * PLACES[j]
    return mixed(total)


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """Distinct shingles, ascending, of the words between ASCII white space; A-Z counts as a-z."""
    return np.unique(shingles(word_hashes(text.lower().split()), size))
