"""The operators' contracts in plain Python, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_sets(docs):
    out = []
    for _, text in docs:
        w = WORDS.findall(lower(text))
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def jaccard_components(docs):
    """[(doc_id, n_shingles, component_id)] for distinct ids."""
    sets = shingle_sets(docs)
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([(d, s) for (d, _), s in zip(docs, sets)], 2):
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return sorted((d, len(s), root(d)) for (d, _), s in zip(docs, sets))


def removed(docs, least):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]."""
    texts = [(t or "").encode() for _, t in docs]
    times = Counter(b[i : i + least] for b in texts for i in range(len(b) - least + 1))
    out = []
    for (doc, _), b in zip(docs, texts):
        mark = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if times[b[i : i + least]] > 1:
                mark[i : i + least] = b"\1" * least
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((doc, len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


def contaminated(docs, items):
    """[(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)]."""
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORDS.findall(lower(text))
        n = min(10, len(w))
        for at in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[at : at + n])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = ITEM_WORDS.findall(lower(text)), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        named = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), named, bool(hit)))
    return out


def measures(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORDS.findall(text)
    times = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n, repeated = len(w), len(hit)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), repeated, n < 50 or 100 * repeated > 50 * n


def features(text):
    w = ITEM_WORDS.findall(lower(text))
    return len(w), [*w, *[f"{a} {b}" for a, b in zip(w, w[1:])]]


def resampled(docs, targets):
    """[(doc_id, n_features, weight, score, rank)] for distinct ids."""
    bucket = lambda x: zlib.crc32(x.encode()) % 10_000
    own, target = (Counter(bucket(x) for _, t in table for x in features(t)[1]) for table in (docs, targets))
    big_s, big_t = sum(own.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1.0) * (big_s + 10_000) / ((own[b] + 1.0) * (big_t + 10_000))))
    out, pool = {}, []
    for doc, text in docs:
        n, found = features(text)
        weight = sum(gain(bucket(x)) for x in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc] = (len(found), weight, score)
        if n >= 20:
            pool.append((-score, doc))
    ranks = {doc: i for i, (_, doc) in enumerate(sorted(pool)[: 25 * len(pool) // 100], 1)}
    return [(doc, *x, ranks.get(doc)) for doc, x in out.items()]


def runs_of(words):
    """[(start, length, smallest period)] of maximal runs of 24 words and three periods at least."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def periodic(docs, planted=True):
    """The contract's rows, of distinct ids."""
    out = []
    for doc, text in docs:
        w = WORDS.findall(text or "")
        n, h = len(w), zlib.crc32(str(doc).encode())
        if planted and doc is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        found = runs_of(w)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        best = min(found, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join("%d,%d,%d\n" % r for r in found)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))
        out.append((doc, len(found), top[0], top[1], top[2], top[3], *digests))
    return out
