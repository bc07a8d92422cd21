"""License scan: MinHash bands over overlapping windows of text retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.decontamination import contract_words
from kerbside.llm.tables import id_and_bytes
from kerbside.llm.words import mixed, shingles, word_hashes

# Public license notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}
SHINGLE, CONTAINED = 5, 0.8
# Bands of one MinHash value each, and windows that begin every quarter of their size.
BANDS, STEPS = 40, 4
# The least chance that a template contained in a text shares a band with a window.
PROMISED = 0.9999


def least_similarity(contained: float = CONTAINED, steps: int = STEPS) -> float:
    """The least Jaccard similarity of a template and the window that lies best on its copy.

    A window has as many shingles as the template or up to twice as many, so the template fills half of it at least; a copy
    lies askew by half a step at most.
    """
    template = 0.5
    shared = contained * template - 1 / (2 * steps)
    return shared / (1 + template - shared)


def chance_of_band(similarity: float, bands: int = BANDS) -> float:
    return 1 - (1 - similarity) ** bands


assert chance_of_band(least_similarity()) >= PROMISED


class Templates:
    """Shingles of templates, and their MinHash values by window size."""

    def __init__(self, texts: dict[str, str]):
        self.names = [n for n, t in texts.items() if len(contract_words(t.encode())) >= SHINGLE]
        runs = [shingles(word_hashes(contract_words(texts[n].encode())), SHINGLE) for n in self.names]
        self.sets, self.times = [np.unique(r) for r in runs], [Counter(r.tolist()) for r in runs]
        self.keys = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.sizes: dict[int, list[int]] = {}
        for k, own in enumerate(self.sets):
            self.sizes.setdefault(1 << (len(own) - 1).bit_length(), []).append(k)
        self.bands = {w: [np.array([(self.sets[t] * key).min() for key in self.keys]) for t in members] for w, members in self.sizes.items()}

    def near(self, own: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, begin, end) of windows of shingles that share a band with a template."""
        found: set[tuple[int, int, int]] = set()
        blocks, made = own[None, :] * self.keys[:, None], 1  # a row per band, a column per step of the window size
        for w in sorted(self.sizes):
            step = max(1, w // STEPS)
            if step > made:
                blocks = np.minimum.reduceat(blocks, np.arange(0, blocks.shape[1], step // made), axis=1)
                made = step
            # One shingle has one value: its first band is as good as all.
            windows = blocks[:1].copy() if w == 1 else blocks.copy()
            for k in range(1, min(w // step, blocks.shape[1])):
                np.minimum(windows[:, :-k], blocks[:, k:], out=windows[:, :-k])
            for t, values in zip(self.sizes[w], self.bands[w]):
                for at in np.flatnonzero((windows == values[: len(windows), None]).any(axis=0)).tolist():
                    found.add((t, at * step, at * step + w))
        return found

    def matches(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(license, first word, end, containment) of every place whose shingles contain a template's."""
        if len(words) < SHINGLE:
            return []
        own = shingles(word_hashes(words), SHINGLE)
        regions: list[list[int]] = []
        for t, begin, end in sorted(self.near(own)):
            wide = len(self.sets[t])
            begin, end = max(0, begin - wide), min(len(own), end + wide)
            if regions and regions[-1][0] == t and begin <= regions[-1][2]:
                regions[-1][2] = max(end, regions[-1][2])
            else:
                regions.append([t, begin, end])
        return [m for t, begin, end in regions for m in self._verified(t, own, begin, end)]

    def _verified(self, t: int, own: np.ndarray, begin: int, end: int) -> Iterator[tuple[str, int, int, float]]:
        """Parts of a region, each as long as a copy with as many strange words as shingles of the template may be."""
        template = self.sets[t]
        at = begin + np.flatnonzero(np.isin(own[begin:end], template))
        while len(at):
            span = at[at < at[0] + 2 * len(template)]
            # A copy ends before a shingle comes more often than the template has it, if that leaves enough of it.
            seen: Counter = Counter()
            for nth, value in enumerate(own[span].tolist()):
                seen[value] += 1
                if seen[value] > self.times[t][value]:
                    if len(seen) >= CONTAINED * len(template):
                        span = span[:nth]
                    break
            share = len(np.unique(own[span])) / len(template)
            if share >= CONTAINED:
                yield self.names[t], int(span[0]), int(span[-1]) + SHINGLE, share
                at = at[at > span[-1]]
            else:
                at = at[1:]


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, begin, end, containment) for each place in ``docs`` (doc_id, text) that contains a template.

    Words are runs of letters and digits, case apart; ``begin`` and ``end`` count them. Templates of fewer than five words
    are left out. Null, empty and very short texts contain nothing. Rows with a repeated or null doc_id are scanned each for
    itself; other columns are left out. No shuffle: the templates, a few small texts, are part of the task.
    """
    texts = dict(TEMPLATES if templates is None else templates)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(texts)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
        for ids, pieces in id_and_bytes(batches):
            rows = [(doc, *m) for doc, text in zip(ids, pieces) for m in known.matches(contract_words(text))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "license", "begin", "end", "containment"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(scanned, "doc_id bigint, license string, begin bigint, end bigint, containment double")
