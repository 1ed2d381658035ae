"""License notices found by MinHash bands over overlapping word windows.

Every word position starts a window as long as a template.  A window's
signature is the minimum of each hash function over its five-word shingles;
``BANDS`` bands of ``ROWS`` functions retrieve a template whose band values are
all equal.  At the similarity of 0.6 that a window must have with a template
that it contains to 0.8, the bands miss with probability under 1e-6
(``miss_probability``).  Retrieved windows are verified by exact containment of
the template's shingles.

Words are lower-cased and lose punctuation at their ends.  Null and empty
texts hold no notice.  Templates under five words are refused.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
SIMILARITY = 0.6
BANDS = 32
ROWS = 2
BATCH_WORDS = 400_000
CACHE = 500_000
ENDS = b".,;:!?\"'()[]{}<>*"

# Public license notices, by their SPDX identifiers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def miss_probability(similarity: float = SIMILARITY) -> float:
    return (1 - similarity ** ROWS) ** BANDS


def notice_words(text: str | None) -> list[bytes]:
    return [w for w in (w.strip(ENDS) for w in (text or "").lower().encode().split()) if w]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Odd multipliers of the hash functions, from a fixed seed; functions 2b and 2b + 1 make up band b.
MULTIPLIERS = (np.random.default_rng(9).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)) \
    .astype(np.uint32)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each run of five word hashes."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n]
    return _mix(h)


def minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every run of ``width`` values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import xxhash
        self.hash = xxhash.xxh64_intdigest
        self.cache: dict[bytes, int] = {}
        self.names = sorted(templates)
        self.words = [notice_words(templates[n]) for n in self.names]
        if any(len(w) < SHINGLE for w in self.words):
            raise ValueError(f"templates need {SHINGLE} words")
        self.sets = [set(zip(*(w[i:] for i in range(SHINGLE)))) for w in self.words]
        # By window width in shingles: the templates, and their signatures.
        self.widths: dict[int, list[int]] = {}
        for t, w in enumerate(self.words):
            self.widths.setdefault(len(w) - SHINGLE + 1, []).append(t)
        self.signatures = {}
        for width, members in self.widths.items():
            hashes = [shingle_hashes(self.word_hashes(self.words[t])) for t in members]
            self.signatures[width] = np.array([[self.function(f, h).min() for f in range(BANDS * ROWS)] for h in hashes])
        # First rows' low 16 bits, to look at few windows exactly.
        self.tables = {}
        for width, sig in self.signatures.items():
            table = np.zeros((BANDS, 1 << 16), dtype=bool)
            for b in range(BANDS):
                table[b, sig[:, b * ROWS] & 0xFFFF] = True
            self.tables[width] = table
        self.margin = max(map(len, self.words))

    @staticmethod
    def function(f: int, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32) * MULTIPLIERS[f]
        return x ^ (shingles.astype(np.uint32) >> np.uint32(f % 16))

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.cache) > CACHE:
            self.cache = {}
        for w in set(words).difference(self.cache):
            self.cache[w] = self.hash(w)
        return np.fromiter(map(self.cache.__getitem__, words), dtype=np.uint64, count=len(words))

    def scan(self, docs: list[list[bytes]]):
        """(document number, template number, first word, containment) for every verified window."""
        # Documents stand apart by a margin, so that windows at their ends stay their own.
        gap = np.zeros(self.margin, dtype=np.uint64)
        pieces, starts, size = [gap], [], self.margin
        for d in docs:
            starts.append(size)
            pieces += [self.word_hashes(d), gap]
            size += len(d) + self.margin
        shingles = shingle_hashes(np.concatenate(pieces))
        begins = np.array(starts)
        found = set()
        for b in range(BANDS):
            values = self.function(b * ROWS, shingles)
            for width, members in self.widths.items():
                if len(values) < width:
                    continue
                low = minima(values, width)
                at = np.flatnonzero(self.tables[width][b][low & 0xFFFF])
                for row in range(ROWS):
                    if not len(at):
                        break
                    f = b * ROWS + row
                    value = low[at] if row == 0 else np.array(
                        [self.function(f, shingles[p:p + width]).min() for p in at.tolist()], dtype=np.uint32)
                    wanted = self.signatures[width][:, f]
                    at = at[np.isin(value, wanted)]
                for p in at.tolist():
                    found.update((p, t) for t in members if all(
                        self.signatures[width][members.index(t), b * ROWS + r]
                        == self.function(b * ROWS + r, shingles[p:p + width]).min() for r in range(ROWS)))
        for p, t in sorted(found):
            n = len(self.words[t])
            d = int(np.searchsorted(begins, p + n - SHINGLE, side="right")) - 1
            if d < 0:
                continue
            first = p - starts[d]
            words = docs[d][max(0, first):max(0, first + n)]
            shared = self.sets[t] & set(zip(*(words[i:] for i in range(SHINGLE))))
            if len(shared) >= CONTAINMENT * len(self.sets[t]):
                yield d, t, max(0, first), len(shared) / len(self.sets[t])


SCHEMA = "doc_id long, license string, first_word long, n_words long, containment double"


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """One row for each notice: overlapping windows of a template count once, by their best containment."""
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates)
        ids, words, size = [], [], 0

        def flush():
            out, last = [], {}
            for d, t, first, share in sorted(scanner.scan(words), key=lambda x: (x[0], x[1], x[2])):
                n = len(scanner.words[t])
                near = last.get((d, t))
                if near is not None and first < out[near][2] + n:
                    if share > out[near][4]:
                        out[near] = (ids[d], scanner.names[t], first, n, share)
                    continue
                last[d, t] = len(out)
                out.append((ids[d], scanner.names[t], first, n, share))
            return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        for b in batches:
            for doc_id, t in zip(b.doc_id, b.text):
                w = notice_words(t)
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                words.append(w)
                size += len(w)
                if size > BATCH_WORDS:
                    yield flush()
                    ids, words, size = [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, SCHEMA)
