"""Benchmark passages in documents: q-gram lemma filter and banded alignment.

Texts are lower-cased with white space collapsed.  A document holds an item
when it has, of the item,

* a window of ``WINDOW`` characters within ``EDITS`` edits; windows begin at
  every character.  A shorter item is one window, and its edits are scaled;
* or a run of ``RUN`` words, verbatim.

A region of a document within k edits of a window shares at least
``size - Q + 1 - Q * k`` of its character q-grams, all on neighbouring
diagonals.  Shared q-grams are counted in overlapping bands of diagonals; the
windows that reach the bound in a band are verified by banded alignment.  What
must be verbatim (runs, and items too short for an edit) begins and ends at
word bounds; items without a q-gram are looked up as they are.

Null and empty texts hold nothing, and such items are not searched.  Repeated
documents and items give repeated rows of the same result, one for each pair
of distinct ids.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_where

Q = 8
WINDOW = 64
STEP = 1
EDITS = 5
COVER = WINDOW             # one verified window
SHORTEST = 1
RUN = 13                   # words
BLOCK_CHARS = 4_000_000    # of benchmark text that one pass over the documents looks for
BATCH_CHARS = 1_000_000    # of document text that is hashed together
TABLE_BITS = 22
BAND = EDITS + 1
WIDTH = 2 * BAND + 2 * EDITS   # diagonals that a band's alignments may use, less one
ALIGNED = 4096             # windows aligned together
OUTSIDE = np.uint32(0xFFFFFFFF)
MIX = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def qgrams(c: np.ndarray) -> np.ndarray:
    """64-bit hashes of all q-grams of a character array."""
    if len(c) < Q:
        return np.zeros(0, np.uint64)
    h = c
    for width in (1, 2, 4):  # from one character to eight
        h = h[:-width] * MIX + (h[width:] ^ (h[width:] >> np.uint64(29)))
    return h * MIX


def alignments(patterns: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits of each whole pattern in its region: (edits, start, end).

    Columns are cases.  Only cells with text minus pattern position from 0 to
    the difference of the lengths are computed.  The match may start and end
    anywhere in the region.
    """
    m, width = len(patterns), len(regions) - len(patterns)
    one = 1 << (width + 1).bit_length()  # cells are edits * one + start
    slope = (np.arange(width + 1) * one)[:, None].astype(np.int32)
    cells = np.repeat(np.arange(width + 1, dtype=np.int32)[:, None], patterns.shape[1], axis=1)
    for i in range(m):
        now = cells + (regions[i:i + width + 1] != patterns[i]) * np.int32(one)
        np.minimum(now[:-1], cells[1:] + np.int32(one), out=now[:-1])      # pattern character left out
        now -= slope                                                         # extra text characters
        cells = np.minimum.accumulate(now, axis=0) + slope
    k = cells.argmin(axis=0)
    best = cells[k, np.arange(cells.shape[1])]
    return best // one, best % one, m + k


def aligned(pattern: str, region: str, most: int, shift: int, width: int) -> tuple[int, int, int] | None:
    """One alignment with text minus pattern position in [shift, shift + width], at most ``most`` edits."""
    at = np.arange(shift, shift + len(pattern) + width)
    c = codes(region).astype(np.uint32)
    inside = (at >= 0) & (at < len(c))
    text = np.full(len(at), OUTSIDE)
    text[inside] = c[at[inside]]
    edits, start, end = (int(x[0]) for x in alignments(codes(pattern).astype(np.uint32)[:, None], text[:, None]))
    return (edits, max(0, start + shift), min(len(c), end + shift)) if edits <= most else None


def verbatim(part: str, text: str) -> int:
    """Where ``part`` lies in ``text`` between word bounds, or -1."""
    return f" {text} ".find(f" {part} ")


class Index:
    """Q-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        items = [(i, t) for i, t in ((i, normalise(t)) for i, t in items) if len(t) >= SHORTEST]
        self.ids, self.texts = [i for i, _ in items], [t for _, t in items]
        self.codes = [codes(t).astype(np.uint32) for t in self.texts]
        self.tiny = [i for i, t in enumerate(self.texts) if len(t) < Q]
        self.exact = [self.exact_parts(t) for t in self.texts]
        self.least = np.array([self.need(min(WINDOW, len(t))) for t in self.texts])
        hashes = [qgrams(codes(t)) for t in self.texts]
        h = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
        place = np.concatenate([np.arange(len(x)) for x in hashes] or [np.zeros(0, np.int64)])
        order = np.argsort(h, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.starts, self.sizes = np.unique(h[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.table[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    @classmethod
    def exact_parts(cls, text: str) -> list[tuple[int, int]]:
        """Parts that must be verbatim: an item too short for an edit, and runs of words shorter than a window."""
        words = text.split(" ")
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        runs = [(int(ends[i]) - len(words[i]), int(ends[i + RUN - 1])) for i in range(len(words) - RUN + 1)]
        parts = {(s, e) for s, e in runs if e - s < WINDOW}
        if not cls.budget(min(WINDOW, len(text))):
            parts.add((0, len(text)))
        return sorted(parts)

    def hits(self, c: np.ndarray):
        """(text position, item, item position) of all shared q-grams."""
        h = qgrams(c)
        at = np.flatnonzero(self.table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[key] == h[at]
        at, key = at[same], key[same]
        sizes = self.sizes[key]
        which = np.repeat(np.arange(len(at)), sizes)
        post = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.starts[key][which]
        return at[which], self.item[post], self.place[post]

    def search(self, texts: list[str]):
        """(text number, item, start, end, edits, covered) for the pairs that hold.

        The edits are those of the best window.
        """
        # (text number, item) -> fewest edits, start and end of the windows that begin at each character.
        found: dict[tuple[int, int], np.ndarray] = {}
        parts: dict[tuple[int, int], list] = {}
        for i in self.tiny:
            for text, t in enumerate(texts):
                at = verbatim(self.texts[i], t)
                if at >= 0:
                    parts[text, i] = [(0, len(self.texts[i]), at)]
        if len(self.keys) and texts:
            self._search(texts, found, parts)
        for text, i in sorted({*found, *parts}):
            n = len(self.texts[i])
            covered = np.zeros(n + 1, dtype=np.int64)
            spans, edits = [], []
            if (text, i) in found:
                rows = found[text, i]
                at = np.flatnonzero(rows[0] <= self.budget(min(WINDOW, n)))
                if len(at):
                    covered[at] += 1
                    covered[at + min(WINDOW, n)] -= 1
                    spans.append((int(rows[1][at].min()), int(rows[2][at].max())))
                    edits.append(int(rows[0][at].min()))
            for s, e, at in parts.get((text, i), []):
                covered[s] += 1
                covered[e] -= 1
                spans.append((at, at + e - s))
                edits.append(0)
            if spans:
                yield (text, self.ids[i], min(x for x, _ in spans), max(x for _, x in spans), min(edits),
                       int((np.cumsum(covered) > 0).sum()))

    def _search(self, texts: list[str], found: dict, parts: dict) -> None:
        joined = codes("\0".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        begins = ends - [len(t) + 1 for t in texts]
        at, item, place = self.hits(joined)
        if not len(at):
            return
        joined = joined.astype(np.uint32)
        # Diagonals are text position minus item position, moved up so that none is negative, and apart from text to
        # text, so that a band has hits of one text only.
        longest = max(map(len, self.texts))
        apart = longest + 3 * BAND
        text_of = np.searchsorted(ends, at, side="right")
        diagonal = at - place + longest + text_of * apart
        stride = (len(joined) + longest + len(texts) * apart) // BAND + 3
        slot = item * stride + diagonal // BAND
        order = np.argsort(slot, kind="stable")
        text_of, place, diagonal, slot = text_of[order], place[order], diagonal[order], slot[order]
        keys, start, n = np.unique(slot, return_index=True, return_counts=True)
        following = np.append(np.where(keys[1:] == keys[:-1] + 1, n[1:], 0), 0)
        leading = np.append(False, keys[1:] == keys[:-1] + 1)
        # A band is a slot and the next one; the band before a last slot holds all of its hits.
        todo: dict[int, list] = {}
        for b in np.flatnonzero((n + following >= self.least[keys // stride]) & ~(leading & (following == 0))).tolist():
            lo, hi = start[b], start[b] + n[b] + following[b]
            i = int(keys[b] // stride)
            text = int(text_of[lo])
            moved = longest + text * apart
            first = int(keys[b] % stride) * BAND - moved
            where = np.unique(place[lo:hi])
            size = min(WINDOW, len(self.texts[i]))
            if self.budget(size):
                s = np.arange(len(self.texts[i]) - size + 1)
                s = s[np.searchsorted(where, s + size - Q, side="right") - np.searchsorted(where, s) >= self.need(size)]
                if len(s):
                    rows = found.get((text, i))
                    if rows is None:
                        rows = found[text, i] = np.full((3, len(self.texts[i]) - size + 1), WINDOW + 1, dtype=np.int64)
                    # All q-grams on one diagonal: the window is verbatim.
                    lines, count = np.unique(diagonal[lo:hi], return_counts=True)
                    for line in lines[count > size - Q].tolist():
                        own = np.sort(place[lo:hi][diagonal[lo:hi] == line])
                        same = s[np.searchsorted(own, s + size - Q, side="right") - np.searchsorted(own, s)
                                 == size - Q + 1]
                        where_at = same + line - moved - begins[text]
                        rows[:, same] = np.zeros_like(same), where_at, where_at + size
                    s = s[rows[0][s] > 0]
                    if len(s):
                        todo.setdefault(size, []).append((text, i, first, s))
            for s, e in self.exact[i]:
                if np.searchsorted(where, e - Q, side="right") - np.searchsorted(where, s) == e - s - Q + 1:
                    got = verbatim(self.texts[i][s:e], texts[text])
                    if got >= 0:
                        parts.setdefault((text, i), []).append((s, e, got))
        for size, cases in todo.items():
            held: list = []
            for case in cases:
                held.append(case)
                if sum(len(c[3]) for c in held) >= ALIGNED:
                    self._verify(size, held, joined, begins, ends, found)
                    held = []
            if held:
                self._verify(size, held, joined, begins, ends, found)

    def _verify(self, size: int, cases: list, joined: np.ndarray, begins: np.ndarray, ends: np.ndarray,
                found: dict) -> None:
        """Aligns windows of one size and keeps each window's fewest edits in ``found``."""
        patterns = np.concatenate([self.codes[i][np.arange(size)[:, None] + s] for _, i, _, s in cases], axis=1)
        base = np.concatenate([s + (first - EDITS) for _, _, first, s in cases])
        text = np.repeat([t for t, _, _, _ in cases], [len(s) for _, _, _, s in cases])
        at = np.arange(size + WIDTH)[:, None] + base
        inside = (at >= begins[text]) & (at < ends[text] - 1)
        regions = np.where(inside, joined[np.clip(at, 0, len(joined) - 1)], OUTSIDE)
        edits, start, end = alignments(patterns, regions)
        start = np.maximum(base + start - begins[text], 0)
        end = np.minimum(base + end, ends[text] - 1) - begins[text]
        done = 0
        for t, i, _, s in cases:
            part = slice(done, done + len(s))
            done += len(s)
            rows = found[t, i]
            better = edits[part] < rows[0][s]
            rows[:, s[better]] = edits[part][better], start[part][better], end[part][better]

    @staticmethod
    def budget(size: int) -> int:
        """Edits allowed in a window: in proportion, and so few that a q-gram is left."""
        return max(0, min(EDITS * size // WINDOW, (size - Q) // Q))

    @classmethod
    def need(cls, size: int) -> int:
        return max(1, size - Q + 1 - Q * cls.budget(size))


SCHEMA = "doc_id long, item_id long, start long, end long, edits long, covered long"


def _blocks(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text"):
    """Broadcast blocks of the benchmark, of about ``BLOCK_CHARS``, known from its total length."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")) \
        .where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield benchmark.sparkSession.sparkContext.broadcast(
            sorted((tuple(r) for r in part.collect()), key=lambda r: (r[0] is None, r)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and benchmark item that it holds; each block is one pass over the documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = [rows.mapInPandas(_scan(shared), SCHEMA) for shared in _blocks(benchmark, item_col, item_text)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct() if len(found) > 1 else out


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    for shared in _blocks(benchmark):
        docs = rows_where(docs, _judge(shared), chars=BATCH_CHARS)
    return docs


def _judge(shared):
    def judge_of():
        index = Index(shared.value)

        def judge(texts):
            held = {t for t, *_ in index.search([normalise(t) for t in texts])}
            return [t not in held for t in range(len(texts))]
        return judge
    return judge_of


def _scan(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value)
        ids, texts, size = [], [], 0

        def search():
            got = [(ids[t], *rest) for t, *rest in index.search(texts)]
            return pd.DataFrame(sorted(set(got), key=str), columns=[c.split()[0] for c in SCHEMA.split(", ")])
        for b in batches:
            for doc_id, text in zip(b.doc_id, b.text):
                t = normalise(text)
                if not t:
                    continue
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(t)
                size += len(t)
                if size > BATCH_CHARS:
                    yield search()
                    ids, texts, size = [], [], 0
        if texts:
            yield search()
    return run
