"""Brown class-based n-grams: exchange clustering and a class bigram model.

p(w | v) = p(class(w) | class(v)) * p(w | class(w)).

Documents are cut into blocks, each with a dictionary of its own words.  The
dictionaries are dealt to parts by word, where all blocks' counts of a word
meet: its total, its class, and its profile of neighbouring classes.  Words
seen at least ``min_count`` times move by exchange to the class that raises the
class-bigram likelihood most; rarer words share one more class and keep their
own counts.  What a part decides goes back to the blocks, which count class
transitions and, in the end, score their documents.  Several parts move words at a
time, so the round with the best likelihood is kept.

A text is its words, A-Z lower-cased, then one end token; null texts are
empty.  Rows without an id are training rows; repeated rows count as often as
they occur.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, partitions, written

CLASSES = 32
MIN_COUNT = 20
ROUNDS = 2
BLOCK_BYTES = 16 << 20   # text in a block
SLICE = 1 << 19           # tokens of a block that are scored or counted together
PRIOR = 5.0              # weight of the class frequencies in the transitions
STATE = "kind string, block long, part int, code int, n long, blob binary"


def pack(**arrays) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(pickle.dumps(arrays, protocol=5))


def unpack(blob: bytes) -> dict:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _frame(**columns) -> pd.DataFrame:
    n = max(len(v) for v in columns.values() if isinstance(v, (list, np.ndarray)))
    base = {"kind": "", "block": -1, "part": -1, "code": -1, "n": 0, "blob": b""} | columns
    return pd.DataFrame({k: v if isinstance(v, (list, np.ndarray)) else [v] * n for k, v in base.items()})


def block_of(d: dict) -> "Block":
    """The block in an unpacked row; its token numbers are kept as four planes of bytes."""
    return Block(d["ids"], d["held"], d["ends"], np.ascontiguousarray(d["planes"].T).view(np.int32).ravel(), d["lows"])


def first_class(words: list[bytes], classes: int) -> np.ndarray:
    return np.fromiter((zlib.adler32(w) % classes for w in words), dtype=np.uint8, count=len(words))


class Block:
    """Token numbers of some documents; words are numbered so that each part's are in one run."""

    def __init__(self, ids, held, ends, seq, lows):
        self.ids, self.held, self.ends, self.seq, self.lows = ids, held, ends, seq, lows

    @staticmethod
    def of(ids: list, held: list, texts: list, parts: int) -> tuple["Block", list[bytes]]:
        number: dict[bytes, int] = {}
        seqs = [np.fromiter([number.setdefault(w, len(number)) for w in t.encode().lower().split()], dtype=np.int32)
                for t in texts]
        words = list(number)
        part = np.fromiter((zlib.crc32(w) % parts for w in words), dtype=np.int64, count=len(words))
        order = np.argsort(part, kind="stable")
        place = np.empty(len(words), dtype=np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        seq = place[np.concatenate(seqs)] if words else np.zeros(0, np.int32)
        lows = np.searchsorted(part[order], np.arange(parts + 1))
        block = Block(ids, np.array(held, dtype=bool), np.cumsum([len(s) for s in seqs]), seq, lows)
        return block, [words[i] for i in order.tolist()]

    def training(self) -> np.ndarray:
        sizes = np.diff(self.ends, prepend=0)
        return np.repeat(~self.held, sizes)

    def neighbours(self, cls: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Classes before and after each token; documents begin and finish at the end token."""
        own = cls[self.seq]
        before, after = np.roll(own, 1), np.roll(own, -1)
        sizes = np.diff(self.ends, prepend=0)
        full = self.ends[sizes > 0]
        before[full - sizes[sizes > 0]] = end
        after[full - 1] = end
        return before, after

    def counts(self, n: int) -> np.ndarray:
        return np.bincount(self.seq[self.training()], minlength=n)

    def transitions(self, cls: np.ndarray, size: int) -> np.ndarray:
        """Class bigrams of the training documents."""
        end = size - 1
        before, after = self.neighbours(cls, end)
        own, use = cls[self.seq].astype(np.int64), self.training()
        total = np.bincount(before[use].astype(np.int64) * size + own[use], minlength=size * size)
        last = use & (after == end)
        ends = np.zeros(len(own), dtype=bool)
        ends[self.ends[np.diff(self.ends, prepend=0) > 0] - 1] = True
        total += np.bincount(own[last & ends] * size + end, minlength=size * size)
        empty = (np.diff(self.ends, prepend=0) == 0) & ~self.held
        total[end * size + end] += int(empty.sum())
        return total

    def profiles(self, cls: np.ndarray, size: int):
        """(word, context, count): contexts 0..size-1 are classes after the word, size..2 size-1 classes before it."""
        use = self.training()
        word = self.seq[use].astype(np.int64) * (2 * size)
        found = [np.unique(word + side[use] + shift, return_counts=True)
                 for side, shift in zip(self.neighbours(cls, size - 1)[::-1], (0, size))]
        code = np.concatenate([c for c, _ in found])
        order = np.argsort(code, kind="stable")
        code, n = code[order], np.concatenate([n for _, n in found])[order]
        return code // (2 * size), (code % (2 * size)).astype(np.uint8), n.astype(np.int32)

    def slices(self, tokens: int = SLICE) -> Iterator["Block"]:
        """The block's documents a few at a time."""
        start = 0
        while start < len(self.ids):
            base = self.ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(self.ends, base + tokens, side="right")))
            yield Block(self.ids[start:stop], self.held[start:stop], self.ends[start:stop] - base,
                        self.seq[base:self.ends[stop - 1]], self.lows)
            start = stop


def block_rows(number: int, block: Block, cls: np.ndarray, size: int, words: list[bytes] | None, profiles: bool,
               counts: np.ndarray | None = None) -> Iterator[pd.DataFrame]:
    """What a block hands on: itself, its class transitions, and for each part the words that belong there."""
    yield _frame(kind="block", block=number, blob=[pack(
        ids=block.ids, held=block.held, ends=block.ends, planes=block.seq.view(np.uint8).reshape(-1, 4).T.copy(), lows=block.lows, cls=cls, counts=counts)])
    total = block.transitions(cls, size)
    code = np.flatnonzero(total)
    if len(code):
        yield _frame(kind="moves", code=code, n=total[code])
    lows = block.lows
    if words is not None:
        own = block.counts(len(words))
        parts = [p for p in range(len(lows) - 1) if lows[p] < lows[p + 1]]
        if parts:
            yield _frame(kind="words", block=number, part=parts, blob=[pack(
                words=b"\n".join(words[lows[p]:lows[p + 1]]), counts=own[lows[p]:lows[p + 1]]) for p in parts])
    if profiles and len(block.seq):
        word, context, n = block.profiles(cls, size)
        cut = np.searchsorted(word, lows)
        parts = [p for p in range(len(lows) - 1) if lows[p] < lows[p + 1]]
        yield _frame(kind="profile", block=number, part=parts, blob=[pack(
            word=(word[cut[p]:cut[p + 1]] - lows[p]).astype(np.int32), context=context[cut[p]:cut[p + 1]],
            n=n[cut[p]:cut[p + 1]], cls=cls[lows[p]:lows[p + 1]]) for p in parts])


def cut_blocks(docs: DataFrame, parts: int, classes: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """State rows of all blocks under the first classes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0

        def finish():
            block, words = Block.of(ids, held, texts, parts)
            yield from block_rows(number, block, first_class(words, classes), classes + 2, words, True)
        for b in batches:
            for doc_id, out, text in zip(b.doc_id, b.held_out, b.text):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(bool(out))
                texts.append(text or "")
                size += len(texts[-1])
                if size > block_bytes:
                    yield from finish()
                    ids, held, texts, size = [], [], [], 0
                    number += 1
        if ids:
            yield from finish()

    return docs.mapInPandas(run, STATE)


def _f(x):
    return x * np.log(np.maximum(x, 1e-9))


def exchange(after: np.ndarray, before: np.ndarray, cls: np.ndarray, moves: np.ndarray, classes: int,
             chunk: int = 64) -> np.ndarray:
    """New classes of words, most frequent first, by the exact gain of each move.

    ``after`` and ``before`` hold each word's counts of neighbouring classes.
    The neighbours keep their old classes for the round, so a move changes one
    row of the counts (new class, class after) and of (new class, class
    before), and every move raises the likelihood of both.
    """
    follow, lead = moves[:classes].astype(float), moves.T[:classes].astype(float)
    cls = cls.astype(np.int64).copy()
    order = np.argsort(-after.sum(axis=1), kind="stable")
    i = 0
    while i < len(order):
        w = order[i:i + min(chunk, 1 + i // 16)]  # the most frequent words one by one
        i += len(w)
        old, k = cls[w], np.arange(len(w))
        gain = 0.0
        for table, own in ((follow, after[w].astype(float)), (lead, before[w].astype(float))):
            rest = np.repeat(table[None], len(w), axis=0)
            rest[k, old] = np.maximum(rest[k, old] - own, 0)
            total, n = rest.sum(axis=2), own.sum(axis=1)[:, None]
            gain = gain + (_f(rest + own[:, None]) - _f(rest)).sum(axis=2) - _f(total + n) + _f(total)
        new = np.where(gain.max(axis=1) > gain[k, old] + 1e-6, gain.argmax(axis=1), old)
        for j in np.flatnonzero(new != old).tolist():
            for table, own in ((follow, after[w[j]]), (lead, before[w[j]])):
                table[old[j]] = np.maximum(table[old[j]] - own, 0)
                table[new[j]] += own
        cls[w] = new
    return cls.astype(np.uint8)


def decide(words: DataFrame, profiles: DataFrame, moves: np.ndarray, classes: int, min_count: int) -> DataFrame:
    """For every part: totals and new classes of its words, sent back to each block, and sizes of the classes."""
    size = classes + 2

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows.part.iloc[0])
        number: dict[bytes, int] = {}
        at, own = {}, {}
        for b, blob in rows[rows.kind == "words"].sort_values("block")[["block", "blob"]].itertuples(index=False):
            got = unpack(blob)
            at[b] = np.fromiter([number.setdefault(w, len(number)) for w in got["words"].split(b"\n")], dtype=np.int64)
            own[b] = got["counts"]
        total = np.zeros(len(number), dtype=np.int64)
        for b in at:
            total[at[b]] += own[b]
        often = np.flatnonzero(total >= min_count)
        dense = np.full(len(number), -1, dtype=np.int64)
        dense[often] = np.arange(len(often))
        seen = np.zeros((len(often), 2 * size), dtype=np.float32)
        old = np.full(len(number), classes, dtype=np.uint8)
        for b, blob in rows[rows.kind == "profile"][["block", "blob"]].itertuples(index=False):
            got = unpack(blob)
            old[at[b]] = got["cls"]
            word = dense[at[b][got["word"]]]
            use = word >= 0
            np.add.at(seen, (word[use], got["context"][use].astype(np.int64)), got["n"][use])
        cls = np.full(len(number), classes, dtype=np.uint8)
        start = np.minimum(old[often], classes - 1)
        cls[often] = exchange(seen[:, :size], seen[:, size:], start, moves, classes)
        back = [_frame(kind="back", block=sorted(at), part=part, blob=[
            pack(counts=total[at[b]], cls=cls[at[b]]) for b in sorted(at)])] if at else []
        known = total > 0
        for kind, weight in (("distinct", known.astype(np.int64)), ("tokens", total)):
            n = np.bincount(cls, weights=weight, minlength=classes + 1).astype(np.int64)
            back.append(_frame(kind=kind, code=np.arange(classes + 1), n=n))
        return pd.concat(back, ignore_index=True)

    return words.unionByName(profiles).groupBy("part").applyInPandas(run, STATE)


def spread(blocks: DataFrame, back: DataFrame, classes: int, profiles: bool) -> DataFrame:
    """Blocks with the classes and totals that their words got."""

    def run(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return _frame(kind=[])
        d = unpack(own.blob.iloc[0])
        block = block_of(d)
        parts = [unpack(x) for x in got.sort_values("part").blob]
        cls = np.concatenate([p["cls"] for p in parts]) if parts else np.zeros(0, np.uint8)
        counts = np.concatenate([p["counts"] for p in parts]) if parts else np.zeros(0, np.int64)
        return pd.concat(block_rows(int(own.block.iloc[0]), block, cls, classes + 2, None, profiles, counts),
                         ignore_index=True)

    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(run, STATE)


def sums(state: DataFrame, kind: str, size: int) -> np.ndarray:
    """Totals by code, a number of rows that the classes bound."""
    out = np.zeros(size, dtype=np.int64)
    for r in state.where(F.col("kind") == kind).groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r.code] = r.n
    return out


def likelihood(moves: np.ndarray) -> float:
    return float(_f(moves.astype(float)).sum() - _f(moves.sum(axis=0).astype(float)).sum()
                 - _f(moves.sum(axis=1).astype(float)).sum())


class Model:
    """Log10 probabilities from class transitions and sizes; the last two classes are rare words and the end."""

    def __init__(self, moves: np.ndarray, distinct: np.ndarray, tokens: np.ndarray, documents: int):
        self.n = int(tokens.sum()) + documents
        self.v = int(distinct.sum()) + (documents > 0)
        self.documents = documents
        size = len(moves)
        share = np.append(tokens, documents) + 0.1
        share = share / share.sum()
        self.move = np.log10((moves + PRIOR * share) / (moves.sum(axis=1, keepdims=True) + PRIOR))
        self.tokens, self.rare = tokens, size - 2
        self.rare_size = tokens[-1] + 0.1 * (distinct[-1] + 1)
        self.base_size = self.n + 0.1 * (self.v + 1)

    def emission(self, counts: np.ndarray, cls: np.ndarray) -> np.ndarray:
        own = np.log10(np.maximum(counts, 1) / np.maximum(self.tokens[cls], 1))
        return np.where(cls == self.rare, np.log10((counts + 0.1) / self.rare_size), own)

    def base(self, counts) -> np.ndarray:
        return np.log10((np.asarray(counts) + 0.1) / self.base_size)

    def score(self, block: Block, cls: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        end = self.rare + 1
        before, after = block.neighbours(cls, end)
        own = cls[block.seq]
        token = self.move[before, own] + self.emission(counts, cls)[block.seq]
        sizes = np.diff(block.ends, prepend=0)
        add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[block.ends], prepend=0)
        final = np.where(sizes > 0, self.move[own[block.ends - 1] if len(own) else end, end], self.move[end, end])
        return pd.DataFrame({
            "doc_id": pd.array(block.ids, dtype="Int64"), "held_out": block.held, "n_tokens": sizes + 1,
            "n_known": add((counts[block.seq] > 0).astype(np.int64)) + (self.documents > 0),
            "train_tokens": self.n, "base_score": add(self.base(counts)[block.seq]) + float(self.base(self.documents)),
            "score": add(token) + final})


def score_documents(docs: DataFrame, classes: int = CLASSES, min_count: int = MIN_COUNT, rounds: int = ROUNDS,
                    id_col: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """Scores of all documents, learned from those whose id hash is not 0 modulo ``folds``."""
    spark, size = docs.sparkSession, classes + 2
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    held = F.coalesce(id_remainder(F.col("doc_id"), folds), F.lit(1)) == 0
    documents = rows.where(~held).count()
    state = written(cut_blocks(rows.withColumn("held_out", held), partitions(spark), classes), "lm-blocks")
    words = state.where("kind = 'words'")
    moves = sums(state, "moves", size * size).reshape(size, size)
    best = None
    for r in range(rounds):
        back = written(decide(words, state.where("kind = 'profile'"), moves, classes, min_count), "lm-classes")
        state = written(spread(state.where("kind = 'block'"), back.where("kind = 'back'"), classes, r + 1 < rounds),
                        "lm-blocks")
        moves = sums(state, "moves", size * size).reshape(size, size)
        value = likelihood(moves)
        if best is None or value > best[0]:
            model = Model(moves, sums(back, "distinct", classes + 1), sums(back, "tokens", classes + 1), documents)
            best = (value, state, model)
    _, state, model = best

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for blob in b.blob:
                d = unpack(blob)
                for part in block_of(d).slices():
                    yield model.score(part, d["cls"].astype(np.int64), d["counts"])

    scored = state.where("kind = 'block'").select("blob").mapInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
