"""Token ids in a compact file format: static range asymmetric numeral system.

One frequency table, counted over the whole corpus and scaled to 2^20 slots,
is shared by all blocks.  A block holds whole documents and is coded on its
own: its ids are dealt to interleaved lanes of 64-bit states that renormalise
by 32-bit words.  At every ``STEPS`` rounds the encoder notes all lane states
and the word position (a checkpoint), so that parts of a block can be decoded
in parallel; each block carries CRC-32 sums of its payload and of its ids.

A written folder has ``blocks`` (one row per block, in ascending document
order), ``frequencies`` (id, slots) and is read back by ``read_ids``.

Null texts count as empty.  Repeated ids of documents keep all their rows.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
LOW = np.uint64(1 << 31)
LANES = 1024
STEPS = 256          # rounds between checkpoints
BLOCK_TOKENS = 1 << 19
NO_ID = -(1 << 63)   # stands for a null document id, before all others
CACHE = 1_400_000    # pieces kept by a worker at most, about 300 MB; the half used last stays
BATCH_CHARS = 8_000_000  # characters of texts encoded at a time

PLAIN_PIECE = re.compile(r" ?\S+")
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"   # ASCII punctuation


def _table_of(*parts: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[np.frombuffer(b"".join(parts), np.uint8)] = True
    return found


SPACE = _table_of(b"\t\n\v\f\r ")
MAY_BE_SPACE = SPACE | _table_of(bytes(range(28, 32)))
MARK = _table_of(MARKS)
ALNUM = _table_of(bytes(c for c in range(128) if chr(c).isalnum()))
# First bytes of characters that are not white space (U+0085, U+00A0 and those with first byte E1, E2 or E3 may be).
SOLID = _table_of(bytes(range(33, 127)), bytes(range(0xC3, 0xE1)), bytes(range(0xE4, 0xF5)))


def piece_starts(data: bytes, at: np.ndarray) -> np.ndarray:
    """Where pieces of UTF-8 texts start; ``at`` has where each text starts, and the end.

    A pre-token never runs from a non-space into white space, a lone line break
    before a non-space is a pre-token of its own, and none runs from a letter or
    digit into punctuation.  What stands before a cut has no part in what
    follows, so the ids of a text are those of its pieces.
    """
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    space = MAY_BE_SPACE[b]   # at the last byte of a character
    word = ALNUM[b]           # the same, of a letter or digit
    if not data.isascii():
        one, two = b[:-1], b[1:]
        space[1:] |= (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        # Letters up to U+024F, the same in every version of Unicode; not the signs of multiplying and dividing.
        word[1:] |= ((one == 0xC3) & (two != 0x97) & (two != 0xB7)) | ((one >= 0xC4) & (one <= 0xC8))
        wide = np.flatnonzero((b >= 0xE1) & (b <= 0xE3))
        x, y, z = b[wide], b[wide + 1], b[wide + 2]
        space[wide[((x == 0xE1) & (y == 0x9A) & (z == 0x80)) | ((x == 0xE3) & (y == 0x80) & (z == 0x80))
                   | ((x == 0xE2) & (y == 0x81) & (z == 0x9F))
                   | ((x == 0xE2) & (y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF)))] + 2] = True
    cut = np.zeros(len(b), dtype=bool)
    cut[1:] = (SPACE[b[1:]] & ~space[:-1]) | (MARK[b[1:]] & word[:-1])
    first = at[:-1][at[:-1] < at[1:]]
    cut[first] = True
    line = np.flatnonzero((b[:-1] == 10) & cut[:-1] & SOLID[b[1:]])
    cut[line + 1] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Ids of texts by a ``tokenizers`` file with byte-level pre-tokens.

    Texts are cut where a pre-token always ends (``piece_starts``), and each
    distinct piece of a batch is looked up, or encoded by the library, once.
    """

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.newline = self._ids(["\n"])[0]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Put pieces into the cache: from the older half, else by the library, many to a text, one on each line."""
        older = self.older
        rest, lone = [], []
        for p in pieces:
            if p in older:
                self.cache[p] = older[p]
            elif PLAIN_PIECE.fullmatch(p):
                rest.append(p)
            else:
                lone.append(p)
        self.cache.update(zip(lone, self._ids(lone)))
        mark = np.frombuffer(self.newline, "<u4")[0]
        for i in range(0, len(rest), 4000):
            part = rest[i:i + 4000]
            raw = self._ids(["\n".join(part)])[0]
            ends = np.append(np.flatnonzero(np.frombuffer(raw, "<u4") == mark), len(raw) // 4).tolist()
            at = 0
            for p, e in zip(part, ends, strict=True):
                self.cache[p] = raw[4 * at:4 * e]
                at = e + 1

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.cache) > CACHE // 2:
            self.cache, self.older = {}, self.cache
        raw = [t.encode() for t in texts]
        at = np.cumsum([0, *map(len, raw)], dtype=np.int64)
        data = b"".join(raw)
        starts = piece_starts(data, at)
        coded = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)).dictionary_encode()
        pieces, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._learn([p for p in pieces if p not in self.cache])
        known = [self.cache[p] for p in pieces]
        size = np.array([len(k) for k in known], dtype=np.int64) // 4
        # Ids of the pieces in the order of the texts.
        n = size[which]
        ends = np.cumsum(n)
        shift = (np.cumsum(size) - size)[which] - (ends - n)
        ids = np.frombuffer(b"".join(known), "<u4")[np.repeat(shift, n) + np.arange(n.sum())].tobytes()
        bounds = (4 * np.append(0, ends)[np.searchsorted(starts, at)]).tolist()
        return [ids[i:j] for i, j in zip(bounds, bounds[1:])]


def batches_of(texts: list[str], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with ``most`` characters at most, or of one text."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


_ENCODERS: dict[str, PieceEncoder] = {}
_ZIP, _UNZIP = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) with ``end_id`` appended; see ``pack_ids`` for ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from cartflow.llm import rans  # the worker's own module keeps the encoder from task to task
        if tokenizer_path not in rans._ENCODERS:
            rans._ENCODERS[tokenizer_path] = PieceEncoder(tokenizer_path)
        enc = rans._ENCODERS[tokenizer_path]
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            texts = ["" if t is None else t for t in b.text]
            for i, j in batches_of(texts):
                ids = [x + end for x in enc.encode(texts[i:j])]
                yield pd.DataFrame({"doc_id": b.doc_id.iloc[i:j], "n_tokens": [len(x) // 4 for x in ids],
                                    "ids": [pack_ids(x) for x in ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids binary")


def pack_ids(raw: bytes) -> bytes:
    """Ids compressed, as 16-bit numbers where they fit; the first byte says which."""
    ids = np.frombuffer(raw, "<u4")
    small = len(ids) == 0 or int(ids.max()) < 1 << 16
    return (b"2" if small else b"4") + _ZIP.compress(ids.astype("<u2").tobytes() if small else raw)


def unpack_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(_UNZIP.decompress(packed[1:]), "<u2" if packed[:1] == b"2" else "<u4").astype("<u4")


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) over all rows; each task sends each of its ids once."""

    def run(batches):
        total: dict[int, int] = {}
        held: list[np.ndarray] = []
        size = 0

        def fold():
            ids, n = np.unique(np.concatenate(held), return_counts=True)
            for i, k in zip(ids.tolist(), n.tolist()):
                total[i] = total.get(i, 0) + k
        for b in batches:
            for x in b.ids:
                held.append(unpack_ids(x))
                size += len(held[-1])
                if size > 4_000_000:
                    fold()
                    held, size = [], 0
        if held:
            fold()
        yield pd.DataFrame({"id": list(total), "n": list(total.values())}, dtype="int64")

    return tokens.select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def scale(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Counts scaled to ``SLOTS`` slots in all, at least one for each id that occurs."""
    if len(ids) > SLOTS:
        raise ValueError(f"more than {SLOTS} different ids")
    if len(ids) == 0:
        return n.astype(np.int64)
    share = np.maximum(1, np.floor(n * (SLOTS / n.sum()))).astype(np.int64)
    order = np.lexsort((ids, -share))
    extra = SLOTS - int(share.sum())
    while extra:
        take = order[:min(abs(extra), len(order))]
        if extra < 0:
            take = take[share[take] > 1]
        share[take] += 1 if extra > 0 else -1
        extra = SLOTS - int(share.sum())
    return share


class Coder:
    """Encoder and decoder of blocks under one frequency table."""

    def __init__(self, ids: np.ndarray, slots: np.ndarray):
        self.ids = ids.astype(np.uint32)          # ascending
        self.freq = slots.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(slots)[:-1]]).astype(np.uint64) if len(slots) else self.freq
        self.symbol = np.repeat(np.arange(len(ids), dtype=np.int32), slots)
        self.place = None  # of each id among ``ids``; large ids are searched for instead
        if len(ids) and int(ids[-1]) < 1 << 24:
            self.place = np.zeros(int(ids[-1]) + 1, dtype=np.int32)
            self.place[ids] = np.arange(len(ids), dtype=np.int32)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(payload words, checkpoints): the decoder reads the payload forwards."""
        sym = np.searchsorted(self.ids, ids) if self.place is None else self.place[ids]
        rounds = -(-len(sym) // LANES)
        state = np.full(LANES, LOW, dtype=np.uint64)
        out: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        written = 0
        b = np.uint64(SLOT_BITS)
        for r in range(rounds - 1, -1, -1):
            s = sym[r * LANES:(r + 1) * LANES]
            x, f = state[:len(s)], self.freq[s]
            full = (x >> np.uint64(63 - SLOT_BITS)) >= f
            if full.any():
                words = x[full].astype(np.uint32)[::-1]
                out.append(words)
                written += len(words)
                x = np.where(full, x >> np.uint64(32), x)
            q, rem = np.divmod(x, f)
            state[:len(s)] = (q << b) + rem + self.cum[s]
            if r % STEPS == 0:
                marks.append((written, state.copy()))
        payload = np.concatenate(out or [np.zeros(0, np.uint32)])[::-1].astype("<u4").tobytes()
        # Word positions from the payload's front, first part first.
        heads = b"".join(np.array([written - w], "<u8").tobytes() + s.astype("<u8").tobytes()
                         for w, s in reversed(marks))
        return payload, heads

    def decode_part(self, payload: bytes, head: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of one part, from its checkpoint alone."""
        words = np.frombuffer(payload, "<u4").astype(np.uint64)
        at = int(np.frombuffer(head[:8], "<u8")[0])
        state = np.frombuffer(head[8:], "<u8").astype(np.uint64)
        out = np.empty(n, dtype=np.int32)
        mask, b = np.uint64(SLOTS - 1), np.uint64(SLOT_BITS)
        for i in range(0, n, LANES):
            k = min(LANES, n - i)
            x = state[:k]
            slot = x & mask
            s = self.symbol[slot.astype(np.int64)]
            out[i:i + k] = s
            x = self.freq[s] * (x >> b) + slot - self.cum[s]
            low = x < LOW
            m = int(low.sum())
            if m:
                x[low] = (x[low] << np.uint64(32)) | words[at:at + m]
                at += m
            state[:k] = x
        return self.ids[out]

    def decode(self, payload: bytes, heads: bytes, n: int) -> np.ndarray:
        size, part = 8 * (LANES + 1), LANES * STEPS
        return np.concatenate([self.decode_part(payload, heads[i * size:(i + 1) * size], min(part, n - i * part))
                               for i in range(-(-n // part))] or [np.zeros(0, np.uint32)])


BLOCK = ("file int, block int, first long, doc_ids binary, counts binary, n long, heads binary, payload binary, "
         "payload_crc long, ids_crc long")


def _table(rows) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([r.id for r in rows], dtype=np.int64)
    return ids, np.array([r.slots for r in rows], dtype=np.int64)


def write_ids(tokens: DataFrame, path: str, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write ``tokens`` (doc_id, n_tokens, ids) to ``path`` in ascending doc_id order.

    The frequency table has one row per id of the vocabulary (2^20 at most) and
    is all that reaches the driver.
    """
    spark = tokens.sparkSession
    counted = count_ids(tokens).orderBy("id").collect()
    ids = np.array([r.id for r in counted], dtype=np.int64)
    slots = scale(ids, np.array([r.n for r in counted], dtype=np.float64))
    spark.createDataFrame(pd.DataFrame({"id": ids, "slots": slots.astype(np.int64)}), "id long, slots long") \
        .coalesce(1).write.parquet(f"{path}/frequencies")
    table = spark.sparkContext.broadcast((ids, slots))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        coder, file = Coder(*table.value), TaskContext.get().partitionId()
        docs: list[int] = []
        parts: list[np.ndarray] = []
        number = size = first = 0

        def block():
            all_ids = np.concatenate(parts)
            payload, heads = coder.encode(all_ids)
            return pd.DataFrame([{
                "file": file, "block": number, "first": first, "doc_ids": np.array(docs, "<i8").tobytes(),
                "counts": np.array([len(p) for p in parts], "<i8").tobytes(), "n": size, "heads": heads,
                "payload": payload, "payload_crc": zlib.crc32(payload),
                "ids_crc": zlib.crc32(all_ids.astype("<u4").tobytes())}])
        for b in batches:
            for doc_id, packed in zip(b.doc_id, b.ids):
                part = unpack_ids(packed)
                if size and size + len(part) > block_tokens:
                    yield block()
                    first += size
                    docs, parts, number, size = [], [], number + 1, 0
                docs.append(doc_id)
                parts.append(part)
                size += len(part)
        if parts:
            yield block()

    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = tokens.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "ids") \
        .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInPandas(run, BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32), decoded from the files at ``path``."""
    table = spark.sparkContext.broadcast(_table(
        spark.read.parquet(f"{path}/frequencies").orderBy("id").collect()))
    blocks = spark.read.parquet(f"{path}/blocks")
    # Ids before each file: one row per written file reaches the driver.
    before, total = {}, 0
    for r in blocks.groupBy("file").agg(F.sum("n").alias("n")).orderBy("file").collect():
        before[r.file] = total
        total += r.n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(*table.value)
        for b in batches:
            for r in b.itertuples(index=False):
                if zlib.crc32(r.payload) != r.payload_crc:
                    raise ValueError(f"file {r.file}, block {r.block}: damaged payload")
                ids = coder.decode(r.payload, r.heads, r.n).astype("<u4")
                if zlib.crc32(ids.tobytes()) != r.ids_crc:
                    raise ValueError(f"file {r.file}, block {r.block}: wrong ids")
                docs = np.frombuffer(r.doc_ids, "<i8")
                counts = np.frombuffer(r.counts, "<i8")
                ends = np.cumsum(counts)
                yield pd.DataFrame({
                    "doc_id": pd.arrays.IntegerArray(docs.copy(), docs == NO_ID),
                    "start": before[r.file] + r.first + ends - counts, "n_tokens": counts,
                    "ids_crc32": [zlib.crc32(ids[e - k:e].tobytes()) for e, k in zip(ends, counts)]})

    return blocks.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Tokenize, write the files in the shared folder, and decode them again."""
    from .common import written
    spark = docs.sparkSession
    tokens = written(tokenize(docs, tokenizer_path, end_id), "token-ids")
    path = new_path(spark, "rans")
    write_ids(tokens, path)
    return read_ids(spark, path)
