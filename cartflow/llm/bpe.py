"""Byte-level BPE through a sentencepiece model made from a rank file.

The model is serialised directly from the vocabulary: each token's bytes are
mapped to one character per byte (byte b to U+0100 + b), its score is its
negative rank, and the normaliser is the identity.  Texts are cut by the
pre-token pattern, each distinct pre-token is encoded once per worker, and ids
decode by the inverse mapping.

Null texts count as empty and have no ids.  Repeated rows are kept.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

CACHE = 1_000_000  # pre-tokens kept by a worker before it starts afresh
BYTE_CHARS = 0x100


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def byte_text(raw: bytes) -> str:
    """One character for each byte."""
    return "".join(map(_CHARS.__getitem__, raw))


_CHARS = [chr(BYTE_CHARS + b) for b in range(256)]


# Protocol-buffer wire format: a varint key (field * 8 + kind), then the value.
def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, raw: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(raw)) + raw


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece ids are the ranks; the unknown piece comes after them.

    Ranks must be 0 to len-1 and hold all 256 single bytes.
    """
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must run from 0 without gaps and hold every single byte")
    # Fixed values of the format: piece 1, score 2, type 3 (1 normal, 2 unknown); model type 3 (2 is BPE),
    # vocabulary size 4, ids of unknown, begin, end and padding 40 to 43; normaliser name 1, flags 3 to 5.
    pieces = [_block(1, _block(1, byte_text(t).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(r)) +
                     _number(3, 1)) for r, t in enumerate(by_rank)]
    pieces.append(_block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2)))
    trainer = (_number(3, 2) + _number(4, len(by_rank) + 1) + _number(40, len(by_rank)) + _number(41, -1)
               + _number(42, -1) + _number(43, -1))
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normaliser)


class ByteBpe:
    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece
        self.ranks = read_ranks(ranks_path)
        self.tokens = sorted(self.ranks, key=self.ranks.__getitem__)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.ranks))
        self.cut = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        hard = []
        for p in new:
            rank = self.ranks.get(p.encode())
            if rank is None:
                hard.append(p)
            else:
                self.cache[p] = struct.pack("<I", rank)
        for i in range(0, len(hard), 5000):
            part = hard[i:i + 5000]
            for p, ids in zip(part, self.model.encode([byte_text(p.encode()) for p in part], num_threads=1)):
                self.cache[p] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.cache) > CACHE:
            self.cache = {}
        cuts = [self.cut(t) for t in texts]
        known = self.cache
        self._learn(list({p for c in cuts for p in c if p not in known}))
        get = known.__getitem__
        return [b"".join(map(get, c)) for c in cuts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ids as little-endian 32-bit numbers, decoded as bytes from the ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = keep(("bpe", ranks_path, pattern), lambda: ByteBpe(ranks_path, pattern))
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.iloc[i:i + 500]
                ids = coder.encode(["" if t is None else t for t in part.text])
                yield pd.DataFrame({"doc_id": part.doc_id, "n_tokens": [len(x) // 4 for x in ids], "ids": ids,
                                    "decoded": [coder.decode(x) for x in ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
