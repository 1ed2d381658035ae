"""Document quality from a linear-chain conditional random field over lines.

Every line gets features of its own and of its neighbours.  The field labels
lines good or bad; the posterior marginals of the forward-backward algorithm,
weighted by line length, add up to the document's quality.  It is fitted on a
bounded sample of labelled documents, each line taking its document's label.

Null and empty texts are one empty line.  Labels that are null or not 0 or 1
are ignored; a document with several labels uses the smallest.  Without
labelled documents the field is flat and every score is 0.5.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, rows_where

TRAIN_DOCS = 1500   # labelled documents that the fit reads
SEGMENT = 64        # lines of a document taken together in the fit
ROUNDS = 200
SYMBOLS = "#*$%&<>@^~=_{}[]\\"
_KEEP_SYMBOLS = {i: None for i in range(128) if chr(i) not in SYMBOLS}
OWN = 14


def line_features(line: str, before: str | None, seen: bool) -> list[float]:
    """Features of one line; ``before`` is the line above, ``seen`` whether the line occurred earlier."""
    words = line.split()
    n, size = len(words), len(line)
    if n == 0:
        return [0.0] * (OWN - 1) + [1.0]
    upper = sum(w.isupper() for w in words if len(w) > 1)
    symbols = sum(map(line.count, SYMBOLS))
    same = sum(a == b for a, b in zip(words, words[1:]))
    different = len(set(words))
    last = words[-1][-1]
    return [min(n, 100) / 100, min(size / n, 20) / 10, upper / n, min(symbols / n, 3.0), min(line.count("|") / n, 2.0),
            min(line.count("!") / n, 2.0), same / n, 1 - different / n if n > 20 else 0.0, float(last in ".!?"),
            float(seen), float(before == line), sum(c.isdigit() for c in line) / size, float(n < 4), 0.0]


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, line lengths); a line's row holds its own features, those of both neighbours, and 1."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    rows, before = [], None
    for x in lines:
        rows.append(line_features(x, before, x in seen))
        seen.add(x)
        before = x
    own = np.array(rows)
    up, down = np.zeros_like(own), np.zeros_like(own)
    up[1:], down[:-1] = own[:-1], own[1:]
    size = np.array([len(x) for x in lines], dtype=float)
    return np.concatenate([own, up, down, np.ones((len(own), 1))], axis=1), size


def _log_add(a, b):
    return np.logaddexp(a, b)


def fit(docs: list[tuple[np.ndarray, int]], rounds: int = ROUNDS, l2: float = 1.0):
    """(weights, transitions): the log-odds weights of state 1 and the 2 x 2 transition scores, by Adam."""
    width = 3 * OWN + 1
    weights, moves = np.zeros(width), np.zeros((2, 2))
    parts = [(x[i:i + SEGMENT], y) for x, y in docs for i in range(0, len(x), SEGMENT)]
    if not parts:
        return weights, moves
    count, longest = len(parts), max(len(x) for x, _ in parts)
    x = np.zeros((count, longest, width))
    mask = np.zeros((count, longest), dtype=bool)
    y = np.array([label for _, label in parts])
    for i, (rows, _) in enumerate(parts):
        x[i, :len(rows)] = rows
        mask[i, :len(rows)] = True
    both = mask[:, 1:]
    lines = mask.sum()
    theta = np.zeros(width + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weights, moves = theta[:width], theta[width:].reshape(2, 2)
        e = np.where(mask, x @ weights, 0.0)
        score = np.stack([np.zeros_like(e), e], axis=2)
        fwd, bwd = np.zeros_like(score), np.zeros_like(score)
        fwd[:, 0] = score[:, 0]
        for t in range(1, longest):
            now = _log_add(fwd[:, t - 1, :1] + moves[0], fwd[:, t - 1, 1:] + moves[1]) + score[:, t]
            fwd[:, t] = np.where(mask[:, t, None], now, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = score[:, t + 1] + bwd[:, t + 1]
            now = _log_add(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
            bwd[:, t] = np.where(mask[:, t + 1, None], now, bwd[:, t + 1])
        z = _log_add(fwd[:, -1, 0], fwd[:, -1, 1])[:, None]
        good = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z)
        grad_w = np.einsum("ntf,nt->f", x, np.where(mask, y[:, None] - good, 0.0))
        pair = np.exp(fwd[:, :-1, :, None] + moves + (score + bwd)[:, 1:, None, :] - z[:, :, None, None])
        seen = np.zeros((2, 2))
        for label in (0, 1):
            seen[label, label] = both[y == label].sum()
        grad_m = seen - (pair * both[:, :, None, None]).sum(axis=(0, 1))
        grad = (np.concatenate([grad_w, grad_m.ravel()]) - l2 * theta) / lines
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:width], theta[width:].reshape(2, 2)


def marginals(x: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Posterior probability that each line is good, as ratios of forward and backward sums."""
    e = np.exp(np.clip(x @ weights, -50, 50)).tolist()
    (a, b), (c, d) = np.exp(moves - moves.max()).tolist()  # bad-bad, bad-good, good-bad, good-good
    n = len(e)
    fwd = [0.0] * n
    r = e[0]
    fwd[0] = r
    for i in range(1, n):
        r = e[i] * (b + d * r) / (a + c * r)
        fwd[i] = r = min(max(r, 1e-100), 1e100)
    back = 1.0
    out = [0.0] * n
    for i in range(n - 1, -1, -1):
        odds = fwd[i] * back
        out[i] = odds / (1 + odds)
        q = e[i] * back
        back = min(max((c + d * q) / (a + b * q), 1e-100), 1e100)
    return np.array(out)


def quality(text: str | None, weights: np.ndarray, moves: np.ndarray) -> float:
    x, size = document_features(text)
    p = marginals(x, weights, moves)
    return float(p @ size / size.sum()) if size.sum() else float(p.mean())


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS):
    """Fit on at most ``train_docs`` labelled documents that are not held out."""
    usable = labels.where(F.col("quality").isin(0, 1)
                          & (F.coalesce(id_remainder(F.col("doc_id"), 3), F.lit(1)) != 1))
    chosen = usable.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("label")) \
        .orderBy(F.xxhash64("id"), "id").limit(train_docs)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")) \
        .select("doc_id", "text", "label")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [document_features(t)[0].astype(np.float32) for t in b.text]
            yield pd.DataFrame({"doc_id": b.doc_id, "label": b.label, "lines": [len(x) for x in got],
                                "x": [x.tobytes() for x in got]})

    got = rows.mapInPandas(features, "doc_id long, label int, lines int, x binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.x))
    return fit([(np.frombuffer(r.x, np.float32).reshape(r.lines, -1).astype(float), r.label) for r in got])


def score(docs: DataFrame, model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    weights, moves = model

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "score": [quality(t, weights, moves) for t in b.text]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, score double")


def good_rows(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good."""
    weights, moves = train(docs, labels, train_docs)
    return rows_where(docs, lambda: lambda texts: [quality(t, weights, moves) >= 0.5 for t in texts])


def classify(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    return score(docs, train(docs, labels, train_docs)).select(
        "doc_id", (F.coalesce(id_remainder(F.col("doc_id"), 3), F.lit(0)) == 1).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
