"""Language identification with segmentation-marginalised unigrams.

The pieces come from a fixed public vocabulary.  Each language has a
probability for every piece; a word's probability is the sum over all its
segmentations into pieces (forward algorithm), and a text's the product over
its words.  The piece probabilities are fitted by expectation-maximisation on
a bounded sample of labelled documents, ``train_docs`` for each language.

Words are runs of letters, lower-cased.  Null texts and texts without letters
are ``und`` with score 0.  Equal scores go to the alphabetically first
language.  Without any labelled document every text is ``und``.

An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_remainder, keep, rows_where

TRAIN_DOCS = 200       # labelled documents of each language that the fit reads
EM_ROUNDS = 3
LONGEST = 8            # letters in a piece
START = "▁"       # marks the beginning of a word, as in the vocabulary
SHORT = 24             # letters of the words that are scored together
CACHE = 400_000        # words kept by a worker before it starts afresh

# Multipliers of a word's characters in the hash of its pieces.
POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(LONGEST + 1)], dtype=np.uint64)
RUNS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """The runs of letters, lower-cased; a run with signs such as a raised two is split at them."""
    out: list[str] = []
    for w in RUNS.findall(text.lower()) if text else ():
        out += [w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split()
    return out


def vocabulary(model_path: str) -> list[str]:
    """Lower-cased letter pieces of a sentencepiece model, at most ``LONGEST`` letters, plus the word start."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    keep = {p for p in found if 0 < len(p.removeprefix(START)) <= LONGEST and p.removeprefix(START).isalpha()}
    return sorted(keep | {START})


def fit(words: Counter, pieces: list[str], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """Piece probabilities of one language from its word counts.

    The last entry, under the empty string, is the probability of a character
    that is no piece.
    """
    known = set(pieces)
    prob = {p: 1.0 / (len(p) + 1) ** 2 for p in known}
    total = sum(prob.values())
    prob = {p: v / total for p, v in prob.items()}
    other = 1e-6
    longest = LONGEST + 1
    for _ in range(rounds):
        expected: dict[str, float] = dict.fromkeys(known, 0.0)
        unseen = 0.0
        for word, n in words.items():
            w = START + word
            size = len(w)
            fwd = [1.0] + [0.0] * size
            scale = 1.0
            arcs = []
            for j in range(1, size + 1):
                total = 0.0
                for i in range(max(0, j - longest), j):
                    p = w[i:j]
                    q = prob.get(p)
                    if q is None and j - i == 1:
                        p, q = "", other
                    if q is not None:
                        arcs.append((i, j, p, q))
                        total += fwd[i] * q
                fwd[j] = total
            bwd = [0.0] * size + [1.0]
            scale = n / fwd[size] if fwd[size] > 0 else 0.0
            for i, j, p, q in reversed(arcs):
                back = q * bwd[j]
                bwd[i] += back
                if p:
                    expected[p] += fwd[i] * back * scale
                else:
                    unseen += fwd[i] * back * scale
        total = sum(expected.values()) + unseen + 0.01 * (len(known) + 1)
        prob = {p: (v + 0.01) / total for p, v in expected.items()}
        other = (unseen + 0.01) / total
    return prob | {"": other}


class Scorer:
    """Log-probabilities of words under every language at once."""

    def __init__(self, languages: list[str], priors: list[float], table: dict[str, tuple[float, ...]]):
        self.languages, self.table = languages, table
        self.priors = np.array(priors)
        self.other = table.get("", (1e-6,) * len(languages))
        # By piece length: sorted hashes, and the row of each in probs; row 0 is zero, row 1 a character that is no piece.
        self.probs = np.zeros((len(table) + 2, len(languages)))
        self.probs[1] = self.other
        found: dict[int, list[tuple[int, int]]] = {}
        for i, (piece, p) in enumerate(table.items()):
            self.probs[i + 2] = p
            if piece:
                code = np.array([piece]).view(np.uint32).astype(np.uint64)
                found.setdefault(len(piece), []).append((int((code * POWERS[:len(code)]).sum()), i + 2))
        self.lookup = {n: tuple(np.array(c, dtype=t) for c, t in zip(zip(*sorted(v)), (np.uint64, np.int64)))
                       for n, v in found.items()}
        self.reset()

    def short_words(self, words: list[str]) -> np.ndarray:
        """Rows of log-probabilities of words of at most ``SHORT`` letters, all at once."""
        n, size = len(words), SHORT + 1
        code = np.array([START + w for w in words], dtype=f"U{size}").view(np.uint32).reshape(n, size).astype(np.uint64)
        fwd = np.zeros((size + 1, n, len(self.languages)))
        fwd[0] = 1.0
        rows, h = {}, np.zeros((n, size), dtype=np.uint64)
        for k in range(1, LONGEST + 2):
            h = h[:, :size - k + 1] + code[:, k - 1:] * POWERS[k - 1]
            if k in self.lookup:
                keys, at = self.lookup[k]
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                rows[k] = np.where(keys[i] == h, at[i], 1 if k == 1 else 0)
        rows.setdefault(1, np.ones((n, size), dtype=np.int64))
        for j in range(1, size + 1):
            for k, row in rows.items():
                if k <= j:
                    fwd[j] += fwd[j - k] * self.probs[row[:, j - k]]
        ends = np.fromiter(map(len, words), dtype=np.int64, count=n) + 1
        return np.log(np.maximum(fwd[ends, np.arange(n)], 1e-300))

    def learn(self, texts: list[list[str]]) -> None:
        """Rows for all new words of the texts."""
        if len(self.index) > CACHE:
            self.reset()
        new = list({w for t in texts for w in t if w not in self.index})
        short = [w for w in new if len(w) <= SHORT]
        for i in range(0, len(short), 4000):
            part = short[i:i + 4000]
            self._add(part, self.short_words(part))
        for w in new:
            if len(w) > SHORT:
                self._add([w], np.array([self.word(w)]))

    def _add(self, words: list[str], rows: np.ndarray) -> None:
        at = len(self.index)
        while at + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((len(self.rows) + 4096, len(self.languages)))])
        self.rows[at:at + len(words)] = rows
        self.index.update(zip(words, range(at, at + len(words))))

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.languages)))

    def word(self, word: str) -> list[float]:
        """Sum over all segmentations, by the forward algorithm, rescaled at every character."""
        w = START + word
        k = len(self.languages)
        get, other = self.table.get, self.other
        fwd = [(1.0,) * k]
        log = [0.0] * k
        for j in range(1, len(w) + 1):
            now = [0.0] * k
            for i in range(max(0, j - LONGEST - 1), j):
                q = get(w[i:j])
                if q is None:
                    if j - i > 1:
                        continue
                    q = other
                now = [a + f * x for a, f, x in zip(now, fwd[i], q)]
            fwd.append(now)
            if j % 16 == 0:  # keeps long words within floating point
                for c in range(k):
                    top = max(f[c] for f in fwd[-LONGEST - 1:])
                    if 0 < top < 1e-60:
                        log[c] += math.log(top)
                        for x in range(max(0, len(fwd) - LONGEST - 2), len(fwd)):
                            fwd[x] = [v / top if y == c else v for y, v in enumerate(fwd[x])]
        return [g + math.log(max(f, 1e-300)) for g, f in zip(log, fwd[-1])]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        cut = [letter_words(t) for t in texts]
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        self.learn(cut)
        get, out = self.index.__getitem__, []
        for words in cut:
            if not words:
                out.append(("und", 0.0))
                continue
            at = np.fromiter(map(get, words), dtype=np.int64, count=len(words))
            total = self.priors + self.rows[at].sum(axis=0)
            best = int(np.argmax(total))
            out.append((self.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def train(docs: DataFrame, model_path: str, train_docs: int = TRAIN_DOCS):
    """(languages, log priors, table): the table has the pieces of the fixed vocabulary, a number per language each."""
    labelled = docs.where(F.col("lang").isNotNull()
                          & (F.coalesce(id_remainder(F.col("doc_id"), 4), F.lit(0)) != 2))
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("doc_id", "lang").withColumn("nth", F.row_number().over(order)) \
        .where(F.col("nth") <= train_docs).select("doc_id").distinct()
    # At most train_docs ids for each language.
    sample = labelled.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text")

    def fit_language(rows: pd.DataFrame) -> pd.DataFrame:
        words: Counter = Counter()
        for t in rows.text:
            words.update(letter_words(t))
        prob = fit(words, vocabulary(model_path))
        return pd.DataFrame({"lang": rows.lang.iloc[0], "piece": list(prob), "p": list(prob.values())})

    fitted = sample.groupBy("lang").applyInPandas(fit_language, "lang string, piece string, p double").collect()
    languages = sorted({r.lang for r in fitted})
    place = {x: i for i, x in enumerate(languages)}
    table: dict[str, list[float]] = {}
    for r in fitted:
        table.setdefault(r.piece, [0.0] * len(languages))[place[r.lang]] = r.p
    total = sum(counts[x] for x in languages) or 1
    return languages, [math.log(counts[x] / total) for x in languages], {p: tuple(v) for p, v in table.items()}


def _scorer(key: str, shared) -> Scorer:
    return keep(("langid", key), lambda: Scorer(*shared.value))


def explained(docs: DataFrame, model_path: str, least: float, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` that have a language, with a score of at least ``least``."""
    import uuid
    model = train(docs, model_path, train_docs)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def judge_of():
        scorer = _scorer(key, shared)
        return lambda texts: [lang != "und" and score >= least for lang, score in scorer.predict(texts)]

    return rows_where(docs, judge_of)


def predict(docs: DataFrame, model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``."""
    import uuid
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = _scorer(key, shared)
        for b in batches:
            for i in range(0, len(b), 500):
                part = b.iloc[i:i + 500]
                got = scorer.predict(part.text.tolist())
                yield pd.DataFrame({"doc_id": part.doc_id, "lang_pred": [g[0] for g in got],
                                    "score": [g[1] for g in got]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, model_path: str, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the documents that are not held out."""
    return predict(docs, train(docs, model_path, train_docs)).select(
        "doc_id", (F.coalesce(id_remainder(F.col("doc_id"), 4), F.lit(0)) == 2).alias("held_out"),
        "lang_pred", "score")
