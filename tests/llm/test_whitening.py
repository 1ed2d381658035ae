"""Embedding whitening against numpy on all rows."""

import numpy as np
import pytest

from cartflow.llm import whitening
from cartflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, x string, index string, n string"


def brute(rows):
    """Whole vectors by id, and (n, sums, eigenvalues, vectors, trace) of their distinct set, in plain numpy."""
    whole = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in whole}), dtype=object)
    n, total = len(fit), fit.sum(axis=0)
    off = (fit * n - total).astype(float) / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:16]
    return whole, n, total, values[order], vectors[:, order], values.sum()


def hold(got, rows):
    whole, n, total, values, vectors, trace = brute(rows)
    kept = values > whitening.LEAST_SHARE * trace
    assert len(got) == len(whole) * kept.sum()
    assert all(r.n == n and r.identity_error <= 1e-4 for r in got)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x in whole:
        off = np.array(x, dtype=object) * n - total
        for k in np.flatnonzero(kept):
            for r in by[i, k + 1]:
                assert r.deviation == (square if (square := int((off * off).sum())) < 1 << 63 else None)
                assert r.explained == pytest.approx(values[k] / trace, rel=1e-4)
                want = float((off.astype(float) / n) @ vectors[:, k] / np.sqrt(values[k]))
                if abs(want) > 1e-6:
                    sign = signs.setdefault(k, np.sign(want) * np.sign(r.whitened))
                    assert r.whitened * sign == pytest.approx(want, rel=1e-6, abs=1e-8)


def test_registered_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    hold(QUERIES["op11_whitening"](spark, SMALL).collect(), rows)


def test_odd_rows_and_copies(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)] + [(None, [0.5, -0.5, 1e6]), (5, good[5][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, float("nan"), 2.0]),
           (204, [1.0, float("inf"), 2.0]), (205, [1e300, 0.0, 0.0]), (206, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "own", "own", "own") for i, v in good + bad], SCHEMA)
    hold(whitening.whiten(df).collect(), good)
    far = good[:9] + [(99, [1e12, 0.0, 0.0])]  # deviations over 64 bits
    hold(whitening.whiten(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect(), far)


def test_blocks_and_splits(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(whitening, "BLOCKS_PER_SPLIT", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(100)]
    hold(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)


def test_no_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0]) for i in range(5)], schema)).collect()
    assert len(line) == 5 and {r.component for r in line} == {1}
