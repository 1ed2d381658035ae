"""SimHash links where groups are crowded, and the choice of pieces."""

from collections import defaultdict

import numpy as np
import pytest

from cartflow.llm import simhash


def hold(spark, points, **more):
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    links = simhash.linked(frame, 4, **more)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    groups = simhash.Groups(len(points))
    groups.link(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= 4))
    want, mine, signed = defaultdict(set), defaultdict(set), points.view(np.int64).tolist()
    for p, g in zip(signed, groups.labels().tolist()):
        want[g].add(p)
        mine[got.get(p, p)].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))
    return len(want)


def test_crowded_groups_are_split_by_trees(spark, monkeypatch):
    """Fingerprints that share half their bits all meet in some groups, which are cut into shards."""
    rng = np.random.default_rng(9)
    points = np.unique(rng.integers(0, 1 << 28, 1500, dtype=np.uint64) << np.uint64(20) | np.uint64(5))
    flips = np.uint64(1) << rng.integers(0, 64, (700, 3)).astype(np.uint64)
    near = points[:700] ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]
    points = np.unique(np.concatenate([points, near]))
    seen = []
    real = simhash.split_by_trees

    def watched(hot, trees, bits):
        seen.extend(trees.values())
        return real(hot, trees, bits)
    monkeypatch.setattr(simhash, "split_by_trees", watched)
    assert hold(spark, points, shard_points=200) > 100
    assert any(isinstance(t, tuple) for t in seen)


def test_equal_and_few_fingerprints(spark):
    assert hold(spark, np.array([7], dtype=np.uint64)) == 1
    assert hold(spark, np.array([0, 1, (1 << 64) - 1, (1 << 64) - 2], dtype=np.uint64)) == 2


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_close_fingerprints_agree_under_some_mask(agree):
    rng = np.random.default_rng(10)
    masks = simhash.masks(4, agree)
    assert len(masks) == {1: 5, 2: 15, 3: 35}[agree]
    for _ in range(300):
        a = int(rng.integers(-2**63, 2**63 - 1))
        b = a
        for bit in rng.choice(64, 4, replace=False).tolist():
            b ^= (1 << bit) if bit < 63 else -(1 << 63)
        assert any(a & m == b & m for m in masks)


def test_pieces_grow_with_the_rows():
    assert [len(simhash.pieces_for(n, 4, 8192)) for n in (0, 10**6, 10**8, 10**12)] == [5, 5, 15, 35]
