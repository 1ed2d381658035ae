"""MinHash near-duplicates against all pairs of sets, and the odd sketch against its chances."""

import random
import re

import numpy as np
import pytest

from cartflow.llm import minhash
from cartflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_shingles string, key string, node string, row string, bands string, root string"


def brute(rows, shingle, percent=80):
    """Rows (id, size, smallest id reachable) by comparing all distinct sets."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append(frozenset(zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle
                    else frozenset([tuple(w)] if w else ()))
    distinct = [s for s in dict.fromkeys(sets) if s]
    parent = {s: s for s in distinct}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[find(a)] = find(b)
    low = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            low[find(s)] = min(low.get(find(s), i), i)
    return [(i, len(s), low.get(find(s)) if s else i) for (i, _), s in zip(rows, sets)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def hold(df, rows, shingle, **more):
    got = minhash.near_duplicates(df, shingle, **more).collect()
    want = brute(rows, shingle, **more)
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return got


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op12_minhash"](spark, SMALL).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute(rows, 2))
    assert any(not r.kept for r in got)


def family(seed, copies=60, words=150, most=0.14):
    """An original and copies of it with up to ``most`` of the words replaced: many lie about the least similarity."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for i in range(copies):
        w = list(base)
        for _ in range(rng.randrange(int(words * most) + 1)):
            w[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_families_and_odd_rows(spark):
    texts = family(1) + family(2) + family(3, words=12, copies=40) + family(4, words=5, copies=20)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (6, texts[0]), (None, texts[70]),
             (None, "alone without id"), (7, "x " * 20_000), (8, "y" * 100_000), (9, "é日本 text"), (9, "é日本 text")]
    df = spark.createDataFrame([(*r, *["own"] * 6) for r in rows], SCHEMA)
    hold(df, rows, 2)
    hold(df.where("doc_id < 990 or doc_id is null"), [r for r in rows if r[0] is None or r[0] < 990], 5)


def test_chain_without_a_centre(spark):
    """Neighbours are linked, most pairs are not, and all share passages."""
    common = [f"c{i}" for i in range(140)]
    rows = [(i, " ".join(common + [f"v{j}" for j in range(10 * i, 10 * i + 24)])) for i in range(40)]
    hold(spark.createDataFrame(rows, "doc_id long, text string"), rows, 2)


def test_blocks_of_a_crowded_bucket(spark):
    """All groups with a link come together, however the bucket is cut."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(4, 12)):
            w[rng.randrange(120)] = f"n{rng.randrange(40)}"
        texts.append(" ".join(w))
    hasher = minhash.Hasher(minhash.BANDS, minhash.ROWS, minhash.SKETCH_BITS)
    limit = minhash.most_different(minhash.BANDS * minhash.ROWS, minhash.SKETCH_BITS, 80)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = minhash.signatures(docs, 2, hasher, "doc_id", "text").withColumnRenamed("doc_id", "node").persist()
    shared = minhash.buckets(nodes)
    groups = spark.createDataFrame([(i, 0) for i in range(10)], "node long, root long")
    sets = [minhash.shingles_of(t, 2) for t in texts]
    root = [0 if i < 10 else i for i in range(70)]
    parent = list(range(70))

    def find(r):
        while parent[r] != r:
            r = parent[r]
        return r
    for j in range(70):
        for i in range(j):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(root[i])] = find(root[j])
    want = len({find(r) for r in root})
    for block in (8, 1000):
        mixed = minhash.mixed_buckets(shared, groups, block)
        got = minhash.links_between(mixed, nodes, docs.withColumnRenamed("doc_id", "node"), 2, 80, limit).collect()
        mine = list(range(70))

        def top(r):
            while mine[r] != r:
                r = mine[r]
            return r
        for r in got:
            assert 100 * len(sets[r.a] & sets[r.b]) >= 80 * len(sets[r.a] | sets[r.b])
            mine[top(root[r.a])] = top(root[r.b])
        assert len({top(r) for r in root}) == want
    assert 1 < want < 61


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_sketch_distance_is_passed_by_similar_sets():
    rng = np.random.default_rng(6)
    hasher = minhash.Hasher(minhash.BANDS, minhash.ROWS, minhash.SKETCH_BITS)
    limit = minhash.most_different(minhash.BANDS * minhash.ROWS, minhash.SKETCH_BITS, 80)
    apart = {}
    for share in (0.5, 0.8, 0.95):
        for _ in range(40):
            both, rest = round(300 * share), 300 - round(300 * share)
            h = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
            a, b = h[:both + rest // 2], np.concatenate([h[:both], h[both + rest // 2:]])
            s, t = (hasher.sketch(hasher.samples(x)).view(np.uint64) for x in (a, b))
            apart.setdefault(share, []).append(int(np.bitwise_count(s ^ t).sum()))
    assert max(apart[0.8]) <= limit and max(apart[0.95]) < min(apart[0.5])
    assert np.mean(np.array(apart[0.5]) > limit) > 0.5


@pytest.mark.parametrize("bits", [64, 512])
def test_most_different_is_a_quantile(bits):
    rng = np.random.default_rng(7)
    found = []
    for _ in range(4000):
        throws = rng.integers(0, bits, 2 * rng.binomial(384, 0.2))
        found.append(int((np.bincount(throws, minlength=bits) & 1).sum()))
    limit = minhash.most_different(384, bits, 80, miss=0.01)
    assert 0.001 < np.mean(np.array(found) > limit) < 0.02
