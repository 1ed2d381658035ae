"""SimHash near-duplicates found in vantage-point trees.

Fingerprints within the link radius agree on some pieces of their bits, so
each distinct fingerprint joins one group for every choice of pieces: a fixed
number of copies, whatever the number of fingerprints.  A crowded group is
split into the leaves (shards) of a vantage-point tree grown on a share of it,
which shapes the tree and nothing else; there a fingerprint also visits every
later shard that its ball of the link radius may reach by the triangle
inequality, so each linked pair meets in one shard.  In a shard a local tree
finds the exact pairs, of which only the links that join different groups
leave the task; components follow by star contraction.

Null and word-less texts have fingerprint zero and are linked like any other.
Repeated rows share their fingerprint and component.  Null ids are never the
smallest of a component that has another id.  An empty table gives no rows.
Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, partitions, written

SEED = 42
SHARD_POINTS = 8_192   # fingerprints aimed at for each shard
SAMPLES = 16           # fingerprints that shape a leaf of a crowded group's tree
MOST_LEAVES = 1 << 20
LEAF = 256


def fingerprint_of(text: str, shingle: int) -> int:
    """Unsigned 64-bit SimHash over word shingles, repeats counted."""
    import xxhash
    w = text.encode().lower().split()  # bytes: lower-cases A-Z and splits at the six ASCII spaces only
    if not w:
        return 0
    h, join = xxhash.xxh64_intdigest, b" ".join
    if len(w) <= shingle:
        return h(join(w), SEED)
    hashes = np.fromiter((h(join(s), SEED) for s in zip(*(w[i:] for i in range(shingle)))), dtype="<u8",
                         count=len(w) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for b in batches:
            fps = np.fromiter((fingerprint_of(t or "", shingle) for t in b.text), dtype=np.uint64, count=len(b))
            yield pd.DataFrame({"doc_id": b.doc_id, "fp": fps.view(np.int64)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, fp long")


def distance(a, b):
    return np.bitwise_count(a ^ b)


def grow(points: np.ndarray, leaf: int):
    """A vantage-point tree of nested tuples (vantage, radius, inside, outside); leaves hold their points.

    The vantage point is the candidate with the widest spread of distances.
    """
    if len(points) <= leaf:
        return points
    tries = points[:: max(1, len(points) // 8)][:8]
    spread = [distance(points[:512], v).astype(float).var() for v in tries]
    vantage = tries[int(np.argmax(spread))]
    d = distance(points, vantage)
    radius = int(np.median(d))
    if (d <= radius).all():
        radius -= 1
    inside = d <= radius
    if not inside.any() or inside.all():
        return points
    return vantage, radius, grow(points[inside], leaf), grow(points[~inside], leaf)


def number_leaves(tree, start: int = 0):
    """The same tree with leaves numbered from left to right, and their count."""
    if not isinstance(tree, tuple):
        return start, start + 1
    vantage, radius, a, b = tree
    a, start = number_leaves(a, start)
    b, start = number_leaves(b, start)
    return (vantage, radius, a, b), start


def reach(tree, points: np.ndarray, at: np.ndarray, within: int, out: list) -> None:
    """Appends (leaf, indices) of the points whose ball of ``within`` may reach into the leaf."""
    if not len(at):
        return
    if not isinstance(tree, tuple):
        out.append((tree, at))
        return
    vantage, radius, inside, outside = tree
    d = distance(points[at], vantage).astype(np.int64)
    reach(inside, points, at[d - within <= radius], within, out)
    reach(outside, points, at[d + within > radius], within, out)


class Groups:
    """Connected groups of points as they are linked."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def labels(self) -> np.ndarray:
        return np.fromiter(map(self.find, range(len(self.parent))), dtype=np.int64, count=len(self.parent))

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def small_links(points: np.ndarray, bits: int):
    """Links that span the groups of a few points."""
    a, b = np.nonzero(np.triu(distance(points[:, None], points[None, :]) <= bits, 1))
    if len(a) > 1:
        groups = Groups(len(points))
        groups.link(a, b)
        b = groups.labels()
        a = np.flatnonzero(b != np.arange(len(points)))
        b = b[a]
    return points[a], points[b]


def leaf_pairs(points: np.ndarray, leaf: np.ndarray, queries: np.ndarray, bits: int):
    """(index in leaf, index in queries) of the pairs within ``bits``, a slice of the queries at a time."""
    for i in range(0, len(queries), 4096):
        a, b = np.nonzero(distance(points[leaf][:, None], queries[None, i:i + 4096]) <= bits)
        if len(a):
            yield leaf[a], b + i


class Shard:
    """The home fingerprints of one shard with a local tree over them."""

    def __init__(self, points: np.ndarray, bits: int):
        self.points, self.bits = points, bits
        order = {int(p): i for i, p in enumerate(points.tolist())}
        self.leaves: list[np.ndarray] = []

        def number(tree):
            if not isinstance(tree, tuple):
                self.leaves.append(np.array([order[int(p)] for p in tree.tolist()], dtype=np.int64))
                return len(self.leaves) - 1
            return tree[0], tree[1], number(tree[2]), number(tree[3])

        self.tree = number(grow(points, LEAF))
        groups = Groups(len(points))
        labels = np.arange(len(points))
        for a, b in self._found(points):
            la, lb = labels[a], labels[b]
            fresh = la != lb
            if fresh.any():
                pairs = np.unique(la[fresh] * len(points) + lb[fresh])
                groups.link(pairs // len(points), pairs % len(points))
                labels = groups.labels()
        self.labels = labels

    def _found(self, queries: np.ndarray):
        hits: list = []
        reach(self.tree, queries, np.arange(len(queries)), self.bits, hits)
        for leaf, at in hits:
            for a, b in leaf_pairs(self.points, self.leaves[leaf], queries[at], self.bits):
                yield a, at[b]

    def own_links(self):
        at = np.flatnonzero(self.labels != np.arange(len(self.points)))
        return self.points[at], self.points[self.labels[at]]

    def links(self, queries: np.ndarray):
        """One link from each query to each local group that it reaches."""
        n = len(self.points)
        codes = [np.unique(b * n + self.labels[a]) for a, b in self._found(queries)]
        if not codes:
            return queries[:0], queries[:0]
        codes = np.unique(np.concatenate(codes))
        return queries[codes // n], self.points[codes % n]


def masks(bits: int, agree: int) -> list[int]:
    """Signed masks of ``agree`` out of ``bits + agree`` pieces of the 64 bits, one for each choice of pieces.

    Fingerprints within ``bits`` bits differ in at most ``bits`` pieces, so they agree under some mask.
    """
    n = min(64, bits + agree)
    edges = [64 * i // n for i in range(n + 1)]
    pieces = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(pieces, max(0, n - bits))]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def pieces_for(n: int, bits: int, shard_points: int) -> list[int]:
    """The fewest masks under which ``n`` evenly spread fingerprints fall into groups of ``shard_points`` at most."""
    for agree in (1, 2, 3):
        if n <= shard_points << (64 * agree // (bits + agree)):
            break
    return masks(bits, agree)


def trees_of(hot: DataFrame, points: int) -> dict:
    """A numbered vantage-point tree for each crowded group, grown on a share of its fingerprints.

    Leaves are aimed at ``points`` fingerprints and sampled by about SAMPLES of them.
    """
    rate = max(1, points // SAMPLES)

    def build(part: pd.DataFrame) -> pd.DataFrame:
        sample = np.unique(part.fp.to_numpy(np.int64).view(np.uint64))
        tree, _ = number_leaves(grow(sample, SAMPLES))
        return pd.DataFrame({"group": part.group[:1], "tree": [pickle.dumps(tree)]})

    sample = hot.where(F.pmod(F.xxhash64("fp", F.lit(rate)), F.lit(rate)) == 0)
    return {r.group: pickle.loads(r.tree)
            for r in sample.groupBy("group").applyInPandas(build, "group long, tree binary").collect()}


def split_by_trees(hot: DataFrame, trees: dict, bits: int) -> DataFrame:
    """(group, shard, visitor, fp): each fingerprint at home in a leaf of its group's tree, and a visitor in every later
    leaf that its ball of ``bits`` may reach."""
    shared = hot.sparkSession.sparkContext.broadcast(trees)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for group, part in b.groupby("group"):
                tree = shared.value.get(group, 0)
                points = part.fp.to_numpy(np.int64).view(np.uint64)
                at = np.arange(len(points))
                homes: list = []
                reach(tree, points, at, 0, homes)
                home = np.empty(len(points), dtype=np.int64)
                for shard, i in homes:
                    home[i] = shard
                visits: list = []
                reach(tree, points, at, bits, visits)
                for shard, i in visits:
                    i = i[home[i] <= shard]
                    yield pd.DataFrame({"group": group, "shard": shard, "visitor": home[i] != shard,
                                        "fp": points[i].view(np.int64)})

    return hot.mapInPandas(deal, "group long, shard long, visitor boolean, fp long")


def linked(distinct: DataFrame, bits: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(a, b): links between distinct fingerprints that span all groups within ``bits``."""
    spark = distinct.sparkSession
    chosen = pieces_for(distinct.count(), bits, shard_points)
    group = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(chosen)]))
    dealt = distinct.select(group.alias("group"), "fp")
    hot = written(dealt.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_points),
                  "crowded-groups")
    crowded = hot.agg(F.sum("n")).first()[0]
    plain = dealt if crowded is None else dealt.join(hot, "group", "left_anti")
    dealt_out = plain.select("group", F.lit(0).cast("long").alias("shard"), F.lit(False).alias("visitor"), "fp")
    if crowded is not None:
        rows = written(dealt.join(hot, "group", "left_semi"), "crowded-fingerprints")
        # All trees together have at most about MOST_LEAVES leaves, which bounds what is broadcast.
        trees = trees_of(rows, max(shard_points, crowded // MOST_LEAVES))
        dealt_out = dealt_out.unionByName(split_by_trees(rows, trees, bits))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, homes, shard, out = None, [], None, []

        def finish():
            if shard is None and homes:
                points = np.concatenate(homes)
                out.append(small_links(points, bits) if len(points) <= LEAF else Shard(points, bits).own_links())

        def rows():
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
            out.clear()
            return pd.DataFrame({"a": a, "b": b})

        for b in batches:
            g, s, visitor = b.group.to_numpy(), b.shard.to_numpy(), b.visitor.to_numpy(bool)
            points = b.fp.to_numpy(np.int64).view(np.uint64)
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (visitor[1:] != visitor[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(g)]):
                if (g[lo], s[lo]) != key:
                    finish()
                    key, homes, shard = (g[lo], s[lo]), [], None
                if not visitor[lo]:
                    homes.append(points[lo:hi])
                elif homes:  # homes come first: all of them are here
                    if shard is None:
                        shard = Shard(np.concatenate(homes), bits)
                        out.append(shard.own_links())
                    out.append(shard.links(points[lo:hi]))
            if out:
                yield rows()
        finish()
        if out:
            yield rows()

    met = dealt_out.repartition(partitions(spark), "group", "shard").sortWithinPartitions("group", "shard", "visitor")
    return met.mapInPandas(meet, "a long, b long").where("a <> b")


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    fps = written(fingerprints(docs, shingle, id_col, text), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    links = written(linked(distinct, bits), "fingerprint-links")
    roots = components(links)
    grouped = distinct.join(roots, distinct.fp == roots.node, "left") \
        .select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    grouped = written(grouped, "fingerprint-groups")
    smallest = written(grouped.groupBy("root").agg(F.min("first_doc").alias("component_id")), "fingerprint-smallest")
    named = written(grouped.join(smallest, "root").select("fp", "component_id"), "fingerprint-components")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
