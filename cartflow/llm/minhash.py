"""Near-duplicates by MinHash bands and odd sketches, confirmed on full sets.

A document is the set of its distinct word shingles.  Equal sets become one
node.  All MinHash samples of a node are folded into an odd sketch, a bitmap
in which every (sample number, value) flips one bit: two nodes' sketches
differ in few bits if few samples differ, whatever the size of the sets.

Nodes that agree on a band of samples share a bucket.  First every node of a
bucket meets only the bucket's hub, the node that shares most buckets with
others, and the confirmed links make groups.  Then buckets that still hold
several groups are searched for links between their groups, in blocks of
nodes: by the sketches, then on the full sets of the nodes that have partners.
Within a group nothing needs another comparison, so copies are never expanded
into all pairs, no row is made for a pair that fails, and no bucket is cut
short.

With 64 bands of 6 samples a link at the least similarity of 0.8 shares no
band with a chance of 4e-9, and its sketches are further apart than allowed
with a chance of ``MISS``; links above it fare better.

Texts without words have the empty set and are linked with nothing, not even
with each other; null ids are never the smallest of a group with another id;
repeated ids may lie in several groups, as rows are told apart by their sets;
an empty table gives no rows.  Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, partitions, written

BANDS, ROWS = 64, 6
SKETCH_BITS = 512
MISS = 1e-9
PART = 512       # shingles hashed together
BLOCK = 1024     # nodes of a bucket in a block
SEED = 20_14


def shingles_of(text: str | None, shingle: int) -> set:
    """The distinct shingles of a text's words, A-Z lower-cased; a shorter text is one shingle."""
    w = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if len(w) < shingle:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(shingle))))


class Hasher:
    """MinHash samples of sets of numbers, and their odd sketch."""

    def __init__(self, bands: int, rows: int, sketch_bits: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows, self.bits = bands, rows, sketch_bits
        k = bands * rows
        odd = lambda n, kind: rng.integers(0, np.iinfo(kind).max, n, dtype=kind) | kind(1)
        self.factor, self.salt = odd(k, np.uint32), odd(k, np.uint32)
        self.spread, self.step, self.start = odd(k, np.uint64), odd(rows, np.uint64), odd(k, np.uint64)

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        """The least of each sample's own permutation of the numbers (32 bits, which vector units multiply fast)."""
        hashes = hashes.astype(np.uint32)
        low = np.full(len(self.factor), np.iinfo(np.uint32).max, dtype=np.uint32)
        held = np.empty((min(PART, len(hashes)), len(low)), dtype=np.uint32)
        for i in range(0, len(hashes), PART):
            part = hashes[i:i + PART, None]
            mixed = held[:len(part)]
            np.bitwise_xor(part, self.salt, out=mixed)
            np.multiply(mixed, self.factor, out=mixed)
            np.minimum(low, mixed.min(axis=0), out=low)
        return low

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        """One number for each band; the band's own salt tells bands apart."""
        shape = (self.bands, self.rows)
        mixed = (samples.astype(np.uint64).reshape(shape) + self.start.reshape(shape)) * self.step
        mixed ^= mixed >> np.uint64(29)
        total = np.zeros(self.bands, dtype=np.uint64)
        for column in mixed.T:
            total = (total ^ column) * np.uint64(0x9FB21C651E98DF25)
            total ^= total >> np.uint64(32)
        return total.view(np.int64)

    def sketch(self, samples: np.ndarray) -> np.ndarray:
        place = (samples.astype(np.uint64) + self.start) * self.spread
        place = (place >> np.uint64(40)).astype(np.int64) % self.bits
        odd = np.bincount(place, minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_different(samples: int, bits: int, percent: int, miss: float = MISS) -> int:
    """The sketch distance that a pair of at least ``percent`` similarity passes with a chance of ``miss`` at most.

    Each differing sample throws two values at the bitmap; a bit differs after an odd number of throws.
    """
    p = 1 - percent / 100
    state = np.zeros(bits + 1)
    state[0] = 1.0
    chance = np.zeros(bits + 1)
    at = np.arange(bits + 1)
    for d in range(samples + 1):
        chance += comb(samples, d) * p ** d * (1 - p) ** (samples - d) * state
        for _ in range(2):
            up = state * (bits - at) / bits
            down = state * at / bits
            state = np.zeros(bits + 1)
            state[1:] += up[:-1]
            state[:-1] += down[1:]
    tail = np.cumsum(chance[::-1])[::-1]   # chance of this distance or more
    return int(np.flatnonzero(tail <= miss)[0]) - 1 if (tail <= miss).any() else bits


def signatures(docs: DataFrame, shingle: int, hasher: Hasher, id_col: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, key, bands, sketch, text); key, 16 bytes, stands for the set and is null for the empty one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        word_hash: dict[bytes, int] = {}
        base = np.uint64(0x9E3779B97F4A7C15)
        for b in batches:
            out = []
            for text in b.text:
                words = (text or "").encode().lower().split()
                n = len(shingles_of(text, shingle))
                if not n:
                    out.append((0, None, None, None))
                    continue
                if len(word_hash) > 200_000:
                    word_hash.clear()
                for w in words:
                    if w not in word_hash:
                        word_hash[w] = xxhash.xxh3_64_intdigest(w)
                h = np.fromiter(map(word_hash.__getitem__, words), dtype=np.uint64, count=len(words))
                size = min(shingle, len(h))
                mixed = np.full(len(h) - size + 1, size, dtype=np.uint64)
                for i in range(size):
                    mixed = (mixed ^ h[i:len(h) - size + 1 + i]) * base
                    mixed ^= mixed >> np.uint64(32)
                mixed = np.unique(mixed)
                samples = hasher.samples(mixed)
                key = xxhash.xxh3_128_digest(np.uint64(n).tobytes() + mixed.tobytes())
                out.append((n, key, hasher.band_keys(samples), hasher.sketch(samples)))
            n, key, bands, sketch = zip(*out) if out else ((), (), (), ())
            yield pd.DataFrame({"doc_id": b.doc_id, "n_shingles": n, "key": key, "bands": bands, "sketch": sketch,
                                "text": b.text})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_shingles long, key binary, bands array<long>, sketch array<long>, "
                                 "text string")


def distance(a, b, words: int):
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, words)), F.bit_count(a[0].bitwiseXOR(b[0])))


def confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int, limit: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow the similarity and whose full sets have it."""
    words = SKETCH_BITS // 64
    sides = [nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
             for s in "ab"]
    near = pairs.join(sides[0], "a").join(sides[1], "b") \
        .where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
               & (distance(F.col("sa"), F.col("sb"), words) <= limit)).select("a", "b")
    near = written(near, "minhash-near")
    needed = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    texts = written(texts.join(written(needed, "minhash-needed"), "node"), "minhash-texts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hub, hub_set = None, set()
        for b in batches:
            keep = []
            for node, ta, tb in zip(b.b, b.ta, b.tb):
                if node != hub:
                    hub, hub_set = node, shingles_of(tb, shingle)
                own = shingles_of(ta, shingle)
                both = len(own & hub_set)
                keep.append(100 * both >= percent * (len(own) + len(hub_set) - both))
            yield b.loc[np.array(keep, dtype=bool), ["a", "b"]]

    full = near.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a") \
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    return written(full.mapInPandas(run, "a long, b long"), "minhash-links")


def buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, members) of the buckets with two nodes or more."""
    rows = nodes.select(F.explode("bands").alias("bucket"), "node")
    sizes = written(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"),
                    "minhash-buckets")
    return written(rows.join(sizes, "bucket"), "minhash-shared")


def hub_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each node with the hub of each of its buckets, once."""
    popular = written(shared.groupBy("node").agg(F.sum("members").alias("popularity")), "minhash-popular")
    hubs = shared.join(popular, "node").groupBy("bucket").agg(
        F.max(F.struct("popularity", "node")).getField("node").alias("b"))
    met = shared.join(written(hubs, "minhash-hubs"), "bucket").where("node <> b")
    return written(met.select(F.col("node").alias("a"), "b").distinct(), "minhash-pairs")


def passing(n: np.ndarray, sketch: np.ndarray, root: np.ndarray, own: np.ndarray, percent: int, limit: int):
    """(index, indices) of the rows of other groups that sizes and sketches let a row be linked with.

    Rows are sorted by root.  In a task of two blocks only rows of different blocks meet.
    """
    two = own.min() != own.max()
    for x in range(len(n)):
        first = int(np.searchsorted(root, root[x], side="right"))
        near = 100 * np.minimum(n[x], n[first:]) >= percent * np.maximum(n[x], n[first:])
        if two:
            near &= own[first:] != own[x]
        at = np.flatnonzero(near) + first
        if len(at):
            at = at[np.bitwise_count(sketch[at] ^ sketch[x]).sum(axis=1) <= limit]
            if len(at):
                yield x, at


def by_task(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, list]]:
    """((bucket, i, j), rows) of frames sorted by these three first columns."""
    current, part = None, []
    for b in batches:
        for bucket, i, j, *row in b.itertuples(index=False, name=None):
            if (bucket, i, j) != current:
                if part:
                    yield current, part
                current, part = (bucket, i, j), []
            part.append(row)
    if part:
        yield current, part


def arrays(part: list, width: int) -> list[np.ndarray]:
    """The first columns of the rows as arrays of whole numbers, sorted by root (the second) and node (the first)."""
    columns = [np.array(c, dtype=np.int64) for c in list(zip(*part))[:width]]
    order = np.lexsort((columns[0], columns[1]))
    return [c[order] for c in columns] + [order]


def mixed_buckets(shared: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(bucket, i, j, node, root, own): nodes of the buckets that hold several groups, dealt to pairs of blocks.

    A large bucket is cut by the nodes' hashes, so that no task holds more than two blocks.
    """
    own = written(shared.join(groups, "node", "left")
                  .select("bucket", "node", "members", F.coalesce("root", "node").alias("root")), "minhash-grouped")
    mixed = written(own.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
                    .select("bucket"), "minhash-mixed")
    rows = own.join(mixed, "bucket").withColumn("k", F.ceil(F.col("members") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return rows.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node",
                       "root", "own")


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")


def links_between(mixed: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int,
                  limit: int) -> DataFrame:
    """(a, b): links between nodes of different groups in a bucket, as many as join all groups that are linked.

    The sketches first tell which nodes have any partner in their task; only those come back with their texts,
    and a pair is compared in the first bucket that it shares.
    """
    sketches = nodes.select("node", "n_shingles", "sketch")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (bucket, i, j), part in by_task(batches):
            if len(part) < 2:
                continue
            node, root, own, n, order = arrays(part, 4)
            sketch = np.array([part[o][4] for o in order], dtype=np.int64).view(np.uint64)
            found = np.zeros(len(node), dtype=bool)
            for x, at in passing(n, sketch, root, own, percent, limit):
                found[x] = True
                found[at] = True
            if found.any():
                yield pd.DataFrame({"bucket": bucket, "i": i, "j": j, "node": node[found], "root": root[found],
                                    "own": own[found]})

    met = dealt(mixed.join(sketches, "node").select("bucket", "i", "j", "node", "root", "own", "n_shingles", "sketch"))
    found = written(met.mapInPandas(search, "bucket long, i int, j int, node long, root long, own int"), "minhash-found")
    needed = written(found.select("node").distinct(), "minhash-needed")
    full = written(nodes.select("node", "n_shingles", "sketch", "bands").join(needed, "node").join(texts, "node"),
                   "minhash-texts")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (bucket, i, j), part in by_task(batches):
            node, root, own, n, order = arrays(part, 4)
            sketch = np.array([part[o][4] for o in order], dtype=np.int64).view(np.uint64)
            bands = np.array([part[o][5] for o in order], dtype=np.int64)
            sets: dict[int, set] = {}
            joined: dict[int, int] = {}

            def set_of(x):
                if x not in sets:
                    sets[x] = shingles_of(part[order[x]][6], shingle)
                return sets[x]

            def find(r):
                while joined.get(r, r) != r:
                    r = joined[r]
                return r
            out = []
            for x, at in passing(n, sketch, root, own, percent, limit):
                same = bands[at] == bands[x]
                at = at[bands[x][same.argmax(axis=1)] == bucket]  # else an earlier bucket compares them
                for y in at.tolist():
                    rx, ry = find(int(root[x])), find(int(root[y]))
                    if rx != ry:
                        both = len(set_of(x) & set_of(y))
                        if 100 * both >= percent * (len(set_of(x)) + len(set_of(y)) - both):
                            joined[rx] = ry
                            out.append((node[x], node[y]))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    met = dealt(found.join(full, "node").select("bucket", "i", "j", "node", "root", "own", "n_shingles", "sketch", "bands",
                                                "text"))
    return written(met.mapInPandas(compare, "a long, b long"), "minhash-links")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    hasher = Hasher(bands, rows, SKETCH_BITS)
    limit = most_different(bands * rows, SKETCH_BITS, percent)
    marked = written(signatures(docs, shingle, hasher, id_col, text).withColumn("row", F.monotonically_increasing_id()),
                     "minhash-signatures")
    nodes = written(marked.where("key is not null").groupBy("key").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first_doc"), F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "minhash-nodes")
    texts = marked.select(F.col("row").alias("node"), "text")
    shared = buckets(nodes)
    tested = hub_pairs(shared)
    links = confirmed(tested, nodes, texts, shingle, percent, limit)
    groups = written(components(links), "minhash-groups")
    more = links_between(mixed_buckets(shared, groups), nodes, texts, shingle, percent, limit)
    if not more.isEmpty():
        # Of the links that made the groups, one from each node to its root is enough.
        groups = written(components(more.unionByName(groups.select(F.col("node").alias("a"), F.col("root").alias("b")))),
                         "minhash-groups")
    grouped = written(nodes.select("key", "node", "first_doc").join(groups, "node", "left")
                      .select("key", "first_doc", F.coalesce("root", "node").alias("root")), "minhash-grouped")
    smallest = written(grouped.groupBy("root").agg(F.min("first_doc").alias("component_id")), "minhash-smallest")
    named = written(grouped.join(smallest, "root").select("key", "component_id"), "minhash-components")
    found = marked.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))
