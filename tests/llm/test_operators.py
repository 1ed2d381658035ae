"""Operators of the training-data subpackage against brute force, round trips and held-out labels."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from cartflow.llm import (bpe, class_lm, decontam, langid, licenses, line_crf, quality_rules, rans, simhash,  # noqa: E402
                          url_filter)
from cartflow.llm.common import id_remainder_py  # noqa: E402
from cartflow.llm.queries import ORACLE, QUERIES  # noqa: E402
from oracle_compare import duck, rows_of  # noqa: E402

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word%d " * 3000 % tuple(range(3000))
EDGE = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "12 34 !!", None, "a", 8),
        (5, "one two three one two three", "en", "b", 27), (5, "one two three one two three", "en", "b", 27),
        (None, "no id here", "de", None, 10), (7, LONG, "en", "b", len(LONG)), (8, "x" * 20000, "fr", "b", 20000),
        (9, "é日本   語 text", "fr", "c", 9)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    return spark.createDataFrame(EDGE, SCHEMA).select(
        "*", *[F.lit("own").alias(c) for c in ("fp", "ids", "host", "score", "n_words", "held_out", "label", "id", "nth",
                                               "component_id", "canon", "block", "listed", "file")])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(spark, name):
    got = rows_of(QUERIES[name](spark, SMALL).toPandas())
    assert got == rows_of(duck(SMALL).execute(ORACLE[name]).df())


# 1. Quality rules

def test_rule_counts_of_edge_rows(edge):
    got = quality_rules.judge(edge).collect()
    assert len(got) == len(EDGE)
    by = {(r.doc_id): r for r in got}
    assert by[1].n_words == 0 and by[1].base_failed and by[3].n_words == 0
    assert by[5].n_repeat_words == 6 and by[5].n_words == 6
    assert by[7].n_words == 3000 and not by[7].base_failed and by[7].n_repeat_words == 0


def test_bad_host_takes_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 10 == 0 else "short", "en", "bad", 0) for i in range(100)]
    rows += [(1000 + i, good, "en", f"h{i % 7}", 0) for i in range(100)]
    rows += [(2000 + i, "short", "en", f"h{i % 7}", 0) for i in range(9)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[0].host_failed and not got[0].kept and not got[0].base_failed
    assert all(got[1000 + i].kept for i in range(100))


def test_rules_of_no_documents(none):
    assert quality_rules.judge(none).count() == 0


# 2. Class language model

def test_class_lm_base_scores(spark, docs, texts):
    got = {r.doc_id: r for r in class_lm.score_documents(docs, min_count=3, classes=8).collect()}
    count, n = Counter(), 0
    for d, t in texts.items():
        if id_remainder_py(d, 10) != 0:
            count.update(words(low(t)))
            n += 1
    total, v = sum(count.values()) + n, len(count) + 1
    for d, t in texts.items():
        w = words(low(t))
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (v + 1))) for c in [count[x] for x in w] + [n])
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(count[x] > 0 for x in w) + 1, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (id_remainder_py(d, 10) == 0)


def test_class_lm_beats_unigrams_on_held_out(docs):
    held = class_lm.score_documents(docs, min_count=5, classes=8).where("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_class_model_sums_to_one():
    rng = np.random.default_rng(0)
    classes, counts, cls = 4, np.array([50, 30, 40, 25, 3, 1, 0]), np.array([0, 1, 2, 3, 4, 4, 4])
    distinct, tokens = np.array([1, 1, 1, 1, 2]), np.array([50, 30, 40, 25, 4])
    moves = rng.integers(0, 30, (classes + 2, classes + 2))
    m = class_lm.Model(moves, distinct, tokens, 12)
    word = 10 ** m.emission(counts, cls)  # the last is the unknown word
    for a in range(classes + 2):
        p = 10 ** m.move[a]
        assert p[cls] @ word + p[-1] == pytest.approx(1.0)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(1)
    # Two kinds of words that follow each other in turn.
    kind = rng.integers(0, 2, 60)
    bigrams = np.where(kind[:, None] != kind[None, :], rng.integers(5, 20, (60, 60)), 0)
    cls = rng.integers(0, 2, 60)

    def moves(c):
        return np.array([[bigrams[np.ix_(c == a, c == b)].sum() for b in range(2)] for a in range(2)])

    start = class_lm.likelihood(moves(cls))
    for _ in range(6):
        after = np.array([[bigrams[i][cls == c].sum() for c in range(2)] for i in range(60)])
        before = np.array([[bigrams[:, i][cls == c].sum() for c in range(2)] for i in range(60)])
        cls = class_lm.exchange(after, before, cls, moves(cls), 2)
    assert class_lm.likelihood(moves(cls)) > start
    assert (cls == kind).all() or (cls != kind).all()


def test_class_lm_edges(edge, none):
    got = class_lm.score_documents(edge).collect()
    assert len(got) == len(EDGE)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert class_lm.score_documents(none).count() == 0


# 3. URL filter

def test_urls(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Spam-Farm.Example.NET/a/?utm_x=1#f", "https://a.example.org/es/1",
            "https://x.org", "http://x.org/a", "http://example.org/en/12", "http://y.com/de/", "http://z.net/p?b=2&a=1"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("https://spam-farm.example.net/a",), ("http://z.net/p/?a=1&b=2&ref=q",), (None,)],
                                   "url string")
    for limit in (8 << 20, 0):
        got = {r.page_id: r for r in url_filter.judge_urls(pages, listed, url_filter.PAGE_RULES,
                                                           broadcast_bytes=limit).collect()}
        assert [got[i].verdict for i in range(10)] == ["allow"] * 3 + ["block", "block", "allow", "allow", "block",
                                                                     "block", "block"]
        assert [got[i].rule for i in range(3, 9)] == [None, "example.org/es/", None, "org/", "example.org/en/1",
                                                      "com/de/"]
        assert got[3].host == "www.spam-farm.example.net" and got[3].path == "/a/" and got[0].host == ""
    assert url_filter.judge_urls(pages.limit(0), listed, []).count() == 0
    assert url_filter.judge_urls(pages, listed.limit(0), []).where("listed").count() == 0


# 4. Token files

def test_token_files(docs, texts):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in rans.encode_and_read(docs, path).collect()}
    start = 0
    for d in sorted(texts):
        ids = np.array(t.encode(texts[d], add_special_tokens=False).ids + [0], dtype="<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_file_edges(edge, none):
    got = rans.encode_and_read(edge, P.path("byte_bpe_50k.json")).collect()
    assert len(got) == len(EDGE) and sorted(r.n_tokens for r in got)[:2] == [1, 1]
    assert [r.start for r in got if r.doc_id is None] == [0]
    assert rans.encode_and_read(none, P.path("byte_bpe_50k.json")).count() == 0


def test_pieces_equal_whole_texts():
    enc = rans.PieceEncoder(P.path("byte_bpe_50k.json"))
    odd = ["", "\n", " a", "a ", "a  b", "a\n\nb", " \n x\t y", "x\0 y", "foo\n", "\nfoo", "it's  he'll don't\n it 's",
           "é  x", "<|endoftext|> a", "a  b c d"]
    assert enc.encode(odd) == enc._ids(odd)


def test_cuts_of_odd_characters_change_no_ids():
    enc = rans.PieceEncoder(P.path("byte_bpe_50k.json"))
    parts = [*"aZ09 \n\t\r\x0b\x0c\x1c\x1f\0\x7f'.,!-_", *"\xe9\xdf\xd7\xf7\xaa\xba\xb2\x85\xa0",
             *"\u1680\u180e\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\u3002\u201c\u2026",
             *"\u0436\u4e2d\u304b\u024f\u0250\u02b0\u0301\u0661\ufeff",
             "\U0001f600", "'s", "'ll", "  ", "\n\n", " \n", "\n ", "<|endoftext|>", " the"]
    rng = np.random.default_rng(4)
    odd = ["".join(parts[k] for k in rng.integers(0, len(parts), n)) for n in rng.integers(0, 12, 20_000)]
    assert enc.encode(odd) == enc._ids(odd)


def test_each_piece_is_encoded_once(monkeypatch):
    monkeypatch.setattr(rans, "CACHE", 8)
    enc = rans.PieceEncoder(P.path("byte_bpe_50k.json"))
    by_library, seen = enc._ids, []

    def ids(texts):
        seen.extend(p for t in texts for p in t.split("\n"))
        return by_library(texts)
    monkeypatch.setattr(enc, "_ids", ids)
    for k in range(20):
        texts = [f"the x{k}a,  the x{k}b! the x{k}a; the", "the, "]
        assert enc.encode(texts) == by_library(texts)
    assert len(seen) == len(set(seen)) and {"the", " the", "  the", ","} <= set(seen)


def test_texts_are_batched_by_characters():
    assert list(rans.batches_of(["aa", "", "aaa", "a" * 9, "a", ""], 5)) == [(0, 3), (3, 4), (4, 6)]
    assert list(rans.batches_of([])) == [] and list(rans.batches_of([""])) == [(0, 1)]


def test_coder_round_trip_and_part_decoding():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.geometric(0.01, 700_000), 3000).astype(np.uint32) * 70_001
    known, n = np.unique(ids, return_counts=True)
    slots = rans.scale(known, n.astype(float))
    assert slots.sum() == rans.SLOTS and slots.min() >= 1
    coder = rans.Coder(known, slots)
    for size in (1, 5, rans.LANES, rans.LANES + 1, 700_000):
        payload, heads = coder.encode(ids[:size])
        assert (coder.decode(payload, heads, size) == ids[:size]).all()
    part, head = rans.LANES * rans.STEPS, 8 * (rans.LANES + 1)
    assert (coder.decode_part(payload, heads[2 * head:3 * head], 700_000 - 2 * part) == ids[2 * part:]).all()


def test_damaged_payload_is_noticed(spark, docs):
    from cartflow.llm.common import new_path
    path = new_path(spark, "rans-test")
    rans.write_ids(rans.tokenize(docs.limit(20), P.path("byte_bpe_50k.json")), path)
    bad = new_path(spark, "rans-bad")
    spark.read.parquet(f"{path}/frequencies").write.parquet(f"{bad}/frequencies")
    spark.read.parquet(f"{path}/blocks").withColumn("payload_crc", F.lit(1).cast("long")).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="damaged payload"):
        rans.read_ids(spark, bad).count()


# 5. SimHash

def plain_fingerprint(text, k=4):
    import xxhash
    w = words(low(text))
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(docs, texts):
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    root = {d: d for d in fps}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(fps)
    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {
        d: (f"{fps[d]:016x}", find(d)) for d in ids}


def test_links_across_shards(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64))
             for k in rng.integers(1, 7, 600)]
    chain = [base[0]]
    for i in range(40):  # a chain of links, longer than any one ball
        chain.append(chain[-1] ^ np.uint64(0b1111) << np.uint64(i))
    points = np.unique(np.concatenate([base, base[:600] ^ np.array(flips), np.array(chain)]))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    links = simhash.linked(frame, 4, shard_points=100)
    got = {r.node: r.root for r in simhash.components(links).collect()}
    close = np.bitwise_count(points[:, None] ^ points[None]) <= 4
    groups = simhash.Groups(len(points))
    groups.link(*np.nonzero(close))
    want, signed = defaultdict(set), points.view(np.int64)
    for p, g in zip(signed.tolist(), groups.labels().tolist()):
        want[g].add(p)
    mine = defaultdict(set)
    for p in signed.tolist():
        mine[got.get(p, p)].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))
    assert all(r == min(g) for r, g in mine.items())


def test_simhash_edges(edge, none):
    got = simhash.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    empty = [r for r in got if r.doc_id in (1, 2, 3)]
    assert {r.fingerprint for r in empty} == {"0" * 16} and {r.component_id for r in empty} == {1}
    assert simhash.near_duplicates(none).count() == 0


# 6. Quality field

def brute_marginals(x, w, m):
    e, n = x @ w, len(x)
    total, good = 0.0, np.zeros(n)
    for code in range(2 ** n):
        s = [(code >> i) & 1 for i in range(n)]
        p = math.exp(sum(e[i] * s[i] for i in range(n)) + sum(m[s[i], s[i + 1]] for i in range(n - 1)))
        total += p
        good += p * np.array(s)
    return good / total


def test_marginals_by_enumeration():
    rng = np.random.default_rng(4)
    x, w, m = rng.normal(size=(7, 3)), rng.normal(size=3), rng.normal(size=(2, 2))
    assert line_crf.marginals(x, w, m) == pytest.approx(brute_marginals(x, w, m), rel=1e-9)


def test_quality_on_held_out():
    import duckdb
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    big = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op6_line_crf"](spark, big).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{big}/labels.parquet'").fetchall()
    held = [(got[d], q) for d, q in labels if got[d].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.95
    assert all(r.held_out == (id_remainder_py(d, 3) == 1) and 0 <= r.score <= 1 for d, r in got.items())


def test_quality_edges(spark, edge, none):
    labels = spark.createDataFrame([(7, 1, 0), (5, 0, 1), (8, None, 0), (None, 1, 1), (2, 0, 0), (5, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = line_crf.classify(edge, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    flat = line_crf.classify(edge, labels.limit(0)).collect()
    assert {r.score for r in flat} == {0.5}
    assert line_crf.classify(none, labels).count() == 0


# 7. Language

def test_words_sum_over_all_segmentations():
    table = {"▁": (0.1, 0.2), "▁a": (0.05, 0.01), "a": (0.2, 0.3), "ab": (0.1, 0.1), "b": (0.1, 0.05),
             "ba": (0.02, 0.2), "": (1e-4, 1e-3)}
    scorer = langid.Scorer(["x", "y"], [0.0, 0.0], table)

    def total(w, c):
        if not w:
            return 1.0
        out = 0.0
        for j in range(1, len(w) + 1):
            p = table.get(w[:j]) or (table[""] if j == 1 else None)
            out += p[c] * total(w[j:], c) if p else 0.0
        return out
    for w in ("a", "abba", "bab", "zab"):
        want = [math.log(total("▁" + w, c)) for c in (0, 1)]
        assert scorer.word(w) == pytest.approx(want) and scorer.short_words([w])[0] == pytest.approx(want)
    assert scorer.word("ab" * 3000)[0] < -1000


def test_language_on_held_out(spark):
    big = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op7_langid"](spark, big).collect()}
    held = [(got[r.doc_id].lang_pred, r.lang) for r in spark.read.parquet(f"{big}/documents.parquet").collect()
            if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.98


def test_language_edges(edge, none):
    path = P.path("piece_bpe_32k.model")
    got = langid.identify(edge, path).collect()
    assert len(got) == len(EDGE)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 4)} == {"und"}
    assert all(r.lang_pred in ("en", "fr", "de") and 0 < r.score <= 1 for r in got if r.doc_id in (5, 7, 8, 9))
    assert langid.identify(none, path).count() == 0
    unlabelled = langid.identify(edge.withColumn("lang", F.lit(None).cast("string")), path).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_letters_beside_signs_count():
    assert langid.letter_words("5 km² ½x a1b_c") == ["km", "x", "a", "b", "c"]
    assert langid.letter_words("12 ² ½ _") == [] == langid.letter_words(None)


# 8. Decontamination

def edit_distance(pattern, region):
    """Fewest edits of the pattern anywhere in the region, by bit-parallel columns."""
    masks = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, score = full, 0, len(pattern)
    best = score
    for c in region:
        eq = masks.get(c, 0)
        d0 = ((((eq & up) + up) ^ up) | eq | down) & full
        h_up, h_down = down | (full & ~(d0 | up)), up & d0
        score += bool(h_up & top) - bool(h_down & top)
        h_up, h_down = h_up << 1 & full, h_down << 1 & full
        up, down = h_down | (full & ~(d0 | h_up)), h_up & d0
        best = min(best, score)
    return best


def test_brute_edit_distance():
    assert edit_distance("kitten", "xx sitting yy") == 2 and edit_distance("abc", "zabcz") == 0
    assert edit_distance("abcd", "") == 4


def brute_contaminated(texts, items):
    out = set()
    for d, t in texts:
        t = decontam.normalise(t)
        for i, p in items:
            p = decontam.normalise(p)
            if len(p) < decontam.SHORTEST:
                continue
            size = min(decontam.WINDOW, len(p))
            covered = set()
            for s in sorted({*range(0, len(p) - size + 1, decontam.STEP), len(p) - size}):
                if edit_distance(p[s:s + size], t) <= decontam.EDITS * size // decontam.WINDOW:
                    covered |= set(range(s, s + size))
            if len(covered) >= min(decontam.COVER, len(p)):
                out.add((d, i))
    return out


def test_decontamination_by_brute_force(spark):
    rng = np.random.default_rng(5)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()][:12]
    words_of = [w for _, t in items for w in t.split()]
    texts = []
    for n in range(60):
        _, t = items[n % 12]
        a = list(t)
        for _ in range(n // 4):  # more and more edits
            at = int(rng.integers(len(a)))
            a[at:at + 1] = [["x"], [], [a[at], "y"]][int(rng.integers(3))]
        part = "".join(a)[int(rng.integers(0, 30)):][:int(rng.integers(60, 400))]
        texts.append((n, " ".join(rng.choice(words_of, 12)) + "  " + part.upper() + "\n" + " ".join(rng.choice(words_of, 9))))
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in texts], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    want = brute_contaminated(texts, items)
    assert got == want and 10 < len(want) < 60


def test_decontamination_without_a_grid(spark):
    """Any window, run of 13 words or short item, wherever it begins; brute force shares no constant with the code."""
    rng = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def some(n, low=3, high=9):
        return " ".join("".join(rng.choice(letters, int(rng.integers(low, high)))) for _ in range(n))
    items = [(i, some(40)) for i in range(6)] + [(i, some(40, 1, 4)) for i in range(6, 9)] \
        + [(9, some(4, 7, 9)), (10, some(2, 5, 6)), (11, "qzx vk"), (12, some(15, 5, 7)[:90])]
    texts = []

    def doc(part, middle=True):
        texts.append((len(texts), some(5) + (" " if middle else "") + part + (" " if middle else "") + some(5)))
    for i in range(6):
        t = items[i][1]
        for at in range(1 + 6 * i, 70, 31):
            doc(t[at:at + 70], False)            # a window that meets no grid
            doc(t[at:at + 40], False)            # less than a window
            edited = list(t[at:at + 75])
            for x in rng.choice(len(edited), 3 + at % 5, replace=False):
                edited[x] = "0"
            doc("".join(edited), False)
    for i in range(6, 9):
        w = items[i][1].split()
        for at in range(0, 27, 13):
            doc(" ".join(w[at:at + 13]))         # 13 short words: less than a window
            doc(" ".join(w[at:at + 12]))
    for i in range(9, 13):
        t = items[i][1]
        doc(t)
        doc(t, False)
        doc(t[:len(t) // 2] + "0" + t[len(t) // 2 + 1:])

    def holds(p, t):
        size = min(64, len(p))
        edits = min(5 * size // 64, max(0, size // 8 - 1))
        w = p.split()
        runs = [" ".join(w[k:k + 13]) for k in range(len(w) - 12)] + ([p] if not edits else [])
        if any(f" {r} " in f" {t} " for r in runs):
            return True
        return edits > 0 and any(edit_distance(p[s:s + size], t) <= edits for s in range(len(p) - size + 1))
    want = {(d, i) for d, t in texts for i, p in items if holds(p, t)}
    got = decontam.contaminated(spark.createDataFrame(texts, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and {i for _, i in want} == set(range(13))
    assert {d for d, _ in want} < set(range(len(texts)))


def test_documents_side_by_side_keep_their_own_hits():
    rng = np.random.default_rng(3)
    item = " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(60))
    index = decontam.Index([(1, item)])
    cut = item.index(" ", 100)
    texts = [item[:cut], item[cut + 1:], "zz " + item[20:40], item[40:200]]
    alone = {t for t, text in enumerate(texts) if list(index.search([text]))}
    assert {t for t, *_ in index.search(texts)} == alone == {0, 1, 3}


def test_alignment_within_its_band():
    p = "the quick brown fox jumps over"
    assert decontam.aligned(p, "xx the quick brwn fox jumps over yy", 3, -5, 20)[0] == 1
    assert decontam.aligned(p, "nothing like it at all here, no", 3, -5, 20) is None


def test_benchmark_blocks_and_edges(spark, edge, none, monkeypatch):
    item = " ".join(f"item{i} text" for i in range(20))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "short"), (5, item + " longer")],
                                  "item_id long, text string")
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(20, "before " + item + " after"), (20, "before " + item + " after")], "doc_id long, text string"))
    want = [(20, 1), (20, 5)]
    for chars in (4_000_000, 100):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", chars)
        got = decontam.contaminated(docs, bench).select("doc_id", "item_id").distinct().collect()
        assert sorted(map(tuple, got)) == want
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0


# 9. Licenses

def brute_licenses(text):
    w = licenses.notice_words(text)
    out = set()
    for name, t in licenses.TEMPLATES.items():
        want = licenses.notice_words(t)
        s = set(zip(*(want[i:] for i in range(5))))
        for p in range(-len(want), len(w)):
            part = w[max(0, p):max(0, p + len(want))]
            if len(s & set(zip(*(part[i:] for i in range(5))))) >= 0.8 * len(s):
                out.add(name)
    return out


def test_licenses(spark, docs, texts):
    assert licenses.miss_probability() < 1e-6
    got = defaultdict(set)
    for r in licenses.scan_licenses(docs).collect():
        got[r.doc_id].add(r.license)
    assert dict(got) == {d: s for d, t in texts.items() if (s := brute_licenses(t))}


def test_changed_notices_and_edges(spark, edge, none):
    grant = licenses.TEMPLATES["MIT-grant"]
    rows = [(1, "a b " + grant.upper() + " c"), (2, grant.replace("software", "program")),
            (3, grant.replace("free", "x").replace("person", "y")), (4, "Released under the MIT License"), (5, grant[:70])]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in got} == {(i, n) for i, t in rows for n in brute_licenses(t)}
    assert (1, 2, 1.0) in {(r.doc_id, r.first_word, r.containment) for r in got} and any(r.doc_id == 2 for r in got)
    assert licenses.scan_licenses(edge).count() == 0 and licenses.scan_licenses(none).count() == 0


# 10. Byte-level BPE

def test_byte_bpe(docs, texts):
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = {r.doc_id: r for r in bpe.digests(bpe.encode_documents(docs, path, P.PATTERN)).collect()}
    for d, t in texts.items():
        ids = np.array(enc.encode_ordinary(t), dtype="<u4")
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_byte_bpe_edges(edge, none):
    path = P.path("byte_bpe_50k.tiktoken")
    rows = bpe.encode_documents(edge, path, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in rows) == sorted(
        (r[0] or 0, r[1] or "") for r in EDGE)
    assert bpe.encode_documents(none, path, P.PATTERN).count() == 0
