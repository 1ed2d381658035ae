"""The corpus pipeline: every stage against a brute-force decision on its own input."""

import os
import sys

import public_tokenizers as P
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C  # noqa: E402
from test_operators import brute_contaminated, plain_fingerprint  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(C.written(stage(spark, out[-1], SMALL), "test-stage"))
    return out


def test_columns(stages):
    assert all(s.columns == C.COLUMNS for s in stages[:-1])
    assert "doc_id" in stages[-1].columns


def test_language_and_quality_keep_clean_documents(spark, stages):
    start, lang, good = ({r.doc_id for r in s.collect()} for s in stages[:3])
    assert lang == {r.doc_id for r in stages[0].collect() if any(c.isalpha() for c in r.text)} <= start
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if r.doc_id in lang}
    wrong = [d for d, q in labels.items() if (d in good) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)


def test_one_document_of_each_group_stays(stages):
    before, after = ({r.doc_id: plain_fingerprint(r.text) for r in s.collect()} for s in stages[2:4])
    ids = sorted(before)
    root = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (before[i] ^ before[j]).bit_count() <= 4 and root[i] < root[j]:
                    root[j] = root[i]
                    changed = True
    assert set(after) == set(root.values())


def test_decontamination(spark, stages):
    before = [(r.doc_id, r.text) for r in stages[3].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    # Brute force over documents that share a 20-character piece with an item; others cannot cover a window.
    from cartflow.llm.decontam import normalise
    pieces = {n[k:k + 8] for _, t in items for n in [normalise(t)] for k in range(len(n) - 7)}
    near = [(d, t) for d, t in before
            if sum(normalise(t)[k:k + 8] in pieces for k in range(0, len(t), 8)) > 6 and len(t) < 3000]
    held = {d for d, _ in brute_contaminated(near[:10], items)}
    after = {r.doc_id for r in stages[4].collect()}
    assert not held & after and {d for d, _ in near[:10]} - held <= after


def test_token_digests_and_run(spark, stages):
    got = {r.doc_id: r for r in stages[5].collect()}
    assert set(got) == {r.doc_id for r in stages[4].collect()}
    assert sorted(map(tuple, C.run(spark, SMALL).collect())) == sorted(map(tuple, got.values()))


def test_edge_documents(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "12 34", None, "a", 5),
            (4, "plain words of a document", "en", "b", 25), (4, "plain words of a document", "en", "b", 25),
            (None, "a text without an id", "en", "b", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SMALL), "edge-stage")
        if name == "simhash near-dedup":
            assert sorted(r.doc_id for r in docs.collect() if r.doc_id) in ([4], [])
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    """Verdicts are of rows: a bad row takes no other row of its id along."""
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r.text for r in C.quality(spark, given, SMALL).collect()}
    bad = sorted({r.text for r in given.collect()} - good)
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    some = sorted(t for t in good if len(t) > 200)[:8]

    def rows(texts):
        return spark.createDataFrame([((None, 2**60 + 1)[i % 2], t, "en", "a", i) for i, t in enumerate(texts)], schema)

    def texts(df):
        return sorted(r.text for r in df.collect())
    assert texts(C.language_id(spark, given.unionByName(rows([*some, "12 34", "5 6"])), SMALL).where("source = 'a' AND "
                 "(doc_id IS NULL OR doc_id > 1000000000)")) == some
    mixed = given.unionByName(rows([*some, *bad[:2]]))
    own = "n_chars < 10 AND (doc_id IS NULL OR doc_id = 1152921504606846977)"
    got = C.quality(spark, mixed, SMALL).where(own)
    assert texts(got) == some and len(bad) >= 2
    singles = texts(C.near_duplicates(spark, rows([*some, *some]), SMALL))
    assert singles == texts(C.near_duplicates(spark, spark.createDataFrame(
        [(i, t, "en", "a", i) for i, t in enumerate(some)], schema), SMALL)) and len(singles) > 2
    clean = texts(C.decontaminate(spark, rows(some), SMALL))
    with_item = rows([*some, "xx " + item, item])
    left = C.decontaminate(spark, with_item, SMALL).collect()
    assert sorted(r.text for r in left) == clean and len(clean) > 2
    assert {r.doc_id for r in left} == {None, 2**60 + 1}
