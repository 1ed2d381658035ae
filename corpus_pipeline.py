"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it again as the next
stage's documents.  All stages but the last return the columns of
``documents``; the last adds the token ids' and decoded bytes' digests to each
kept document.

Null and empty texts have no language and go in the first stage; null and
repeated ids are kept apart by row; repeated rows are near-duplicates of each
other; columns beside those of ``documents`` are dropped, so their names do
not matter; an empty table stays empty through all stages.

SQL cannot express the learned stages, so ``ORACLE_SQL`` is None and the tests
compare the stages with brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm import bpe, decontam, langid, line_crf, simhash
from cartflow.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BROADCAST_ROWS = 500_000   # row numbers, 8 bytes each, that are still sent to every executor
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (no letters) and those that no language explains well."""
    return langid.explained(docs.select(*COLUMNS), public_tokenizers.path("piece_bpe_32k.model"), LEAST_LANGUAGE_SCORE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the line field predicts to be bad."""
    return line_crf.good_rows(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: that with the smallest id, null last; of equal ids, that with the smallest text hash.

    Rows are told apart by a number, written once beside them, as ids may be null or repeated.
    """
    rows = written(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "stage-rows")
    groups = simhash.near_duplicates(rows.select("_row", "text"), shingle=4, bits=4, id_col="_row") \
        .select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.xxhash64("lang", "source", "n_chars"),
                     "_row")
    kept = written(rows.select("_row", order.alias("_order")).join(groups, "_row")
                   .groupBy("_group").agg(F.min("_order").getField("_row").alias("_row")).select("_row"), "stage-kept")
    # Broadcast only while it is small, counted first.
    if kept.count() <= BROADCAST_ROWS:
        kept = F.broadcast(kept)
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontam.clean_rows(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the kept documents, as digests beside their ids."""
    return bpe.digests(bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                            public_tokenizers.PATTERN))


STAGES = [("language id", language_id), ("quality classifier", quality), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontaminate), ("byte-level bpe", byte_bpe)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
