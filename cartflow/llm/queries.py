"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, class_lm, decontam, langid, licenses, line_crf, minhash, phrases, quality_rules, rans,
               simhash, url_filter, whitening)

PIECES = "piece_bpe_32k.model"
BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_documents(_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.listed_pages(pages), url_filter.PAGE_RULES)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.encode_and_read(_table(spark, sf_dir, "documents"), _tokenizer(BPE_JSON))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, bits=4)


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), _tokenizer(PIECES))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.digests(bpe.encode_documents(_table(spark, sf_dir, "documents"), _tokenizer(BPE_RANKS),
                                            public_tokenizers.PATTERN))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_class_lm, op3_url_filter, op4_token_files, op5_simhash, op6_line_crf, op7_langid,
    op8_decontaminate, op9_licenses, op10_byte_bpe, op11_whitening, op12_minhash, op13_phrases)}

ORACLE = {"op1_quality_rules": quality_rules.JUDGE_SQL, "op3_url_filter": url_filter.PAGES_SQL,
          "op13_phrases": phrases.COLLOCATIONS_SQL}
