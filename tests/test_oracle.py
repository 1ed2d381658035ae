"""Every registered query with a SQL twin agrees with DuckDB on sf0.001."""

import pytest

from cartflow.plans.catalog import ORACLE, QUERIES
from oracle_compare import compare, duck

SLOW = {"stream_sessions", "hopping_counts", "hourly_tumbling", "dedup_events"}


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", sorted(k for k in ORACLE if k not in SLOW))
def test_matches_oracle(spark, small_dir, con, name):
    r = compare(spark, name, small_dir, con)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(SLOW))
def test_streaming_matches_batch(spark, small_dir, con, name):
    r = compare(spark, name, small_dir, con)
    assert r["status"] == "ok", r


def test_every_query_has_twin_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"system_metrics", "train_forest", "train_boosted",
                         "train_stacked", "feature_importance", "meta_weights", "compare_models",
                         "score_sessions", "save_load_model", "describe_columns", "write_keyed_json",
                         "stream_predictions", "stream_scores", "list_views"}


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_predictions_are_complete(spark, small_dir):
    p = QUERIES["stream_predictions"](spark, small_dir)
    assert p.count() > 0 and p.filter("risk_level IS NULL OR abandonment_probability IS NULL").count() == 0
