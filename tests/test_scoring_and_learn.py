"""Scoring contract rows and a small end-to-end training run."""

from pyspark.sql import functions as F

from cartflow.operators.scoring import feature_violations

def _session(session_id, views, products, adds, removals, cart, seconds, **more):
    """A session whose derived features follow from its counts by the serving rules."""
    row = dict(session_id=session_id, page_views=views, products_viewed=products, unique_products_viewed=products,
               searches=1, cart_additions=adds, cart_removals=removals, cart_value=cart,
               session_duration_seconds=seconds, avg_time_per_page=round(seconds / views, 2), engagement_score=0.5,
               cart_engagement=adds - removals, time_per_product=round(seconds / products, 2),
               cart_to_checkout_rate=0.0, pages_per_minute=round(views / (seconds / 60), 2), unique_product_ratio=1.0,
               device_type="desktop", browser="Edge", persona="intent_buyer", bounce=False, checkout_initiated=False)
    return row | more


CONTRACT = [_session("s_one", 10, 4, 3, 1, 90.25, 600, device_type="tablet"),
            _session("s_two", 3, 2, 1, 0, 12.0, 90, persona="window_shopper"),
            _session("s_three", 20, 9, 6, 0, 410.75, 1800, checkout_initiated=True, cart_to_checkout_rate=0.17)]


def test_contract_rows_pass_validation(spark):
    df = spark.createDataFrame(CONTRACT)
    out = feature_violations(df).select("session_id", F.size("violations").alias("n")).collect()
    assert all(r.n == 0 for r in out)


def test_out_of_range_features_rejected(spark):
    bad = dict(CONTRACT[0], engagement_score=1.5, cart_value=-1.0)
    v = feature_violations(spark.createDataFrame([bad])).collect()[0].violations
    assert set(v) == {"engagement_score > 1", "cart_value < 0"}


def test_train_and_score_small(spark, small_dir):
    from cartflow.learn import models as L
    from cartflow.operators.sessions import session_records
    from cartflow.sources.fixture import load_events
    frame = L.training_frame(session_records(load_events(spark, small_dir)))
    train, test = L.stratified_split(frame)
    assert train.count() + test.count() == frame.count()
    model = L.train_forest(train, {"numTrees": [10], "maxDepth": [4]}, folds=2)
    m = L.evaluate(model.transform(test), "forest").collect()[0]
    assert 0.0 <= m.accuracy <= 1.0 and m.tp + m.fp + m.tn + m.fn == test.count()
    # AUC as the share of (abandoned, other) pairs ranked rightly, ties half.
    p = model.transform(test).select("label", L.positive_probability(model.transform(test)).alias("p")).collect()
    pos, neg = [r.p for r in p if r.label == 1], [r.p for r in p if r.label == 0]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert abs(m.roc_auc - pairs / (len(pos) * len(neg))) < 1e-3
    weights = L.with_class_weights(train).groupBy("label").agg(F.sum("balanced").alias("w")).collect()
    assert len(weights) == 2 and abs(weights[0].w - weights[1].w) < 1e-6
    scored = L.score(test, model)
    assert scored.count() == test.count()
    assert scored.filter("prediction_timestamp IS NULL OR user_id IS NULL OR confidence IS NULL").count() == 0
    assert scored.filter(~F.col("risk_level").isin("LOW", "MEDIUM", "HIGH", "CRITICAL")).count() == 0
    assert L.feature_importance(spark, model, 5).count() == 5


def test_features_are_fitted_once_a_fold(spark, small_dir, monkeypatch):
    """The model is the one that a search over whole pipelines finds; the feature stages are not fitted for each point."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from cartflow.learn import models as L
    from cartflow.operators.sessions import session_records
    from cartflow.session import stored
    from cartflow.sources.fixture import load_events
    train = stored(L.training_frame(session_records(load_events(spark, small_dir))).coalesce(1), "test-train")
    fits, fit = [], StandardScaler._fit
    monkeypatch.setattr(StandardScaler, "_fit", lambda self, data: fits.append(1) or fit(self, data))
    got = L.train_forest(train, {"numTrees": [3, 6], "maxDepth": [3]}, folds=2)
    assert len(fits) == 3  # two folds and the whole
    rf = RandomForestClassifier(labelCol=L.LABEL, featuresCol="features", weightCol="balanced", seed=42)
    grid = ParamGridBuilder().addGrid(rf.numTrees, [3, 6]).addGrid(rf.maxDepth, [3]).build()
    data = stored(L.with_class_weights(train).withColumn("_fold", L.id_bucket("session_id", 43, 2)), "test-folds")
    want = CrossValidator(estimator=Pipeline(stages=[*L.feature_pipeline(), rf]), estimatorParamMaps=grid,
                          evaluator=L._f1_evaluator(), numFolds=2, foldCol="_fold").fit(data).bestModel
    text = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    assert text(got) == text(want)
