"""Abandonment models on Spark ML.

* M1 ``feature_pipeline``: category codes in alphabetical order (NULL becomes
  the text 'nan', as the training loader did), the 15 numeric features scaled
  (fitted on the training split only), then all 20 features assembled.
* M2 ``stratified_split``: deterministic hash bucket of the session id, so
  each label keeps its share without a per-label window or a sample.
* M3-M5: random forest / boosted trees with ``CrossValidator`` (F1 of the
  positive class), and a stacked logistic meta-learner on out-of-fold base
  probabilities.
* M6 ``evaluate`` / M7 ``feature_importance`` / M8 ``compare_models`` /
  M9 ``score``: distributed metrics, importances and scoring as DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow import constants as K
from cartflow.functions.exprs import risk_confidence, round_half_up
from cartflow.learn.grids import BOOSTED_FOLDS, BOOSTED_GRID, FOREST_FOLDS, FOREST_GRID
from cartflow.operators.scoring import predictions_from_probability
from cartflow.session import fresh_dir

LABEL = "label"


def training_frame(sess: DataFrame) -> DataFrame:
    """C9 features with the names the models expect, plus the label, user and last activity (as ``ts``)."""
    c = F.col
    w = K.TRAIN_ENGAGEMENT_WEIGHTS
    dbl = lambda x: c(x).cast("double")
    return sess.select(
        "session_id", "user_id", c("last_activity").alias("ts"),
        *[dbl(x).alias(x) for x in ["page_views", "products_viewed", "unique_products_viewed", "searches",
                                    "cart_additions", "cart_removals", "cart_value", "session_duration_seconds",
                                    "avg_time_per_page"]],
        (dbl("page_views") * w["page_views"] + dbl("products_viewed") * w["products_viewed"]
         + dbl("searches") * w["searches"]).alias("engagement_score"),
        (dbl("cart_additions") - dbl("cart_removals")).alias("cart_engagement"),
        (dbl("session_duration_seconds") / (dbl("products_viewed") + 1)).alias("time_per_product"),
        (c("checkout_initiated").cast("double") / (dbl("cart_additions") + 1)).alias("cart_to_checkout_rate"),
        (dbl("page_views") / (dbl("session_duration_seconds") / 60.0 + 1)).alias("pages_per_minute"),
        (dbl("unique_products_viewed") / (dbl("products_viewed") + 1)).alias("unique_product_ratio"),
        *[F.coalesce(c(x).cast("string"), F.lit("nan")).alias(x) for x in K.CATEGORICAL_FEATURES],
        *[c(x).cast("double").alias(x) for x in K.BINARY_FEATURES],
        ((c("cart_value") > 0) & ~c("is_converted")).cast("double").alias(LABEL),
    )


def feature_pipeline() -> list:
    """M1: stages that turn the training frame into ``features``."""
    idx = [StringIndexer(inputCol=x, outputCol=f"{x}_code", stringOrderType="alphabetAsc", handleInvalid="keep")
           for x in K.CATEGORICAL_FEATURES]
    num = VectorAssembler(inputCols=K.NUMERIC_FEATURES, outputCol="_numeric")
    scale = StandardScaler(inputCol="_numeric", outputCol="_numeric_scaled", withMean=True, withStd=True)
    allf = VectorAssembler(inputCols=["_numeric_scaled", *[f"{x}_code" for x in K.CATEGORICAL_FEATURES],
                                      *K.BINARY_FEATURES], outputCol="features")
    return [*idx, num, scale, allf]


FEATURE_NAMES = K.NUMERIC_FEATURES + K.CATEGORICAL_FEATURES + K.BINARY_FEATURES


def id_bucket(id_col: str, seed: int, n: int) -> F.Column:
    """0 to n-1 from the first 32 bits of md5('seed:id'), which SQL engines share."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col)).cast("binary")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(n)).cast("int")


def with_class_weights(train: DataFrame) -> DataFrame:
    """``train`` with the weight columns a grid can choose from: ``balanced`` and ``even`` (1).

    Balanced is rows / (labels * rows of the label); one row per label reaches the driver.
    """
    n = {r[LABEL]: r["n"] for r in train.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.lit(1.0)
    for label, k in n.items():
        weight = F.when(F.col(LABEL) == label, sum(n.values()) / (len(n) * k)).otherwise(weight)
    return train.withColumn("balanced", weight).withColumn("even", F.lit(1.0))


def stratified_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                     id_col: str = "session_id") -> tuple[DataFrame, DataFrame]:
    """M2: deterministic split by a hash bucket of the id (per label in expectation)."""
    bucket = id_bucket(id_col, seed, 10_000)
    tagged = df.withColumn("_test", bucket < int(test_fraction * 10_000))
    return tagged.filter(~F.col("_test")).drop("_test"), tagged.filter(F.col("_test")).drop("_test")


def _stored(frame: DataFrame) -> DataFrame:
    """``frame`` as a table in the shared folder, so that its many fits do not repeat its lineage."""
    spark = frame.sparkSession
    path = fresh_dir(spark, "training-frame")
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _f1_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def train_forest(train: DataFrame, grid: dict | None = None, folds: int = FOREST_FOLDS, seed: int = 42,
                 parallelism: int = 4) -> PipelineModel:
    """M3: random forest chosen by cross-validated F1 of the abandoned class (all of ``FOREST_GRID`` by default)."""
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol="balanced", seed=seed)
    grid = grid or FOREST_GRID
    return _cross_validate(with_class_weights(train), rf, grid, folds, seed, parallelism)


def train_boosted(train: DataFrame, grid: dict | None = None, folds: int = BOOSTED_FOLDS, seed: int = 42,
                  parallelism: int = 4) -> PipelineModel:
    """M4: gradient-boosted trees chosen by cross-validated F1 (all of ``BOOSTED_GRID`` by default)."""
    gbt = GBTClassifier(labelCol=LABEL, featuresCol="features", seed=seed)
    grid = grid or BOOSTED_GRID
    return _cross_validate(train, gbt, grid, folds, seed, parallelism)


def _cross_validate(train: DataFrame, est, grid: dict, folds: int, seed: int, parallelism: int) -> PipelineModel:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    data = _stored(train.withColumn("_fold", id_bucket("session_id", seed + 1, folds)))
    features = Pipeline(stages=feature_pipeline()).fit(data)
    cv = _FeatureFolds(data.columns, estimator=est, estimatorParamMaps=builder.build(), evaluator=_f1_evaluator(),
                       numFolds=folds, foldCol="_fold", seed=seed, parallelism=parallelism)
    return PipelineModel([*features.stages, cv.fit(features.transform(data)).bestModel])


class _FeatureFolds(CrossValidator):
    """Fits the feature stages once a fold, on its training part: they are the same for every point of the grid."""

    def __init__(self, columns: Sequence[str], **params):
        super().__init__(**params)
        self._raw = list(columns)

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        needed = [LABEL, "features", *[c for c in ("balanced", "even") if c in self._raw]]
        pairs = []
        for fit_on, held in super()._kFold(dataset.select(*self._raw)):
            features = Pipeline(stages=feature_pipeline()).fit(fit_on)
            pairs.append((features.transform(fit_on).select(*needed), features.transform(held).select(*needed)))
        return pairs


def positive_probability(pred: DataFrame, col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col)).getItem(1)


def train_stacked(train: DataFrame, bases: dict[str, object] | None = None, folds: int = 5,
                  seed: int = 42) -> tuple[dict[str, PipelineModel], PipelineModel, list[str]]:
    """M5: base models' out-of-fold probabilities feed a logistic meta-learner.

    Returns (bases refitted on all training rows, meta model, base names).
    """
    bases = bases or {"forest": RandomForestClassifier(labelCol=LABEL, featuresCol="features", seed=seed,
                                                       numTrees=50, maxDepth=8),
                      "boosted": GBTClassifier(labelCol=LABEL, featuresCol="features", seed=seed, maxIter=30)}
    data = _stored(train.withColumn("_fold", id_bucket("session_id", seed + 1, folds)))
    oof = None
    for k in range(folds):
        part = data.filter(F.col("_fold") == k).select("session_id", LABEL)
        fit_on = data.filter(F.col("_fold") != k)
        held = data.filter(F.col("_fold") == k)
        features = Pipeline(stages=feature_pipeline()).fit(fit_on)
        ready = features.transform(fit_on).select(LABEL, "features").persist()
        for name, est in bases.items():
            t = est.copy().fit(ready).transform(features.transform(held))
            p = t.select("session_id", positive_probability(t).alias(f"p_{name}"))
            part = part.join(p, "session_id")
        ready.unpersist()
        oof = part if oof is None else oof.unionByName(part)
    names = list(bases)
    meta = Pipeline(stages=[VectorAssembler(inputCols=[f"p_{n}" for n in names], outputCol="meta_features"),
                            LogisticRegression(labelCol=LABEL, featuresCol="meta_features", maxIter=1000)]).fit(oof)
    features = Pipeline(stages=feature_pipeline()).fit(data)
    ready = features.transform(data).select(LABEL, "features").persist()
    full = {n: PipelineModel([*features.stages, est.copy().fit(ready)]) for n, est in bases.items()}
    ready.unpersist()
    return full, meta, names


def predict_stacked(bases: dict[str, PipelineModel], meta: PipelineModel, names: list[str],
                    df: DataFrame) -> DataFrame:
    out = df
    for n in names:
        t = bases[n].transform(out)
        out = t.select(*out.columns, positive_probability(t).alias(f"p_{n}"))
    return meta.transform(out)


def evaluate(pred: DataFrame, model_name: str, prob_col: str = "probability") -> DataFrame:
    """M6: accuracy, precision, recall, F1, confusion counts and ROC-AUC as one row."""
    y, yhat = F.col(LABEL), F.col("prediction")
    counts = pred.agg(
        F.count_if((y == 1) & (yhat == 1)).alias("tp"), F.count_if((y == 0) & (yhat == 1)).alias("fp"),
        F.count_if((y == 0) & (yhat == 0)).alias("tn"), F.count_if((y == 1) & (yhat == 0)).alias("fn"))
    auc = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol=prob_col,
                                        metricName="areaUnderROC", numBins=0).evaluate(pred)
    c = F.col
    prec = F.try_divide(c("tp").cast("double"), (c("tp") + c("fp")).cast("double"))
    rec = F.try_divide(c("tp").cast("double"), (c("tp") + c("fn")).cast("double"))
    return counts.select(
        F.lit(model_name).alias("model"),
        round_half_up((c("tp") + c("tn")) / (c("tp") + c("tn") + c("fp") + c("fn")), 4).alias("accuracy"),
        round_half_up(F.coalesce(prec, F.lit(0.0)), 4).alias("precision"),
        round_half_up(F.coalesce(rec, F.lit(0.0)), 4).alias("recall"),
        round_half_up(F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)), 4).alias("f1"),
        F.lit(round(auc, 4)).alias("roc_auc"), "tp", "fp", "tn", "fn")


def feature_importance(spark: SparkSession, model: PipelineModel, n: int = 10) -> DataFrame:
    """M7: top-n feature importances of a tree model (or |coefficients| of a linear one)."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals = last.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in last.coefficients.toArray().tolist()]
    rows = list(zip(FEATURE_NAMES, [float(v) for v in vals]))
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(n)


def meta_weights(spark: SparkSession, meta: PipelineModel, names: Sequence[str]) -> DataFrame:
    """M7: the stacked model's weights per base model and its intercept."""
    lr = meta.stages[-1]
    rows = [(f"p_{n}", float(w)) for n, w in zip(names, lr.coefficients.toArray().tolist())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "term string, weight double")


def compare_models(metrics: DataFrame) -> DataFrame:
    """M8: the best model per metric."""
    cols = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    stacked = metrics.select("model", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                            for m in cols])).alias("m"))
    return stacked.groupBy(F.col("m.metric").alias("metric")).agg(
        F.max_by("model", F.struct(F.col("m.value"), F.col("model"))).alias("best_model"),
        F.max("m.value").alias("best_value"))


def score(features: DataFrame, model: PipelineModel, model_version: str = K.DEFAULT_MODEL_VERSION) -> DataFrame:
    """M9: probability, flag, risk level, intervention, confidence per row of ``training_frame`` (predictions shape).

    The prediction's time is the session's last activity; its latency is NULL, as nothing serves a request here.
    """
    t = model.transform(features)
    t = t.withColumn("_p", round_half_up(positive_probability(t), 4)).withColumn("event_id", F.xxhash64("session_id"))
    return predictions_from_probability(t, "_p", model_version) \
        .withColumn("confidence", risk_confidence(F.col("abandonment_probability")))


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
