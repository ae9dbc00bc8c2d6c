"""Delay models: boosted trees for delay seconds and, as a softmax, for the three classes (on_time / delayed / severe),
on features that an MLlib pipeline encodes and scales; metrics are DataFrame aggregations."""
from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.buckets import delay_bucket_code
from ..params import BUCKET_MAP, CAT_FEATURES, MIN_FEATURE_DELAY, NUM_FEATURES
from ..session import materialise
from . import boosting

BUCKET_NAMES = {v: k for k, v in BUCKET_MAP.items()}


@dataclass
class ModelParams:
    """Boosting parameters (fixed values of the model: trees, depth, learning rate, row and column shares, L1 and L2
    penalties, seed), the share of the test rows and the least number of rows."""
    n_estimators: int = 300
    max_depth: int = 5
    learning_rate: float = 0.08
    subsample: float = 0.9
    colsample: float = 0.8
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    seed: int = 42
    test_fraction: float = 0.2
    min_rows: int = 200
    extra: dict = field(default_factory=dict)

    def boosting(self) -> boosting.BoostParams:
        return boosting.BoostParams(self.n_estimators, self.max_depth, self.learning_rate, self.subsample, self.colsample,
                                    self.reg_alpha, self.reg_lambda, seed=self.seed)


def prepare(features: DataFrame) -> DataFrame:
    """Coerce numerics (unparsable -> 0), categories as text (NULL ->
    'unknown'), missing columns defaulted, NULL / implausible target dropped,
    class label from the delay bucket."""
    df = features
    for c in NUM_FEATURES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    for c in CAT_FEATURES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("unknown"))
    df = df.withColumn("delay_seconds", F.col("delay_seconds").cast("string").try_cast("double"))
    df = df.where(F.col("delay_seconds").isNotNull() & (F.col("delay_seconds") >= MIN_FEATURE_DELAY))
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) for c in NUM_FEATURES})
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in CAT_FEATURES})
    return df.withColumn("label_class", delay_bucket_code("delay_seconds").cast("double"))


def in_test(test_fraction: float = 0.2, seed: int = 42):
    """Test-set membership from the MD5 of seed and row key, the same on every engine and partitioning."""
    key = F.concat_ws("|", F.lit(str(seed)), "trip_id", "stop_id", F.unix_micros("event_ts").cast("string"))
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10_000
    return h >= int(round((1 - test_fraction) * 10_000))


def split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    test = in_test(test_fraction, seed)
    return df.where(~test), df.where(test)


def feature_stages() -> list:
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in CAT_FEATURES]
    # the 'keep' bucket is last and dropped: an unseen category encodes as all zeros
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in CAT_FEATURES], outputCols=[f"{c}_ohe" for c in CAT_FEATURES],
                        dropLast=True, handleInvalid="keep")
    num = VectorAssembler(inputCols=NUM_FEATURES, outputCol="num_vec", handleInvalid="keep")
    scaler = StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True)
    allv = VectorAssembler(inputCols=[f"{c}_ohe" for c in CAT_FEATURES] + ["num_scaled"], outputCol="features")
    return idx + [ohe, num, scaler, allv]


@dataclass
class TrainedModels:
    encoder: PipelineModel
    forest: boosting.Forest
    train_rows: int
    test_rows: int
    params: ModelParams


def _row_key():
    return F.xxhash64("trip_id", "stop_id", "event_ts")


def train(features: DataFrame, p: ModelParams | None = None) -> tuple[TrainedModels, DataFrame]:
    p = p or ModelParams()
    data = materialise(prepare(features), "prepared")  # read by the encoder, the trees and the caller's metrics
    n = data.count()
    if n < p.min_rows:
        raise ValueError(f"{n} feature rows are fewer than the {p.min_rows} that a model is fitted on.")
    tr, te = split(data, p.test_fraction, p.seed)
    encoder = Pipeline(stages=feature_stages()).fit(tr)
    rows = encoder.transform(tr).select(_row_key().alias("key"), F.col("delay_seconds").alias("y"),
                                        F.col("label_class").alias("label"), vector_to_array("features").alias("x"))
    forest = boosting.fit(rows, p.boosting(), len(BUCKET_NAMES))
    return TrainedModels(encoder, forest, tr.count(), te.count(), p), te


def predict(models: TrainedModels, df: DataFrame) -> DataFrame:
    out = boosting.scored(models.encoder.transform(df), models.forest)
    return out.select(*df.columns, "pred_delay", "pred_class", "probability")


def metrics(models: TrainedModels, test: DataFrame) -> DataFrame:
    """MAE, R^2, accuracy and per-class precision / recall / f1 / support, as
    rows (metric, label, value) computed by Spark aggregations."""
    s = predict(models, test).select(F.col("delay_seconds").alias("y"), F.col("pred_delay").alias("yhat"),
                                     F.col("label_class").cast("int").alias("c"),
                                     F.col("pred_class").cast("int").alias("chat"))
    return evaluate(materialise(s, "predictions"), models.train_rows, models.test_rows)


def evaluate(s: DataFrame, train_rows: int, test_rows: int) -> DataFrame:
    """Metrics of predictions: s has y, yhat (seconds), c, chat (classes). They read s several times, so it should be a
    stored table."""
    glob = s.agg(F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"),
                 F.sum((F.col("y") - F.col("yhat")) ** 2).alias("ss_res"),
                 (F.count(F.lit(1)) * F.var_pop("y")).alias("ss_tot"),
                 F.avg((F.col("c") == F.col("chat")).cast("double")).alias("accuracy"))
    def row(name, value):
        return F.struct(F.lit(name).alias("metric"), F.lit(None).cast("string").alias("label"),
                        value.cast("double").alias("value"))

    g = glob.select(F.explode(F.array(
        row("mae_seconds", F.round("mae", 2)),
        row("r2", F.round(1 - F.col("ss_res") / F.col("ss_tot"), 4)),
        row("accuracy", F.round("accuracy", 4)),
        row("training_rows", F.lit(train_rows)),
        row("test_rows", F.lit(test_rows)))).alias("m")).select("m.*")
    names = F.create_map(*[x for k, v in BUCKET_NAMES.items() for x in (F.lit(k), F.lit(v))])
    labels = s.select(F.col("c").alias("k")).union(s.select(F.col("chat").alias("k"))).distinct()
    per = labels.join(s.groupBy(F.col("c").alias("k")).agg(F.count(F.lit(1)).alias("support")), "k", "left") \
        .join(s.groupBy(F.col("chat").alias("k")).agg(F.count(F.lit(1)).alias("predicted")), "k", "left") \
        .join(s.where(F.col("c") == F.col("chat")).groupBy(F.col("c").alias("k")).agg(F.count(F.lit(1)).alias("tp")),
              "k", "left").fillna(0)
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    per = per.select(names[F.col("k")].alias("label"), prec.alias("precision"), rec.alias("recall"),
                     f1.alias("f1"), F.col("support").cast("double").alias("support"))
    per_rows = per.select("label", F.explode(F.array(
        *[F.struct(F.lit(m).alias("metric"), F.round(F.col(m), 4).alias("value")) for m in
          ("precision", "recall", "f1", "support")])).alias("m")).select("m.metric", "label", "m.value")
    return g.unionByName(per_rows)


def save(models: TrainedModels, model_dir: str, metrics_df: DataFrame | None = None) -> None:
    """Persist encoder, trees, the feature contract and the metrics (written through Spark, so a shared model folder
    works on a cluster)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    models.encoder.write().overwrite().save(f"{model_dir}/encoder")
    boosting.save(spark, models.forest, f"{model_dir}/forest")
    contract = json.dumps({"cat_features": CAT_FEATURES, "num_features": NUM_FEATURES,
                           "target_regression": "delay_seconds", "target_classification": "delay_bucket",
                           "bucket_map": BUCKET_MAP, "bucket_names": {str(k): v for k, v in BUCKET_NAMES.items()},
                           "params": models.params.__dict__})
    spark.createDataFrame([(contract,)], "value string").write.mode("overwrite").text(f"{model_dir}/features")
    if metrics_df is not None:
        metrics_df.write.mode("overwrite").json(f"{model_dir}/metrics")


def load(model_dir: str, params: ModelParams | None = None) -> TrainedModels:
    from pyspark.sql import SparkSession
    return TrainedModels(PipelineModel.load(f"{model_dir}/encoder"),
                         boosting.load(SparkSession.getActiveSession(), f"{model_dir}/forest"), 0, 0, params or ModelParams())


def score(models: TrainedModels, df: DataFrame, max_delay: float = 1800.0) -> DataFrame:
    """Batch scoring: missing features defaulted, delay clipped to
    [0, max_delay] and rounded to 0.1 s, bucket name and class probabilities."""
    x = df
    for c in NUM_FEATURES:
        if c not in x.columns:
            x = x.withColumn(c, F.lit(0.0))
    for c in CAT_FEATURES:
        if c not in x.columns:
            x = x.withColumn(c, F.lit("unknown"))
    x = x.withColumns({c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) for c in NUM_FEATURES})
    x = x.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in CAT_FEATURES})
    p = predict(models, x)
    names = F.create_map(*[v for k, n in BUCKET_NAMES.items() for v in (F.lit(float(k)), F.lit(n))])
    probs = F.col("probability")
    return p.select(*df.columns,
                    F.round(F.least(F.greatest(F.col("pred_delay"), F.lit(0.0)), F.lit(max_delay)), 1)
                    .alias("predicted_delay_seconds"),
                    F.coalesce(names[F.col("pred_class")], F.lit("on_time")).alias("predicted_bucket"),
                    *[F.round(probs[i], 4).alias(f"p_{BUCKET_NAMES[i]}") for i in range(3)])
