"""Training: the weighted text classifier and the grid search of the location model; run metrics and quarantine."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.scores import is_relevant
from corvane.functions.text import one_line, tokens
from corvane.operators import evaluation, features, location
from corvane.sources.scratch import scratch_folder, written


def fit_classifier(rows: DataFrame, label: str = "label", text: str = "text", features_count: int = 1 << 16) -> PipelineModel:
    """A logistic regression on hashed tokens with balanced class weights: what a fine-tuned network is swapped in for."""
    weights = evaluation.class_weights(rows, label).select(F.col("label").alias(label), F.col("weight").alias("__weight"))
    ready = rows.join(F.broadcast(weights), label).withColumns({"__tokens": tokens(one_line(F.col(text))), label: F.col(label).cast("double")})
    stages = [HashingTF(inputCol="__tokens", outputCol="__features", numFeatures=features_count), LogisticRegression(featuresCol="__features", labelCol=label, weightCol="__weight", probabilityCol="__p", predictionCol="__prediction", rawPredictionCol="__raw", maxIter=50, regParam=0.01)]
    path = scratch_folder(rows.sparkSession, "classifier")
    Pipeline(stages=stages).fit(ready).write().save(path)
    return PipelineModel.load(path)  # without the training summary, which holds the session and so can't go to tasks once the session observes


#: Which confusions a run may penalize, as (label, predicted).
PENALTIES = {"1_to_0": (1, 0), "0_to_1": (0, 1), None: None}


def training_loss(scored: DataFrame, weights: DataFrame, penalize: str | None = None, penalty: float = 1.0) -> DataFrame:
    """(loss, penalized): of rows (label, p: the probabilities) the class-weighted cross-entropy, and that plus `penalty` for each
    confusion of the kind. A count of confusions has no slope, so it changes which run is taken for the best, not how one is fitted."""
    if penalize not in PENALTIES:
        raise ValueError(f"penalize must be one of {sorted(map(str, PENALTIES))}, not {penalize!r}")
    weighted = scored.join(F.broadcast(weights.select("label", "weight")), "label")  # a row for each class
    p = F.greatest(F.element_at("p", F.col("label").cast("int") + 1), F.lit(1e-12))
    confused = F.lit(0) if penalize is None else F.count_if((F.col("label") == PENALTIES[penalize][0]) & (F.array_position("p", F.array_max("p")) - 1 == PENALTIES[penalize][1]))
    loss = F.sum(-F.ln(p) * F.col("weight")) / F.sum("weight")
    return weighted.agg(loss.alias("loss"), (loss + penalty * confused).alias("penalized"))


def classify(model: PipelineModel, rows: DataFrame, group: str, text: str = "text") -> DataFrame:
    """rows with predicted (0 or 1) by the group's rule of relevance, and p, the probabilities. A column p of rows is replaced."""
    scored = model.transform(rows.withColumn("__tokens", tokens(one_line(F.col(text))))).withColumn("p", vector_to_array("__p"))
    scored = written(scored.drop("__tokens", "__features", "__raw", "__p", "__prediction"), "scored")  # each text is scored once
    return scored.select(*[c for c in rows.columns if c != "p"], is_relevant(group, F.col("p")).cast("int").alias("predicted"), "p")


@dataclass(frozen=True)
class Config:
    """One cell of the location model's grid."""

    vocab_size: int = 50_000
    selector: str = "mi"
    min_total_count: int = 3
    alpha_word: float = 0.1
    alpha_sub: float = 0.1
    alpha_hour: float = 0.1

    @property
    def key(self) -> str:
        return hashlib.md5(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:12]

    @property
    def smoothing(self) -> location.Smoothing:
        return location.Smoothing(self.alpha_word, self.alpha_sub, self.alpha_hour)


#: The grid.
GRID = (
    Config(vocab_size=50_000, selector="mi", min_total_count=3, alpha_word=0.1, alpha_sub=0.1, alpha_hour=0.1),
    Config(vocab_size=100_000, selector="mi", min_total_count=3, alpha_word=0.1, alpha_sub=0.1, alpha_hour=0.1),
    Config(vocab_size=50_000, selector="mi", min_total_count=3, alpha_word=0.5, alpha_sub=0.5, alpha_hour=0.5),
    Config(vocab_size=50_000, selector="mi", min_total_count=3, alpha_word=0.05, alpha_sub=0.2, alpha_hour=1.0),
    Config(vocab_size=100_000, selector="mi", min_total_count=3, alpha_word=0.05, alpha_sub=0.2, alpha_hour=1.0),
    Config(vocab_size=50_000, selector="mi", min_total_count=3, alpha_word=0.1, alpha_sub=0.5, alpha_hour=2.0),
)
METRICS = "cfg_key string, config string, f1_macro double, top5 double, mrr double, logloss double"


def fit_location(own: DataFrame, homes: DataFrame, config: Config, kappa: float = 0.5, most_locations: int | None = None) -> dict[str, DataFrame]:
    """The model's tables from the features of the training users and their homes; of the locations, all or the `most_locations` likeliest are candidates."""
    by = features.location_features(own, homes)
    known = features.priors(homes, kappa)
    mi = features.mutual_information(by, known, config.min_total_count) if config.selector == "mi" else None
    vocab = written(features.vocabulary(features.feature_totals(by), config.vocab_size, mi).select("feature"), "vocab")
    if most_locations:
        known = written(location.likeliest(known, most_locations), "likeliest")
        by = by.join(known.select("location"), "location", "left_semi")
    params, overrides = location.location_params(by, vocab, known, config.smoothing)
    return {"params": params, "overrides": overrides, "vocab": vocab, "priors": known}


def measure(model: dict[str, DataFrame], own: DataFrame, truth: DataFrame, config: Config, observed_only: bool = True) -> tuple[float, float, float, float]:
    """f1_macro at 1, top-5 accuracy, mean reciprocal rank and log loss on users (author, label)."""
    seen = evaluation.seen_labels(truth, model["priors"], location.UNKNOWN)
    scored = written(location.scores(own, truth, model["params"], model["overrides"], model["vocab"], model["priors"], config.smoothing, observed_only), "scores")
    f1 = evaluation.prf(evaluation.confusion(seen, location.top_locations(scored, 1))).first()["f1_macro"]
    ranks = evaluation.ranking(seen, scored).first()
    return f1, ranks["top5_acc"], ranks["mrr"], ranks["log_loss"]


def grid_search(spark: SparkSession, own: DataFrame, train: DataFrame, valid: DataFrame, path: str, grid: tuple[Config, ...] = GRID, most_locations: int | None = None) -> Config:
    """The best of the grid on the validation users. Each cell's metrics are appended to the table at `path`; a restart goes on after the
    cells that are there. train: (author, location); valid: (author, label)."""
    try:
        done = {r["cfg_key"] for r in spark.read.schema(METRICS).parquet(path).select("cfg_key").collect()}
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        done = set()
    for config in grid:
        if config.key not in done:
            row = (config.key, json.dumps(asdict(config), sort_keys=True), *map(float, measure(fit_location(own, train, config, most_locations=most_locations), own, valid, config)))
            spark.createDataFrame([row], METRICS).write.mode("append").parquet(path)
    keys = [c.key for c in grid]
    best = evaluation.best_config(spark.read.schema(METRICS).parquet(path).where(F.col("cfg_key").isin(keys))).first()
    return grid[keys.index(best["cfg_key"])]


def with_metrics(rows: DataFrame, name: str, passed: Column | None = None) -> tuple[DataFrame, object]:
    """rows and an observation of their count (and of those that pass), filled when they are written: no second pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(passed if passed is not None else F.lit(True)).alias("passed")), seen


def counts_of(seen: object) -> dict[str, int]:
    """What an observation saw; nothing, where the planner found that no row can come and took the observation out of the plan."""
    from py4j.protocol import Py4JJavaError

    try:
        return seen.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error):
            raise
        return {"total": 0, "passed": 0}


def log_metrics(spark: SparkSession, path: str, stage: str, metrics: dict[str, int]) -> None:
    """Appends a stage's counts to the table of run metrics."""
    rows = [(stage, name, int(n)) for name, n in metrics.items()]
    spark.createDataFrame(rows, "stage string, metric string, value long").withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)
