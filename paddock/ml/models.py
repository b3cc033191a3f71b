"""Trainers, evaluation, random search, run records and scoring."""

from __future__ import annotations

import random
import time
import uuid
from importlib import import_module

from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paddock.ml.features import LABEL

REGRESSION_METRICS = ("rmse", "r2", "mse", "mae")
CLASS_METRICS = ("accuracy", "f1", "recall", "precision")

# The range each tuned parameter is drawn from, and the number of trials.
SEARCH_SPACE = {"numTrees": (50, 500), "maxBins": (2, 32), "maxDepth": (2, 20)}
TRIALS = 8
# Bytes of node numbers, one per row and tree, that a forest may keep while it grows; twice as many are held for a moment.
NODE_ID_BYTES = 1 << 33

RUNS_SCHEMA = "run_id string, name string, start_time timestamp, params map<string,string>, metrics map<string,double>"


def linear_regression(**params) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=LABEL, **{"elasticNetParam": 0.8, "regParam": 0.0, **params})


def tree_regressor(**params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(featuresCol="features", labelCol=LABEL, **{
        "maxDepth": 8, "minInstancesPerNode": 200, "maxBins": 5, "impurity": "variance", **params})


def tree_classifier(**params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol="features", labelCol=LABEL, **{
        "maxDepth": 8, "minInstancesPerNode": 200, "maxBins": 6, **params})


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` in at least one partition per core: a fit makes no more tasks than its input has partitions, and a small file is one."""
    cores, now = rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions()
    return rows.repartition(cores) if now < cores else rows


def dealt(rows: DataFrame) -> DataFrame:
    """``rows``, of a table or a stream, dealt over the tasks: scoring takes far longer than reading, and a few files are a few tasks."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def numbered(estimator, rows: DataFrame, trees: int | None = None):
    """``estimator``, a forest of which keeps the node that every row has reached in every tree.

    Otherwise each level leads all rows through all trees again from the root. The trees are the same.
    The numbers are kept as the rows are, on disk where memory is short, if they take ``NODE_ID_BYTES`` at most.
    """
    if not isinstance(estimator, RandomForestClassifier):
        return estimator
    return estimator.copy({estimator.cacheNodeIds: 4 * rows.count() * (trees or estimator.getNumTrees()) <= NODE_ID_BYTES})


def random_forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol=LABEL, **{
        "numTrees": 200, "maxDepth": 8, "maxBins": 4, "seed": 14, **params})


def regression_metrics(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """The four regression metrics from one aggregate."""
    error = F.col(label) - F.col("prediction")
    row = predictions.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("v")).first()
    if row["mse"] is None:
        raise ValueError("no predictions to evaluate")
    r2 = 1 - row["mse"] / row["v"] if row["v"] else float("nan")
    found = {"rmse": row["mse"] ** 0.5, "r2": r2, "mse": row["mse"], "mae": row["mae"]}
    return {m: found[m] for m in REGRESSION_METRICS}


def class_metrics(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    row = metrics_from_counts(predictions, label).first()
    return {m: row[m] for m in CLASS_METRICS}


def metrics_from_counts(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """The four classification metrics from one aggregate over (label, prediction)."""
    cells = predictions.groupBy(F.col(label).cast("double").alias("l"), F.col("prediction").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col("l").alias("c")).agg(F.sum("n").alias("actual"), F.sum(hit).alias("hit"))
    predicted = cells.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("predicted"))
    per_class = actual.join(predicted, "c", "left").na.fill(0, ["predicted"])
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), F.lit(0.0))
    recall = F.col("hit") / F.col("actual")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("actual")
    return per_class.agg(
        (F.sum("hit") / total).alias("accuracy"), (F.sum(f1 * F.col("actual")) / total).alias("f1"),
        (F.sum(recall * F.col("actual")) / total).alias("recall"), (F.sum(precision * F.col("actual")) / total).alias("precision"))


def train(name: str, estimator, train_df: DataFrame, test_df: DataFrame, runs: "RunLog | None" = None) -> tuple[Model, dict, DataFrame]:
    """Fit, predict the test part, evaluate and record the run."""
    model = numbered(estimator, train_df).fit(train_df)
    predictions = model.transform(test_df)
    regression = isinstance(estimator, (LinearRegression, DecisionTreeRegressor))
    metrics = regression_metrics(predictions) if regression else class_metrics(predictions)
    if runs is not None:
        params = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
        runs.record(name, params, metrics)
    return model, metrics, predictions


def draws(space: dict[str, tuple[int, int]] = SEARCH_SPACE, trials: int = TRIALS, seed: int = 14) -> list[dict[str, int]]:
    """Uniform draws per parameter, cut to whole numbers."""
    rng = random.Random(seed)
    return [{n: int(rng.uniform(low, high)) for n, (low, high) in space.items()} for _ in range(trials)]


def random_search(train_df: DataFrame, candidates: list[dict[str, int]], parallelism: int = 2, seed: int = 14,
                  folds: int | None = None) -> tuple[dict[str, int], list[float], Model]:
    """Best draw by validation accuracy, the accuracy of every draw, and the refitted forest."""
    forest = numbered(random_forest(seed=seed), train_df, max((c.get("numTrees", 0) for c in candidates), default=0))
    grid = [{forest.getParam(n): v for n, v in c.items()} for c in candidates]
    accuracy = MulticlassClassificationEvaluator(predictionCol="prediction", labelCol=LABEL, metricName="accuracy")
    shared = dict(estimator=forest, estimatorParamMaps=grid, evaluator=accuracy, parallelism=parallelism, seed=seed)
    if folds is None:
        fitted = TrainValidationSplit(trainRatio=0.75, **shared).fit(train_df)
        scores = list(fitted.validationMetrics)
    else:
        fitted = CrossValidator(numFolds=folds, **shared).fit(train_df)
        scores = list(fitted.avgMetrics)
    best = max(range(len(scores)), key=lambda i: scores[i])
    return candidates[best], scores, fitted.bestModel


def prediction_table(predictions: DataFrame, keep: list[str]) -> DataFrame:
    """Predictions without vector columns, ready for a file sink."""
    shown = [vector_to_array("probability").alias("probability")] if "probability" in predictions.columns else []
    return predictions.select(*keep, "prediction", *shown)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def reloaded(spark: SparkSession, model, path: str):
    """``model`` as its files have it, without the training summary.

    The summary of a model of two classes holds the session, and tasks that score
    with it fail once the session has got a part that cannot be sent, an
    observation for one.
    """
    return load_model(spark, save_model(model, path))


def load_model(spark: SparkSession, path: str):
    """The model saved at ``path``, as the class its own metadata names."""
    stored = spark.read.text(f"{path}/metadata").select(F.get_json_object("value", "$.class").alias("kind")).first()["kind"]
    module, _, name = stored.replace("org.apache.spark", "pyspark", 1).rpartition(".")
    if not module.startswith("pyspark.ml"):
        raise ValueError(f"{stored} is no model of this library")
    package = import_module("pyspark.ml" if name == "PipelineModel" else module)
    return getattr(package, name).load(path)


def score(model_path: str, fresh: DataFrame, encoder_path: str) -> DataFrame:
    """Predictions for new rows without label; works on batch and streaming frames."""
    spark = fresh.sparkSession
    return load_model(spark, model_path).transform(load_model(spark, encoder_path).transform(dealt(fresh)))


class RunLog:
    """Runs as appended rows (run_id, name, start_time, params, metrics)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, name: str, params: dict[str, str], metrics: dict[str, float]) -> str:
        run_id = uuid.uuid4().hex
        row = [(run_id, name, time.time(), params, metrics)]
        raw = self.spark.createDataFrame(row, RUNS_SCHEMA.replace("timestamp", "double"))
        raw.withColumn("start_time", F.col("start_time").cast("timestamp")).coalesce(1).write.mode("append").parquet(self.path)
        return run_id

    def table(self) -> DataFrame:
        return self.spark.read.schema(RUNS_SCHEMA).parquet(self.path)


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.agg(F.max_by(F.struct("run_id", "name", "start_time", "metrics"), F.struct("start_time", "run_id")).alias("r")).select("r.*")


def metric_rows(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "name", F.explode("metrics").alias("metric", "value"))


def wide_metrics(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per run, one column per metric."""
    return runs.select("run_id", "name", *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics])


def search_runs(runs: DataFrame, condition: Column | str | None = None, order: list | None = None) -> DataFrame:
    """The runs that fulfil a condition over name, start_time, params and metrics, the newest first or as ordered."""
    found = runs if condition is None else runs.where(condition)
    return found.orderBy(*(order or [F.col("start_time").desc(), F.col("run_id").desc()]))


class Registry:
    """Registered models: versions 1, 2, ... per name, one folder per version.

    A version is taken by writing its folder, which must not exist; whoever comes
    second takes the next one. Rows are never changed.
    """

    SCHEMA = "model_path string, run_id string, registered timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def register(self, name: str, model_path: str, run_id: str | None = None) -> int:
        row = self.spark.createDataFrame([(model_path, run_id)], "model_path string, run_id string").withColumn(
            "registered", F.current_timestamp()).coalesce(1)
        version = self._newest(name)
        while True:
            version += 1
            try:
                row.write.mode("error").parquet(f"{self.path}/name={name}/version={version}")
                return version
            except AnalysisException as taken:
                if taken.getCondition() != "PATH_ALREADY_EXISTS":
                    raise

    def _newest(self, name: str) -> int:
        newest = self.versions().where(F.col("name") == name).agg(F.max("version")).first()[0]
        return newest or 0

    def versions(self) -> DataFrame:
        """(name, version, model_path, run_id, registered)."""
        whole = f"name string, version long, {self.SCHEMA}"
        try:
            return self.spark.read.schema(f"{self.SCHEMA}, name string, version long").parquet(self.path).select(
                "name", "version", "model_path", "run_id", "registered")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], whole)

    def load(self, name: str, version: int | None = None):
        """The model of a version, the newest by default."""
        rows = self.versions().where(F.col("name") == name)
        chosen = rows.orderBy(F.col("version").desc()) if version is None else rows.where(F.col("version") == version)
        row = chosen.first()
        if row is None:
            raise LookupError(f"no model {name} {version or ''}")
        return load_model(self.spark, row["model_path"])
