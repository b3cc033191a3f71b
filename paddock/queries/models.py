"""Features, models, evaluation, run records and scoring on the given tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    Bucketizer, MinMaxScaler, OneHotEncoder, QuantileDiscretizer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import functions as F

from paddock.ml import features, iterative, models
from paddock.operators import scan
from paddock.operators.hot import small_rows
from paddock.operators.rows import union_by_name
from paddock.plans import league
from paddock.queries import league as store
from paddock.queries.registry import query
from paddock.session import checkpoint, workspace
from paddock.streaming import jobs


# Rounds after which a fit that still moves is an error.
ROUNDS = 500


def model_rows(t):
    """One wide row per order, the input of the feature job."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    o, c, price = F.col("o_orderkey"), F.col("c_custkey"), F.col("o_totalprice")
    bonus = F.when(o % 4 == 0, F.lit(float("nan"))).otherwise((o % 25).cast("double"))
    return joined.select(
        F.col("o_orderkey").alias("row_id"), F.lower("o_orderstatus").alias("series"),
        F.when(c % 5 == 0, "F").otherwise("M").alias("gender"), F.col("n_name").alias("country"),
        F.make_date(1960 + (c % 40).cast("int"), F.lit(3), F.lit(7)).alias("birthday"),
        (1990 + c % 30).cast("int").alias("rookie_year"), F.least(F.floor(price / 8000), F.lit(60)).cast("int").alias("rank"),
        (o % 6).cast("int").alias("dnf"), (o % 11).cast("int").alias("top_5"), (o % 8).cast("int").alias("top_20"),
        (o % 3).cast("int").alias("poles"), bonus.alias("chase_bonus"),
        F.when(o % 9 == 0, F.lit(1.0)).alias("chase_wins"), F.when(o % 8 == 0, F.lit(2.0)).alias("chase_stage_wins"),
        (o % 40 + 0.5).cast("double").alias("avg_start_position"), (price / 10000).alias("avg_finish_position"),
        (price / 1000).alias("avg_laps_completed"), (o % 100 / F.lit(100.0)).alias("laps_led_pct"))


_ROWS = """
    m AS (SELECT o_orderkey AS row_id, lower(o_orderstatus) AS series, CASE WHEN c_custkey % 5 = 0 THEN 'F' ELSE 'M' END AS gender,
      n_name AS country, CAST(1960 + c_custkey % 40 AS INTEGER) AS birth_year, CAST(1990 + c_custkey % 30 AS INTEGER) AS rookie_year,
      least(CAST(floor(o_totalprice / 8000) AS INTEGER), 60) AS rank, o_orderkey % 6 AS dnf, CAST(o_orderkey % 11 AS INTEGER) AS top_5,
      o_orderkey % 8 AS top_20, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 25 AS DOUBLE) END AS chase_bonus,
      CAST(o_orderkey % 40 + 0.5 AS DOUBLE) AS avg_start_position, o_totalprice / 10000 AS avg_finish_position
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    f AS (SELECT row_id, series, gender, country, top_5, avg_start_position, avg_finish_position,
      coalesce(chase_bonus, (SELECT sum(coalesce(chase_bonus, 0)) / count(*) FROM m)) AS chase_bonus, CAST(2022 - birth_year AS INTEGER) AS age,
      CAST(2022 - rookie_year AS INTEGER) AS experience, CASE WHEN top_20 = 0 THEN 0.0 ELSE dnf / top_20 END AS "DNF_ratio",
      CASE WHEN rank BETWEEN 0 AND 10 THEN 1 WHEN rank BETWEEN 11 AND 30 THEN 2 WHEN rank BETWEEN 31 AND 50 THEN 3 ELSE 4 END AS rank_class FROM m)"""


@query("c07_feature_table", f"""
    WITH {_ROWS} SELECT row_id, series, gender, country, top_5, round(chase_bonus, 6) AS chase_bonus, age, experience,
      round("DNF_ratio", 6) AS dnf_ratio, rank_class FROM f""")
def _(t):
    table = features.feature_table(model_rows(t))
    return table.select("row_id", "series", "gender", "country", "top_5", F.round("chase_bonus", 6).alias("chase_bonus"),
                        "age", "experience", F.round("DNF_ratio", 6).alias("dnf_ratio"), "rank_class")


@query("c07_star_features", f"""
    WITH {store._ALL}
    SELECT pid AS driver_id, rid AS race_id, sd.series, CAST(2022 - CAST(substr(birthday, 1, 4) AS INTEGER) AS INTEGER) AS age,
      CASE WHEN top_20 = 0 THEN 0.0 ELSE round(dnf / top_20, 6) END AS dnf_ratio,
      CASE WHEN rank BETWEEN 0 AND 10 THEN 1 WHEN rank BETWEEN 11 AND 30 THEN 2 WHEN rank BETWEEN 31 AND 50 THEN 3 ELSE 4 END AS rank_class,
      round(coalesce(chase_bonus, (SELECT sum(coalesce(chase_bonus, 0)) / count(*) FROM sd)), 6) AS chase_bonus
    FROM sd JOIN pi ON pi.id = sd.id JOIN ri ON ri.series = sd.series AND ri.season = sd.season""")
def _(t):
    """The feature job on the star join of the stored tables."""
    folder = workspace(t.spark, "store")
    tables = league.load(t.spark, league.store(*store._sources(t), folder))
    table = features.feature_table(league.star(tables))
    return table.select("driver_id", "race_id", "series", "age", F.round("DNF_ratio", 6).alias("dnf_ratio"), "rank_class",
                        F.round("chase_bonus", 6).alias("chase_bonus"))


# Feature stages.

@query("m01_category_index", f"""
    WITH {_ROWS}, k AS (SELECT country, row_number() OVER (ORDER BY count(*) DESC, country) - 1 AS i FROM m GROUP BY 1)
    SELECT row_id, CAST(i AS DOUBLE) AS country_index FROM m JOIN k USING (country)""")
def _(t):
    rows = model_rows(t)
    indexer = StringIndexer(inputCol="country", outputCol="country_index")
    return indexer.fit(rows).transform(rows).select("row_id", "country_index")


@query("m02_one_hot", f"""
    WITH {_ROWS}, k AS (SELECT series, row_number() OVER (ORDER BY count(*) DESC, series) - 1 AS i, count(*) OVER () AS n FROM m GROUP BY 1)
    SELECT row_id, list_transform(range(0, n - 1), lambda j: CASE WHEN j = i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS encoded FROM m JOIN k USING (series)""")
def _(t):
    rows = model_rows(t)
    stages = [StringIndexer(inputCol="series", outputCol="i"), OneHotEncoder(inputCols=["i"], outputCols=["v"])]
    return Pipeline(stages=stages).fit(rows).transform(rows).select("row_id", vector_to_array("v").alias("encoded"))


@query("m03_assemble", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, [l_quantity, l_discount] AS v FROM lineitem")
def _(t):
    assembled = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="v").transform(t.lineitem)
    return assembled.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", vector_to_array("v").alias("v"))


@query("m04_min_max_scale", """
    SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS price, 0.5::DOUBLE AS constant
    FROM orders, (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.lit(3.0).alias("three"))
    stages = [VectorAssembler(inputCols=["o_totalprice", "three"], outputCol="v"), MinMaxScaler(inputCol="v", outputCol="s")]
    scaled = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("s", vector_to_array("s"))
    return scaled.select("o_orderkey", F.round(F.col("s")[0], 6).alias("price"), F.col("s")[1].alias("constant"))


def _encoded(t, invalid="error"):
    # Written once: every stage of the chain reads it to be fitted.
    table = checkpoint(features.feature_table(model_rows(t)))
    encoder = features.encoder(invalid=invalid).fit(table)
    return encoder, encoder.transform(table)


@query("m05_feature_vector", f"""
    WITH {_ROWS}, i AS (SELECT series AS s, row_number() OVER (ORDER BY count(*) DESC, series) - 1 AS j FROM m GROUP BY 1),
    b AS (SELECT min(top_5) AS lo, max(top_5) AS hi, min(age) AS alo, max(age) AS ahi FROM f)
    SELECT row_id, 2 + 1 + 24 + 9 AS size, CASE WHEN j = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS first_series,
      round((top_5 - lo) / (hi - lo), 6) AS top_5, round((age - alo) / (ahi - alo), 6) AS age FROM f JOIN i ON s = series, b""")
def _(t):
    """Three one-hot blocks and nine scaled numbers in one vector, by one chained fit."""
    _, encoded = _encoded(t)
    v = encoded.select("row_id", vector_to_array("features").alias("v"))
    return v.select("row_id", F.size("v").alias("size"), F.col("v")[0].alias("first_series"),
                    F.round(F.col("v")[27], 6).alias("top_5"), F.round(F.col("v")[33], 6).alias("age"))


@query("m06_chained_stages", """
    SELECT o_orderkey AS row_id, CAST(4 + 3 - 1 + 26 - 1 + 9 - 1 AS INTEGER) AS size, 5 AS n_stages FROM orders""")
def _(t):
    """Size and stage outputs of the fitted chain."""
    encoder, encoded = _encoded(t, "keep")
    return encoded.select("row_id", F.size(vector_to_array("features")).alias("size"), F.lit(len(encoder.stages)).alias("n_stages"))


@query("m07_stable_split", """
    SELECT 'all' AS part, count(*) AS n, true AS near_share, true AS whole FROM orders""")
def _(t):
    """Split by a hash of the row id, and the share each part got."""
    rows = model_rows(t).select("row_id")
    train, test = features.stable_split(rows, ["row_id"])
    parts = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    share = F.avg(1 - F.col("part"))
    return parts.agg(F.lit("all").alias("part"), F.count(F.lit(1)).alias("n"),
                     (F.abs(share - 0.75) < 4 * F.sqrt(F.lit(0.1875) / F.count(F.lit(1)))).alias("near_share"),
                     (F.countDistinct("row_id") == F.count(F.lit(1))).alias("whole"))


@query("m07_random_split")
def _(t):
    train, test = model_rows(t).select("row_id").randomSplit([0.75, 0.25], seed=14)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# Training. The encoded rows are written once and read by every pass of the fit.

def _training_rows(encoded):
    return checkpoint(models.spread(encoded.select("row_id", "features", features.LABEL)))


def _parts(t):
    _, encoded = _encoded(t)
    return features.stable_split(_training_rows(encoded), ["row_id"])


def _metric_frame(t, metrics):
    return t.spark.createDataFrame([(k, float(v)) for k, v in metrics.items()], "metric string, value double")


_REGRESSION = "SELECT * FROM (VALUES ('rmse', true), ('r2', true), ('mse', true), ('mae', true)) v(metric, beats_guess)"
_CLASSES = "SELECT * FROM (VALUES ('accuracy', true), ('f1', true), ('recall', true), ('precision', true)) v(metric, beats_guess)"


def _against_guess(t, metrics, parts):
    """Every metric, and whether it is better than that of the mean or of the most frequent class."""
    label, classes = F.col(features.LABEL), parts[1].groupBy(features.LABEL).count()
    if "rmse" in metrics:
        mean = parts[0].agg(F.avg(label)).first()[0]
        guess = models.regression_metrics(parts[1].select(label, F.lit(mean).alias("prediction")))
    else:
        often = classes.orderBy(F.col("count").desc(), features.LABEL).first()[0]
        guess = models.class_metrics(parts[1].select(label, F.lit(float(often)).alias("prediction")))
    better = [(m, v > guess[m] if m in ("r2", *models.CLASS_METRICS) else v < guess[m]) for m, v in metrics.items()]
    return t.spark.createDataFrame(better, "metric string, beats_guess boolean")


@query("m08_linear_regression", _REGRESSION)
def _(t):
    parts = _parts(t)
    _, metrics, _ = models.train("Linear_Regression", models.linear_regression(), *parts)
    return _against_guess(t, metrics, parts)


@query("m09_tree_regressor", _REGRESSION)
def _(t):
    parts = _parts(t)
    _, metrics, _ = models.train("DecisionTree_Regressor", models.tree_regressor(), *parts)
    return _against_guess(t, metrics, parts)


@query("m10_tree_classifier", _CLASSES)
def _(t):
    parts = _parts(t)
    _, metrics, _ = models.train("DecisionTree_Classifier", models.tree_classifier(), *parts)
    return _against_guess(t, metrics, parts)


@query("m11_random_forest", _CLASSES)
def _(t):
    parts = _parts(t)
    _, metrics, _ = models.train("RandomForest_Classifier", models.random_forest(), *parts)
    return _against_guess(t, metrics, parts)


_GUESS = """
    g AS (SELECT o_orderkey, CAST(1 + o_orderkey % 4 AS DOUBLE) AS label, CAST(1 + (o_orderkey % 4 + CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END) % 4 AS DOUBLE) AS prediction FROM orders)"""


def _guesses(t):
    shift = F.when(F.col("o_custkey") % 5 == 0, 1).otherwise(0)
    return t.orders.select(((F.col("o_orderkey") % 4) + 1).cast("double").alias("label"),
                           ((F.col("o_orderkey") % 4 + shift) % 4 + 1).cast("double").alias("prediction"))


@query("m12_regression_metrics", f"""
    WITH {_GUESS}, e AS (SELECT avg((label - prediction) ** 2) AS mse, avg(abs(label - prediction)) AS mae, var_pop(label) AS v FROM g)
    SELECT 'rmse' AS metric, round(sqrt(mse), 6) AS value FROM e UNION ALL SELECT 'r2', round(1 - mse / v, 6) FROM e
    UNION ALL SELECT 'mse', round(mse, 6) FROM e UNION ALL SELECT 'mae', round(mae, 6) FROM e""")
def _(t):
    return _metric_frame(t, models.regression_metrics(_guesses(t), "label")).withColumn("value", F.round("value", 6))


_CLASS_SQL = f"""
    WITH {_GUESS}, a AS (SELECT label AS c, count(*) AS n, count(*) FILTER (label = prediction) AS hit FROM g GROUP BY 1),
    p AS (SELECT prediction AS c, count(*) AS m FROM g GROUP BY 1),
    x AS (SELECT n, hit, hit / n AS r, coalesce(hit / NULLIF(m, 0), 0) AS p FROM a LEFT JOIN p USING (c))"""


@query("m13_class_metrics", _CLASS_SQL + """
    SELECT 'accuracy' AS metric, round(sum(hit) / sum(n), 6) AS value FROM x UNION ALL SELECT 'f1', round(sum(2 * r * p / (r + p) * n) / sum(n), 6) FROM x
    UNION ALL SELECT 'recall', round(sum(r * n) / sum(n), 6) FROM x UNION ALL SELECT 'precision', round(sum(p * n) / sum(n), 6) FROM x""")
def _(t):
    return _metric_frame(t, models.class_metrics(_guesses(t), "label")).withColumn("value", F.round("value", 6))


@query("m13_class_metrics_one_pass", _CLASS_SQL + """
    SELECT round(sum(hit) / sum(n), 6) AS accuracy, round(sum(2 * r * p / (r + p) * n) / sum(n), 6) AS f1,
      round(sum(r * n) / sum(n), 6) AS recall, round(sum(p * n) / sum(n), 6) AS "precision" FROM x""")
def _(t):
    found = models.metrics_from_counts(_guesses(t), "label")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def _searched(train):
    """(candidates, best, scores) of a search on the training part."""
    candidates = models.draws()
    best, scores, _ = models.random_search(train, candidates)
    return candidates, best, scores


@query("m14_random_search")
def _(t):
    """Every draw from the whole space with its validation accuracy."""
    train, _ = _parts(t)
    candidates, _, scores = _searched(train)
    rows = [(c["numTrees"], c["maxBins"], c["maxDepth"], float(s)) for c, s in zip(candidates, scores)]
    return t.spark.createDataFrame(rows, "num_trees int, max_bins int, max_depth int, accuracy double")


@query("m15_refit_best")
def _(t):
    """Search on the training part, refit, report on the untouched test part as a run record."""
    train, test = _parts(t)
    _, best, _ = _searched(train)
    runs = models.RunLog(t.spark, workspace(t.spark, "runs"))
    models.train("RandomForest_Classifier", models.random_forest(**best), train, test, runs)
    return models.metric_rows(runs.table()).select("name", "metric", "value")


_SCORED = "SELECT o_orderkey AS row_id, true AS known_class FROM orders"


@query("m16_saved_models", """
    SELECT name, n, true AS same FROM (VALUES ('encoder'), ('linear'), ('tree'), ('forest')) v(name), (SELECT count(*) AS n FROM orders)""")
def _(t):
    """Models of four classes saved and loaded again by the class their files name; every row is predicted as before."""
    encoder, encoded = _encoded(t, "keep")
    rows = _training_rows(encoded)
    plain = features.feature_table(model_rows(t))

    def compared(name, model, rows, column):
        loaded = models.load_model(t.spark, models.save_model(model, workspace(t.spark, name)))
        before = model.transform(rows).select("row_id", F.col(column).alias("before"))
        after = loaded.transform(rows).select("row_id", F.col(column).alias("after"))
        return before.join(after, "row_id").agg(
            F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.bool_and(F.col("before").eqNullSafe(F.col("after"))).alias("same"))

    found = [compared("encoder", encoder, plain, "features")]
    for name, estimator in (("linear", models.linear_regression()), ("tree", models.tree_classifier(minInstancesPerNode=20)),
                            ("forest", models.random_forest(numTrees=5))):
        found.append(compared(name, estimator.fit(rows), rows, "prediction"))
    return union_by_name(found)


@query("m17_saved_model_scoring", _SCORED)
def _(t):
    """Encoder and model are saved, loaded again and used on rows without label."""
    encoder, encoded = _encoded(t, "keep")
    rows = _training_rows(encoded)
    model = models.numbered(models.random_forest(), rows).fit(rows)
    encoder_path, model_path = models.save_model(encoder, workspace(t.spark, "encoder")), models.save_model(model, workspace(t.spark, "model"))
    fresh = features.feature_table(model_rows(t)).drop(features.LABEL)
    scored = models.prediction_table(models.score(model_path, fresh, encoder_path), ["row_id"])
    return scored.select("row_id", F.col("prediction").isin(1.0, 2.0, 3.0, 4.0).alias("known_class"))


@query("m17_streaming_scoring", _SCORED)
def _(t):
    """The same model on a stream of files, with the file sink."""
    encoder, encoded = _encoded(t, "keep")
    rows = _training_rows(encoded)
    model = models.numbered(models.random_forest(), rows).fit(rows)
    encoder_path, model_path = models.save_model(encoder, workspace(t.spark, "encoder")), models.save_model(model, workspace(t.spark, "model"))
    landed = workspace(t.spark, "fresh")
    features.feature_table(model_rows(t)).drop(features.LABEL).write.parquet(landed)
    scored = models.score(model_path, jobs.file_stream(t.spark, landed), encoder_path)
    return jobs.drain_append(scored.select("row_id", F.col("prediction").isin(1.0, 2.0, 3.0, 4.0).alias("known_class")))


@query("m18_prediction_sink")
def _(t):
    train, test = _parts(t)
    _, _, predictions = models.train("DecisionTree_Classifier", models.tree_classifier(minInstancesPerNode=20), train, test)
    path = workspace(t.spark, "predictions")
    models.prediction_table(predictions, ["row_id", features.LABEL]).write.parquet(path)
    return t.spark.read.parquet(path).select("row_id", "rank_class", "prediction", F.size("probability").alias("n_classes"))


def _run_rows(t):
    """Run records made of the events: type as name, value as metric."""
    return t.events.select(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_type").alias("name"), F.col("ts").alias("start_time"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        F.create_map(F.lit("value"), F.col("value"), F.lit("half"), F.col("value") / 2).alias("metrics"))


@query("m19_run_records", """
    SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS name, CAST(user_id AS VARCHAR) AS "user", value FROM events""")
def _(t):
    """Records are appended to the run table and read back."""
    path = workspace(t.spark, "runs")
    _run_rows(t).write.mode("append").parquet(path)
    runs = t.spark.read.parquet(path)
    return runs.select("run_id", "name", F.col("params")["user"].alias("user"), F.col("metrics")["value"].alias("value"))


@query("m20_latest_run", """
    SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS name, m.metric, CASE m.metric WHEN 'value' THEN value ELSE value / 2 END AS value
    FROM (SELECT * FROM events ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 1), (VALUES ('value'), ('half')) m(metric)""")
def _(t):
    return models.metric_rows(models.latest_run(_run_rows(t)))


@query("m20_search_runs", """
    SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS name, value, CAST(row_number() OVER (ORDER BY value DESC, ts) AS BIGINT) AS place
    FROM events WHERE event_type IN ('view', 'click') AND value > 50""")
def _(t):
    """Runs of two names with a metric above a bound, the best first."""
    value = F.col("metrics")["value"]
    found = models.search_runs(_run_rows(t), F.col("name").isin("view", "click") & (value > 50), [value.desc(), "start_time"])
    listed = found.select("run_id", "name", value.alias("value"), "start_time")
    return scan.dense_ids(listed, [F.col("value").desc(), "start_time"], "place").drop("start_time")


@query("m20_wide_metrics", """
    SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS name, value, value / 2 AS half FROM events""")
def _(t):
    return models.wide_metrics(_run_rows(t), ["value", "half"])


@query("m21_registered_versions", """
    SELECT event_type AS name, n.version, r.r_name AS loaded FROM (SELECT DISTINCT event_type FROM events) e, (VALUES (1), (2)) n(version),
      region r WHERE r.r_regionkey = n.version""")
def _(t):
    """A scaler per kind of event is registered twice and every version is loaded again.

    The versions differ in the region name their column is called by.
    """
    registry = models.Registry(t.spark, workspace(t.spark, "registry"))
    names = [r["event_type"] for r in small_rows(t.events.select("event_type").distinct(), 100)]
    regions = {r["r_regionkey"]: r["r_name"] for r in small_rows(t.region.where("r_regionkey IN (1, 2)"), 2)}
    for version in (1, 2):
        stage = VectorAssembler(inputCols=["value"], outputCol=regions[version])
        path = models.save_model(Pipeline(stages=[stage]).fit(t.events), workspace(t.spark, "stage"))
        for name in names:
            registry.register(name, path)
    rows = [(r["name"], r["version"], registry.load(r["name"], r["version"]).stages[0].getOutputCol()) for r in small_rows(registry.versions(), 1000)]
    return t.spark.createDataFrame(rows, "name string, version int, loaded string")


@query("m21_versions_on_events", """
    SELECT event_type, v.version, CAST(CASE WHEN v.version = 1 THEN CASE WHEN value < 50 THEN 0 ELSE 1 END
      ELSE CASE WHEN value < 25 THEN 0 WHEN value < 75 THEN 1 ELSE 2 END END AS DOUBLE) AS bucket, count(*) AS n
    FROM events, (VALUES (1::BIGINT), (2::BIGINT)) v(version) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2, 3""")
def _(t):
    """Two registered versions of a model, each loaded from the registry and used on all events."""
    registry = models.Registry(t.spark, workspace(t.spark, "registry"))
    infinity = float("inf")
    for splits in ([-infinity, 50.0, infinity], [-infinity, 25.0, 75.0, infinity]):
        stage = Bucketizer(splits=splits, inputCol="value", outputCol="bucket")
        registry.register("bands", models.save_model(Pipeline(stages=[stage]).fit(t.events), workspace(t.spark, "stage")))
    known = t.events.where("value IS NOT NULL AND NOT isnan(value)").select("event_type", "value")
    outputs = [registry.load("bands", v).transform(known).withColumn("version", F.lit(v).cast("long")) for v in (1, 2)]
    return union_by_name(outputs).groupBy("event_type", "version", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("c08_train_and_score", """
    WITH n AS (SELECT count(*) AS n FROM orders)
    SELECT * FROM (VALUES ('Linear_Regression', 4, true), ('DecisionTree_Regressor', 4, true), ('DecisionTree_Classifier', 4, true),
      ('RandomForest_Classifier', 4, true), ('RandomForest_Best', 4, true)) v(name, n_metrics, beats_guess),
      (SELECT n AS n_scored FROM n), (SELECT 1::BIGINT AS version)""")
def _(t):
    """Encode, split, train four models, search and refit, record every run, save, register, load and score all rows.

    One row per run: its number of metrics, whether it beats guessing (the mean,
    or the most frequent class), and the rows the registered best model scored.
    """
    encoder, encoded = _encoded(t, "keep")
    train, test = features.stable_split(_training_rows(encoded), ["row_id"])
    runs = models.RunLog(t.spark, workspace(t.spark, "runs"))
    kinds = {"Linear_Regression": models.linear_regression(), "DecisionTree_Regressor": models.tree_regressor(),
             "DecisionTree_Classifier": models.tree_classifier(), "RandomForest_Classifier": models.random_forest()}
    for name, estimator in kinds.items():
        models.train(name, estimator, train, test, runs)
    _, best, _ = _searched(train)
    model, _, _ = models.train("RandomForest_Best", models.random_forest(**best), train, test, runs)
    registry = models.Registry(t.spark, workspace(t.spark, "registry"))
    version = registry.register("rank_class", models.save_model(model, workspace(t.spark, "model")))
    registry.register("encoder", models.save_model(encoder, workspace(t.spark, "encoder")))
    fresh = models.dealt(features.feature_table(model_rows(t)).drop(features.LABEL))
    scored = registry.load("rank_class").transform(registry.load("encoder").transform(fresh)).where(F.col("prediction").isNotNull()).count()
    parts = test.groupBy(features.LABEL).count()
    guess = parts.agg((F.max("count") / F.sum("count"))).first()[0]
    value = F.col("metrics")
    beats = F.coalesce(value["accuracy"] > guess, value["r2"] > 0)
    return runs.table().select("name", F.size("metrics").alias("n_metrics"), beats.alias("beats_guess"),
                               F.lit(scored).cast("long").alias("n_scored"), F.lit(version).cast("long").alias("version"))


# Clustering, classification and factorisation.

@query("e11_nearest_centre", """
    WITH c AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
               FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY 1)
    SELECT vec_id, arg_min(c.label, list_sum(list_transform(range(1, 65), lambda i: (CAST(embedding[i] AS DOUBLE) - centre[i]) ** 2))) AS cluster
    FROM embeddings, c GROUP BY 1""")
def _(t):
    """One step of k-means: the mean of every label is a centre, each vector takes the nearest."""
    means = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(
        F.avg(F.col("x").cast("double")).alias("m"))
    centres = means.groupBy(F.col("label").alias("name")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda e: e["m"]).alias("centre"))
    return iterative.with_nearest(t.embeddings.select("vec_id", "embedding"), centres).select("vec_id", "cluster")


def _k_means_sql(k, rounds):
    ctes = ["x AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: CAST(e AS DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL)",
            f"c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, v AS c FROM x ORDER BY vec_id LIMIT {k})"]
    near = "a{0} AS MATERIALIZED (SELECT vec_id, arg_min(cluster, (list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) ** 2)), cluster)) AS cluster FROM x, c{0} GROUP BY vec_id)"
    for i in range(rounds):
        ctes.append(near.format(i))
        ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
      SELECT cluster, list(m ORDER BY p) AS c FROM (SELECT cluster, p, avg(e) AS m FROM (
        SELECT cluster, unnest(v) AS e, generate_subscripts(v, 1) AS p FROM x JOIN a{i} USING (vec_id)) GROUP BY 1, 2) GROUP BY 1) m USING (cluster))""")
    return f"WITH {', '.join([*ctes, near.format(rounds)])} SELECT CAST(cluster AS INT) AS cluster, count(*) AS n FROM a{rounds} GROUP BY 1"


@query("e11_k_means_rounds", _k_means_sql(10, 3))
def _(t):
    """Three rounds from the ten vectors of the smallest ids, and the vectors of every cluster."""
    centres, _ = iterative.k_means(t.embeddings, 10, "vec_id", rounds=3, seed=None)
    known = t.embeddings.where("embedding IS NOT NULL").select("embedding")
    return iterative.with_nearest(known, centres).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("e11_k_means")
def _(t):
    """Clusters from a seeded start until the centres stay where they are."""
    centres, _ = iterative.k_means(t.embeddings, 10, "vec_id", max_rounds=ROUNDS)
    known = t.embeddings.where("embedding IS NOT NULL").select("embedding")
    return iterative.with_nearest(known, centres, name="prediction").groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("e12_batch_gradient", """
    SELECT CAST(r AS INT) AS round, count(*) AS n, true AS falls FROM documents JOIN labels USING (doc_id), range(1, 31) g(r)
    WHERE text IS NOT NULL AND n_chars IS NOT NULL AND quality IS NOT NULL GROUP BY 1""")
def _(t):
    """Thirty rounds of batch gradients on the quality label: the mean loss falls in every one."""
    words = F.split("text", " ")
    short = F.size(F.filter(words, lambda w: F.length(w) < 4)) / F.size(words)
    rows = t.documents.where("text IS NOT NULL").join(t.labels, "doc_id").select(
        (F.log1p("n_chars") / 10).alias("size"), short.alias("short"), "quality")
    _, losses = iterative.logistic_descent(rows, ["size", "short"], "quality", rounds=30)
    n = rows.dropna().count()
    found = [(i + 1, n, i == 0 or b < losses[i - 1]) for i, b in enumerate(losses)]
    return t.spark.createDataFrame(found, "round int, n long, falls boolean")


@query("e12_logistic_regression")
def _(t):
    """Quality label of a document from its length and the share of short words."""
    words = F.split("text", " ")
    short = F.size(F.filter(words, lambda w: F.length(w) < 4)) / F.size(words)
    rows = t.documents.join(t.labels, "doc_id").select("doc_id", F.log1p("n_chars").alias("size"), short.alias("short"), F.col("quality").alias("label"))
    stages = [VectorAssembler(inputCols=["size", "short"], outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True),
              LogisticRegression(maxIter=ROUNDS)]
    fitted = Pipeline(stages=stages).fit(rows)
    if fitted.stages[-1].summary.totalIterations >= ROUNDS:
        raise RuntimeError(f"the weights still move after {ROUNDS} rounds")
    scored = models.reloaded(t.spark, fitted, workspace(t.spark, "logistic")).transform(rows)
    return scored.select("doc_id", "label", "prediction")


def _ratings(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(F.avg("l_quantity").alias("rating"))


@query("e13_factorisation")
def _(t):
    """Customers and parts with the mean quantity as rating; predictions for the known pairs, once the error falls no more."""
    ratings = checkpoint(_ratings(t))
    users, items, _ = iterative.factorise(ratings)
    return iterative.predicted(ratings, users, items).select("user", "item", F.round("prediction", 3).alias("prediction"))


@query("e13_error", """
    SELECT count(*) AS n, true AS falls, true AS better FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def _(t):
    """The error falls from the first round to the last, and is below that of guessing the mean."""
    ratings = checkpoint(_ratings(t))
    users, items, errors = iterative.factorise(ratings)
    off = F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2))
    return iterative.predicted(ratings, users, items).agg(
        F.count(F.lit(1)).alias("n"), F.lit(errors[-1] < errors[0] if errors else None).alias("falls"),
        (off < F.stddev_pop("rating")).alias("better"))


# Single feature transformers.

@query("m22_bucketizer", """
    SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 150000 THEN 1 WHEN o_totalprice < 300000 THEN 2 ELSE 3 END AS DOUBLE) AS bucket FROM orders""")
def _(t):
    splits = [float("-inf"), 50000.0, 150000.0, 300000.0, float("inf")]
    return Bucketizer(splits=splits, inputCol="o_totalprice", outputCol="bucket").transform(t.orders).select("o_orderkey", "bucket")


@query("m22_quantile_buckets")
def _(t):
    fitted = QuantileDiscretizer(numBuckets=4, inputCol="o_totalprice", outputCol="bucket").fit(t.orders)
    return fitted.transform(t.orders).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("m22_standard_scale", """
    SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS price FROM orders, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders)""")
def _(t):
    stages = [VectorAssembler(inputCols=["o_totalprice"], outputCol="v"), StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True)]
    scaled = Pipeline(stages=stages).fit(t.orders).transform(t.orders)
    return scaled.select("o_orderkey", F.round(vector_to_array("s")[0], 6).alias("price"))


@query("m22_correlation_matrix", """
    SELECT round(corr(l_quantity, l_extendedprice), 6) AS quantity_price, round(corr(l_quantity, l_discount), 6) AS quantity_discount,
      round(corr(l_discount, l_tax), 6) AS discount_tax FROM lineitem""")
def _(t):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(t.lineitem)
    m = Correlation.corr(vectors, "v").first()[0].toArray()
    row = [(round(float(m[0][1]), 6), round(float(m[0][2]), 6), round(float(m[2][3]), 6))]
    return t.spark.createDataFrame(row, "quantity_price double, quantity_discount double, discount_tax double")
