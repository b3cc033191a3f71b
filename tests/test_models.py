import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from paddock.functions import udfs as U
from paddock.ml import features, models
from paddock.session import workspace


@pytest.fixture(scope="module")
def table(spark):
    raw = spark.range(300).select(
        "id", F.element_at(F.array(F.lit("sc"), F.lit("xf"), F.lit("cw")), (F.col("id") % 3 + 1).cast("int")).alias("series"),
        F.when(F.col("id") % 5 == 0, "F").otherwise("M").alias("gender"), F.concat(F.lit("c"), F.col("id") % 4).alias("country"),
        F.lit("1990-05-06").cast("date").alias("birthday"), (2000 + F.col("id") % 20).cast("int").alias("rookie_year"),
        (F.col("id") % 60).cast("int").alias("rank"), (F.col("id") % 4).cast("int").alias("dnf"), (F.col("id") % 5).cast("int").alias("top_20"),
        (F.col("id") % 60).cast("int").alias("top_5"), F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(4.0).alias("chase_bonus"),
        F.lit(None).cast("double").alias("chase_wins"), F.lit(None).cast("double").alias("chase_stage_wins"),
        *[(F.col("id") % n).cast("double").alias(c) for n, c in ((60, "avg_start_position"), (7, "avg_finish_position"), (11, "avg_laps_completed"), (13, "laps_led_pct"))])
    return features.feature_table(raw).cache()


def test_feature_table(table):
    row = table.where("id = 0").first()
    assert (row.age, row.experience, row.DNF_ratio, row.rank_class, row.chase_bonus) == (32, 22, 0.0, 1, 2.0)
    assert not {"chase_wins", "rank", "birthday", "dnf"} & set(table.columns)


def test_constant_column_scales_to_one_half(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="v"), MinMaxScaler(inputCol="v", outputCol="s")]
    rows = Pipeline(stages=stages).fit(df).transform(df).select(vector_to_array("s").alias("s")).collect()
    assert [r.s for r in rows] == [[0.0, 0.5], [1.0, 0.5]]


def test_vector_has_one_hot_and_scaled_numbers(table):
    encoded = features.encoder(invalid="error").fit(table).transform(table)
    assert len(encoded.select("features").first().features) == 2 + 1 + 3 + 9


def test_split_does_not_depend_on_partitions(table):
    a, b = features.stable_split(table, ["id"])
    c, _ = features.stable_split(table.repartition(7), ["id"])
    assert {r.id for r in a.collect()} == {r.id for r in c.collect()} and a.count() + b.count() == 300
    assert 190 < a.count() < 260


def test_draws_are_whole_numbers_in_range_and_repeatable():
    first = models.draws()
    assert first == models.draws() and len(first) == models.TRIALS
    assert all(50 <= d["numTrees"] < 500 and 2 <= d["maxBins"] < 32 and 2 <= d["maxDepth"] < 20 for d in first)


def test_train_search_record_and_score(spark, table):
    encoder = features.encoder().fit(table)
    encoded = encoder.transform(table)
    train, test = features.stable_split(encoded, ["id"])
    runs = models.RunLog(spark, workspace(spark, "runs"))
    best, scores, model = models.random_search(train, [{"numTrees": 3, "maxDepth": 1, "maxBins": 4}, {"numTrees": 10, "maxDepth": 8, "maxBins": 32}])
    assert best["maxDepth"] == 8 and scores[1] >= scores[0]
    model, metrics, predictions = models.train("forest", models.random_forest(**best), train, test, runs)
    one_pass = models.metrics_from_counts(predictions).first()
    assert all(math.isclose(metrics[m], one_pass[m], rel_tol=1e-9) for m in metrics)
    models.train("linear", models.linear_regression(), train, test, runs)
    assert models.latest_run(runs.table()).first().name == "linear"
    wide = {r.name: r for r in models.wide_metrics(runs.table(), ["accuracy", "rmse"]).collect()}
    assert wide["forest"].accuracy == metrics["accuracy"] and wide["forest"].rmse is None and wide["linear"].rmse is not None
    paths = models.save_model(model, workspace(spark, "model")), models.save_model(encoder, workspace(spark, "encoder"))
    unseen = table.limit(1).withColumn("country", F.lit("nowhere")).drop(features.LABEL)
    assert models.score(paths[0], unseen, paths[1]).count() == 1


def test_registry_keeps_versions_and_loads_any_model(spark, table):
    registry = models.Registry(spark, workspace(spark, "registry"))
    assert registry.versions().count() == 0
    encoder = features.encoder().fit(table)
    encoded = encoder.transform(table)
    kinds = {"forest": models.random_forest(numTrees=3), "tree": models.tree_classifier(minInstancesPerNode=1),
             "linear": models.linear_regression(), "tree_regressor": models.tree_regressor(minInstancesPerNode=1)}
    for name, estimator in kinds.items():
        fitted = estimator.fit(encoded)
        path = models.save_model(fitted, workspace(spark, name))
        assert registry.register(name, path, "run") == 1
        assert type(registry.load(name)) is type(fitted)
    other = models.save_model(models.tree_classifier(maxDepth=1).fit(encoded), workspace(spark, "second"))
    assert registry.register("tree", other) == 2 and registry.load("tree").depth <= 1 < registry.load("tree", 1).depth
    assert registry.register("encoder", models.save_model(encoder, workspace(spark, "encoder"))) == 1
    assert len(registry.load("encoder").stages) == 5
    with pytest.raises(LookupError):
        registry.load("tree", 3)


def test_runs_are_searched_and_ordered(spark):
    runs = models.RunLog(spark, workspace(spark, "runs"))
    for name, value in (("a", 0.5), ("b", 0.9), ("a", 0.7)):
        runs.record(name, {"p": name}, {"accuracy": value})
    best = models.search_runs(runs.table(), F.col("metrics")["accuracy"] > 0.6, [F.col("metrics")["accuracy"].desc()])
    assert [r["metrics"]["accuracy"] for r in best.collect()] == [0.9, 0.7]
    assert [r["metrics"]["accuracy"] for r in models.search_runs(runs.table(), "name = 'a'").collect()] == [0.7, 0.5]


def test_rms_in_pieces_and_custom_average(spark):
    df = spark.range(0, 1000, numPartitions=4).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    want = {r.k: r.m for r in df.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    squares = {r.k: r.m for r in df.groupBy("k").agg(F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("m")).collect()}
    pieces = {r.k: r["rms"] for r in U.rms_in_pieces(df, ["k"], "v", 100).collect()}
    custom = {r.k: r.average for r in U.custom_average(df, "k", "v").collect()}
    assert all(math.isclose(pieces[k], squares[k]) and math.isclose(custom[k], want[k]) for k in want)


def test_two_classes_are_scored_after_an_observation(spark, tmp_path):
    from paddock.queries import load, registry
    load()
    texts = [(i, ("a bc " if i % 3 else "longer words ") * (i + 1), (i + 1) * 5, i % 2) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, n_chars long, quality int")
    docs.drop("quality").write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", "quality").write.parquet(f"{tmp_path}/labels.parquet")
    # An observation stays with the session, which then cannot be sent to a task.
    docs.observe(Observation("seen"), F.count(F.lit(1)).alias("n")).collect()
    scored = registry.QUERIES["e12_logistic_regression"](spark, str(tmp_path)).collect()
    assert len(scored) == 40 and {r.prediction for r in scored} <= {0.0, 1.0}


def test_rows_of_a_fit_are_spread_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(0, 1000, 1, 1), spark.range(0, 1000, 1, cores + 3)
    spread = models.spread(few)
    assert spread.rdd.getNumPartitions() == cores and models.spread(many).rdd.getNumPartitions() == cores + 3
    assert sorted(r.id for r in spread.collect()) == list(range(1000))
    assert min(spread.rdd.glom().map(len).collect()) > 0


def test_forests_keep_node_numbers_within_bounds_and_grow_the_same_trees(spark, table, monkeypatch):
    rows = features.encoder().fit(table).transform(table).cache()
    plain = models.random_forest(numTrees=6)
    kept = models.numbered(plain, rows)
    assert kept.getCacheNodeIds() and not plain.getCacheNodeIds()
    grown = [f.fit(rows).toDebugString.partition("\n")[2] for f in (plain, kept)]
    assert grown[0] == grown[1]
    assert models.numbered(models.tree_classifier(), rows).getCacheNodeIds() is False
    monkeypatch.setattr(models, "NODE_ID_BYTES", 4 * rows.count() * 6)
    assert models.numbered(plain, rows).getCacheNodeIds() and not models.numbered(plain, rows, 7).getCacheNodeIds()


def test_rows_to_score_are_dealt_over_the_tasks(spark, table):
    encoder = features.encoder().fit(table)
    model = models.tree_classifier(minInstancesPerNode=1).fit(encoder.transform(table))
    paths = models.save_model(model, workspace(spark, "model")), models.save_model(encoder, workspace(spark, "encoder"))
    fresh = table.drop(features.LABEL).coalesce(1)
    scored = models.score(paths[0], fresh, paths[1])
    assert scored.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plain = model.transform(encoder.transform(fresh))
    assert sorted(scored.select("id", "prediction").collect()) == sorted(plain.select("id", "prediction").collect())
