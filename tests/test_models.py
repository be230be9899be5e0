from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from strata.operators import features, models, sampling
from strata.plans import clustering, training
from strata.runtime import scratch_path
from strata.sources import load_model, save_model, write_table
from strata.streaming import read_stream, score_stream


@pytest.fixture(scope="module")
def rows(spark):
    """A label that follows x and grade, with a little noise from the row number."""
    df = spark.range(1200).select(
        F.col("id"),
        ((F.col("id") * 37) % 101).cast("double").alias("x"),
        F.when(F.col("id") % 17 != 0, (F.col("id") % 7).cast("double")).alias("y"),
        F.concat(F.lit("g"), (F.col("id") % 5).cast("string")).alias("grade"),
    )
    flag = F.when((F.col("x") + 10 * (F.col("id") % 5) + F.col("id") % 13) > 80, 1).otherwise(0)
    out = df.withColumn("label", flag).withColumn("status", F.when(flag == 1, "bad").otherwise("good")).persist()
    yield out
    out.unpersist()


@pytest.fixture(scope="module")
def data(rows):
    train, test = sampling.stratified_split(rows, "label", 0.2, 1, "id")
    out = training.prepare_training(train, test, "label", "id", exclude=["status"])
    yield out
    out.release()


def test_sizes_of_one_hot_vectors(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    sizes = {
        (drop, keep): features.vector_width(
            features.fit_encoder(df, [], ["s"], drop_last=drop, keep_invalid=keep).transform(df)
        )
        for drop in (True, False)
        for keep in (True, False)
    }
    assert sizes == {(True, False): 3, (True, True): 4, (False, False): 4, (False, True): 5}


def test_slots_map_back_to_sources(data, rows):
    full = features.complete_features(rows, ["x", "y"], ["grade"])
    slots = features.feature_slots(data.encoder.transform(full))
    assert [s[0] for s in slots] == list(range(data.n_features))
    assert {s[2] for s in slots} == {"x", "y", "grade"}
    assert [s[2] for s in slots].count("grade") == 6


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "x double")
    assert {r["x_std"] for r in features.standardize(df, ["x"]).collect()} == {0.0}


def test_cardinality_guard(spark):
    with pytest.raises(ValueError):
        features.check_cardinality(spark.range(100).selectExpr("cast(id as string) as s"), ["s"], max_labels=10)


@pytest.mark.parametrize(
    "name,params",
    [
        ("LogisticRegression", {"maxIter": 10}),
        ("DecisionTree", {}),
        ("RandomForest", {"numTrees": 5}),
        ("GBT", {"maxIter": 3}),
        ("MLP", {"maxIter": 20, "hidden": None}),
    ],
)
def test_every_classifier_learns(data, name, params):
    model = training.train_one(data, name, **params)
    got = {r["metric"]: r["value"] for r in training.evaluate_one(data, model, name).collect()}
    assert len(got) == 18
    assert all(0 <= v <= 1 for v in got.values())
    assert got["val_auc"] > (0.5 if name == "MLP" else 0.85)


def test_grid_search_reports_its_best_setting(data):
    model = training.train_one(data, "RandomForest", {"maxDepth": [1, 5], "numTrees": [3]}, folds=2)
    got = {r["param"]: r["value"] for r in models.best_params(data.train, model, ["maxDepth", "numTrees"]).collect()}
    assert got == {"maxDepth": 5.0, "numTrees": 3.0}


def test_all_models_are_logged_stored_and_compared(spark, data):
    log, stored = scratch_path(spark, "log"), scratch_path(spark, "stored")
    specs = {"DecisionTree": {"maxDepth": 1}, "RandomForest": {"numTrees": 5}}
    rows = {r["model"]: r for r in training.train_all(data, specs, log, stored).collect()}
    assert set(rows) == set(specs) and [m for m in rows if rows[m]["best"]] == ["RandomForest"]
    (forest,) = Path(stored.removeprefix("file:")).glob("RandomForest-*")
    assert load_model(str(forest)).stages[-1].getNumTrees == 5
    again = {r["model"]: r for r in training.train_all(data, specs, log, stored).collect()}
    assert sorted(again) == sorted(rows) and len(list(Path(stored.removeprefix("file:")).glob("RandomForest-*"))) == 2


def test_folds_of_ours_drive_the_search(rows):
    full = features.complete_features(rows, ["x", "y"], ["grade"])
    folded = sampling.stratified_kfolds(full, "label", 2, 1, "id")
    tree = models.classifier("DecisionTree", "label")
    stages = [*features.encoder_stages(["x", "y"], ["grade"]), tree]
    fitted = models.grid_search(folded, stages, {"maxDepth": [1, 4]}, "label", 2, fold_col="fold")
    assert len(fitted.avgMetrics) == 2 and fitted.avgMetrics[1] > fitted.avgMetrics[0]
    assert models.kfold_scores(folded, stages, 2, "label").groupBy("fold").count().count() == 2


def test_importance_sums_to_one_and_ranks_the_signal(data, rows):
    model = training.train_one(data, "RandomForest", numTrees=5)
    full = features.complete_features(rows, ["x", "y"], ["grade"])
    got = models.feature_importance(model, full).collect()
    assert sum(r["importance"] for r in got) == pytest.approx(1.0)
    assert got[0]["feature"] == "x" and {r["feature"] for r in got} == {"x", "y", "grade"}
    slots = models.feature_importance(model, full, by_source=False)
    assert slots.count() == data.n_features


def test_learning_curve(rows):
    full = features.complete_features(rows, ["x", "y"], ["grade"])
    train, val = sampling.split_by_sample(full, 0.3, 1, "id")
    stages = [*features.encoder_stages(["x", "y"], ["grade"]), models.classifier("DecisionTree", "label")]
    got = models.learning_curve(train, val, stages, [0.3, 1.0], "label", "id")
    assert got.select("fraction", "split").distinct().count() == 4 and got.count() == 24


def test_stored_model_scores_alike_in_batch_and_stream(spark, rows):
    full = features.complete_features(rows, ["x", "y"], ["grade"])
    forest = models.classifier("RandomForest", "label", numTrees=3)
    model = Pipeline(stages=[*features.encoder_stages(["x", "y"], ["grade"]), forest]).fit(full)
    want = sorted(models.score(model, full, ["id"]).collect())
    stored = load_model(save_model(model, scratch_path(spark, "m")))
    assert sorted(models.score(stored, full, ["id"]).collect()) == want
    inbox, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    write_table(full.filter("id < 700"), inbox, files=3)
    score_stream(read_stream(spark, inbox, full.schema), stored, ["id"], out, progress).awaitTermination()
    write_table(full.filter("id >= 700"), inbox, mode="append")
    score_stream(read_stream(spark, inbox, full.schema), stored, ["id"], out, progress).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == want


def test_segments(rows):
    model, full = clustering.fit_segments(rows, k=4, exclude=["id", "label", "status"])
    row = models.cluster_quality(model, full).first()
    assert row["k"] == 4 and row["n_rows"] == 1200 and row["inertia"] > 0 and -1 <= row["silhouette"] <= 1
    mixture, _ = clustering.fit_segments(rows.select("id", "x", "y"), k=2, exclude=["id"], method="gmm", maxIter=5)
    assert mixture.transform(full).select("cluster").distinct().count() <= 2


def test_pca_is_centred(spark):
    df = spark.createDataFrame([([float(i), 2.0 * i + 100, 5.0],) for i in range(50)], "v array<double>")
    vec = features.array_to_features(df, "v", 3)
    out = features.pca(vec, k=2)
    total = [sum(r["pca"][i] for r in out.collect()) for i in range(2)]
    assert total == pytest.approx([0.0, 0.0], abs=1e-6)
