"""Training, tuning, scoring and clustering on the loan view and the embeddings.

These end in fitted models, so there is no SQL to compare with; the tests check them
against properties instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import audit, evaluate, features, models, sampling
from strata.plans import clustering, training
from strata.plans.catalog.registry import query
from strata.plans.catalog.sampling import RANKED_SQL
from strata.plans.loan_view import LABEL_SOURCES, LOAN_VIEW_SQL, loan_view, table
from strata.runtime import compact, pin, scratch_path
from strata.sources import load_model, save_model, write_table
from strata.streaming import read_stream, score_stream

LABEL = "default_flag"
KEY = "loan_id"
NUMERIC = ["loan_amnt", "int_rate", "annual_inc", "dti"]
CATEGORICAL = ["grade", "home_ownership"]


def model_table(spark, sf):
    """Typed features of the loan view, its label and key."""
    lv = loan_view(spark, sf).withColumn("int_rate", F.regexp_replace("int_rate", "%", "").try_cast("double"))
    return lv.select(KEY, LABEL, *LABEL_SOURCES, *NUMERIC, *CATEGORICAL)


def prepared(spark, sf):
    rows = model_table(spark, sf).persist()
    try:
        train, test = sampling.stratified_split(rows, ["grade", "loan_status"], 0.2, 42, KEY)
        return training.prepare_training(train, test, LABEL, KEY, exclude=LABEL_SOURCES)
    finally:
        rows.unpersist()


def _fit_and_evaluate(spark, sf, name, grid=None, folds=3, **params):
    data = prepared(spark, sf)
    try:
        model = training.train_one(data, name, grid, folds, **params)
        # Metric rows are few; stored, they outlive the persisted frames.
        return pin(training.evaluate_one(data, model, name))
    finally:
        data.release()


@query()
def lr_fit(spark, sf):
    return _fit_and_evaluate(spark, sf, "LogisticRegression", maxIter=20)


@query()
def dt_fit(spark, sf):
    return _fit_and_evaluate(spark, sf, "DecisionTree")


@query()
def rf_fit(spark, sf):
    return _fit_and_evaluate(spark, sf, "RandomForest")


@query()
def gbt_fit(spark, sf):
    return _fit_and_evaluate(spark, sf, "GBT")


@query()
def mlp_fit(spark, sf):
    return _fit_and_evaluate(spark, sf, "MLP")


@query()
def cv_grid(spark, sf):
    """Both tuned ensembles over their full grids, 3 folds, on all training rows."""
    data = prepared(spark, sf)
    try:
        runs = [training.evaluate_one(data, training.train_one(data, name, grid), name) for name, grid in models.GRIDS.items()]
        return pin(reduce(DataFrame.unionByName, runs))
    finally:
        data.release()


@query()
def best_params(spark, sf):
    """(model, param, value) of the winner of each full grid."""
    data = prepared(spark, sf)
    try:
        won = [
            models.best_params(data.train, training.train_one(data, name, grid), list(grid)).select(F.lit(name).alias("model"), "*")
            for name, grid in models.GRIDS.items()
        ]
        return pin(reduce(DataFrame.unionByName, won))
    finally:
        data.release()


@query()
def train_and_compare(spark, sf):
    """Several models trained, logged and stored; the comparison with the winner marked."""
    data = prepared(spark, sf)
    tuned = {name: {"grid": grid} for name, grid in models.GRIDS.items()}
    specs = {"DecisionTree": {}, "LogisticRegression": {}, **tuned, "MLP": {}}
    try:
        return training.train_all(data, specs, scratch_path(spark, "log"), scratch_path(spark, "models"))
    finally:
        data.release()


def _complete(spark, sf):
    return features.complete_features(model_table(spark, sf), NUMERIC, CATEGORICAL)


def _stages(estimator):
    return [*features.encoder_stages(NUMERIC, CATEGORICAL), estimator]


@query()
def kfold_scores(spark, sf):
    folded = sampling.stratified_kfolds(_complete(spark, sf), ["grade", "loan_status"], 5, 42, KEY).persist()
    try:
        gbt = models.classifier("GBT", LABEL)
        return pin(models.kfold_scores(folded, _stages(gbt), 5, LABEL))
    finally:
        folded.unpersist()


@query(
    RANKED_SQL
    + """
SELECT CAST((r - 1) * 5 // n AS INTEGER) AS fold, count(*) AS n_rows, TRUE AS in_range, TRUE AS same_area
FROM ranked GROUP BY 1"""
)
def kfold_audit(spark, sf):
    """Every row is scored once, in its own fold, and the reported area equals the one from ranks."""
    folded = sampling.stratified_kfolds(_complete(spark, sf), ["grade", "loan_status"], 5, 42, KEY).persist()
    try:
        scored = models.kfold_predictions(folded, _stages(models.classifier("LogisticRegression", LABEL)), 5, LABEL)
    finally:
        folded.unpersist()
    reported = evaluate.roc_auc(scored, "label", "score", by="fold")
    both = reported.join(audit.rank_auc(scored, "label", "score", by="fold"), "fold")
    same = both.select("fold", F.coalesce(F.abs(F.col("auc") - F.col("rank_auc")) < 1e-9, F.lit(False)).alias("same_area"))
    rows = scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.col("score").between(0, 1)).alias("in_range"))
    return rows.join(same, "fold")


_ROLES = [(c, "numeric") for c in ["loan_amnt", "annual_inc", "dti"]] + [
    (c, "categorical") for c in ["int_rate", "grade", "home_ownership", "issue_d", "earliest_cr_line"]
]


@query("WITH " + LOAN_VIEW_SQL + "\n" + " UNION ALL ".join(f"SELECT '{c}' AS feature, '{r}' AS role, count({c}) AS n_present FROM lv" for c, r in _ROLES))
def feature_roles(spark, sf):
    """What a model may learn from the loan view: neither key, label nor the label's source."""
    return audit.feature_roles(loan_view(spark, sf), LABEL, [KEY, *LABEL_SOURCES])


@query()
def learning_curve(spark, sf):
    rows = _complete(spark, sf).persist()
    try:
        train, val = sampling.split_by_sample(rows, 0.2, 7, KEY)
        forest = models.classifier("RandomForest", LABEL)
        return pin(models.learning_curve(train, val, _stages(forest), [0.1, 0.3, 0.5, 0.7, 1.0], LABEL, KEY))
    finally:
        rows.unpersist()


def _forest(spark, sf) -> tuple[PipelineModel, object]:
    rows = _complete(spark, sf)
    forest = models.classifier("RandomForest", LABEL, numTrees=5, maxDepth=3)
    return Pipeline(stages=_stages(forest)).fit(rows), rows


@query()
def feature_importance(spark, sf):
    model, rows = _forest(spark, sf)
    return models.feature_importance(model, rows, top=10)


@query()
def batch_score(spark, sf):
    model, rows = _forest(spark, sf)
    stored = load_model(save_model(model, scratch_path(spark, "forest")))
    return models.score(stored, rows, [KEY])


@query()
def stream_score(spark, sf):
    model, rows = _forest(spark, sf)
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "scored")
    write_table(rows, inbox, files=4)
    stream = read_stream(spark, inbox, rows.schema, max_files=2)
    score_stream(stream, model, [KEY], out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


def raw_loans(spark, sf):
    """Loan rows as they arrive: rates as text, gaps, a NaN, an infinity and a grade that no training row has."""
    broken = F.when(F.col(KEY) % 97 == 0, F.lit(float("nan"))).when(F.col(KEY) % 89 == 0, F.lit(float("inf")))
    return (
        model_table(spark, sf)
        .withColumn("int_rate", F.when(F.col(KEY) % 11 == 0, F.lit("n/a")).otherwise(F.col("int_rate").cast("string")))
        .withColumn("annual_inc", F.coalesce(broken, F.when(F.col(KEY) % 83 != 0, F.col("annual_inc"))))
        .withColumn("grade", F.when(F.col(KEY) % 101 == 5, F.lit("unseen")).when(F.col(KEY) % 103 != 0, F.col("grade")))
    )


def _raw_forest(spark, sf) -> str:
    """Where a forest over raw rows is stored; it is fitted without the rows of the new grade."""
    rows = raw_loans(spark, sf).filter("grade IS NULL OR grade <> 'unseen'")
    held = compact(rows)
    try:
        model = Pipeline(stages=features.raw_stages(NUMERIC, CATEGORICAL, models.classifier("RandomForest", LABEL))).fit(held)
    finally:
        held.unpersist()
    return save_model(model, scratch_path(spark, "raw-forest"))


_RAW_SCORE_SQL = "WITH " + LOAN_VIEW_SQL + "\nSELECT loan_id, TRUE AS in_range, TRUE AS by_threshold, {more} FROM lv"


def _checked(scored):
    """A score lies between 0 and 1, and decides the prediction at one half."""
    by_threshold = F.col("prediction") == F.when(F.col("score") > 0.5, 1).otherwise(0)
    return scored.withColumns({"in_range": F.coalesce(F.col("score").between(0, 1), F.lit(False)), "by_threshold": F.coalesce(by_threshold, F.lit(False))})


@query(_RAW_SCORE_SQL.format(more="grade_seen") .replace("FROM lv", "FROM (SELECT *, loan_id % 101 <> 5 AS grade_seen FROM lv)"))
def batch_score_raw(spark, sf):
    """A stored pipeline over raw rows: every row is scored, whatever it lacks."""
    model = load_model(_raw_forest(spark, sf))
    seen = ~F.col("grade").eqNullSafe("unseen")
    return _checked(models.score(model, raw_loans(spark, sf).withColumn("grade_seen", seen), [KEY, "grade_seen"])).select(
        KEY, "in_range", "by_threshold", "grade_seen"
    )


@query(_RAW_SCORE_SQL.format(more="TRUE AS as_batch"))
def stream_score_raw(spark, sf):
    """The same pipeline over arriving files of raw rows; scores equal those of the batch."""
    model = load_model(_raw_forest(spark, sf))
    rows = compact(raw_loans(spark, sf))
    inbox, out = scratch_path(spark, "raw-inbox"), scratch_path(spark, "raw-scored")
    try:
        # Two triggers at least, each with work for every core.
        files = max(4, rows.rdd.getNumPartitions())
        write_table(rows, inbox, files=files)
    finally:
        rows.unpersist()
    stream = read_stream(spark, inbox, rows.schema, max_files=files // 2)
    score_stream(stream, model, [KEY], out, scratch_path(spark, "raw-progress")).awaitTermination()
    batch = models.score(model, spark.read.schema(rows.schema).parquet(inbox), [F.col(KEY).alias("__id")]).select("__id", F.col("score").alias("__score"))
    both = _checked(spark.read.parquet(out)).join(batch, F.col(KEY) == F.col("__id"), "left")
    return both.select(KEY, "in_range", "by_threshold", F.coalesce(F.col("score") == F.col("__score"), F.lit(False)).alias("as_batch"))


SEGMENT_EXCLUDE = [KEY, LABEL, *LABEL_SOURCES]


@query()
def kmeans_fit(spark, sf):
    model, rows = clustering.fit_segments(model_table(spark, sf), k=8, exclude=SEGMENT_EXCLUDE)
    return models.cluster_quality(model, rows)


@query()
def gmm_fit(spark, sf):
    rows = model_table(spark, sf).drop(*CATEGORICAL)
    model, full = clustering.fit_segments(rows, k=3, exclude=SEGMENT_EXCLUDE, method="gmm", maxIter=10)
    return evaluate.cluster_profile(model.transform(full), "cluster", NUMERIC)


@query()
def kmeans_embeddings(spark, sf):
    rows = features.array_to_features(table(spark, sf, "embeddings"), "embedding")
    model = Pipeline(stages=[models.kmeans(5)]).fit(rows)
    return models.cluster_quality(model, rows)


@query()
def segment_profile(spark, sf):
    model, rows = clustering.fit_segments(model_table(spark, sf), k=5, exclude=SEGMENT_EXCLUDE, scale=True)
    return evaluate.cluster_profile(model.transform(rows), "cluster", NUMERIC)
