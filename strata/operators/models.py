"""Training, tuning, scoring and interpretation with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.evaluate import metric_set
from strata.operators.features import feature_slots
from strata.operators.sampling import with_uniform
from strata.runtime import compact, pin, side_by_side

CLASSIFIERS = {
    "LogisticRegression": LogisticRegression,
    "DecisionTree": DecisionTreeClassifier,
    "RandomForest": RandomForestClassifier,
    "GBT": GBTClassifier,
    "MLP": MultilayerPerceptronClassifier,
}

# The candidate settings of the two tuned ensembles.
GRIDS: dict[str, dict[str, list]] = {
    "RandomForest": {"maxDepth": [5, 10], "numTrees": [20, 50]},
    "GBT": {"maxDepth": [5, 10], "maxIter": [20, 50], "stepSize": [0.05, 0.1]},
}
MLP_HIDDEN = (64, 32)


def classifier(
    name: str,
    label: str,
    features: str = "features",
    weight: str | None = None,
    seed: int = 42,
    n_features: int | None = None,
    n_classes: int = 2,
    hidden: Sequence[int] | None = MLP_HIDDEN,
    **params,
) -> Estimator:
    """A classifier by name.

    The perceptron has no sample weights; its layers are the input width, ``hidden`` (half
    the input when None) and the classes.
    """
    kw: dict = {"labelCol": label, "featuresCol": features, **params}
    if name == "MLP":
        if n_features is None:
            raise ValueError("MLP needs n_features")
        middle = list(hidden) if hidden is not None else [max(2, n_features // 2)]
        kw["layers"] = [n_features, *middle, n_classes]
    elif weight:
        kw["weightCol"] = weight
    if name != "LogisticRegression":
        kw["seed"] = seed
    return CLASSIFIERS[name](**kw)


def param_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def grid_search(
    df: DataFrame,
    stages: Sequence,
    grid: Mapping[str, Sequence],
    label: str,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
    fold_col: str | None = None,
) -> CrossValidatorModel:
    """Cross-validated search over ``grid`` of the last stage, selected by ROC area.

    With ``fold_col`` the folds are ours (0..folds-1).  Settings are fitted side by side.
    """
    cv = CrossValidator(
        estimator=Pipeline(stages=list(stages)),
        estimatorParamMaps=param_grid(stages[-1], grid),
        evaluator=BinaryClassificationEvaluator(labelCol=label),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    return cv.fit(df)


def best_pipeline(model: Model) -> PipelineModel:
    return model.bestModel if isinstance(model, CrossValidatorModel) else model


def best_params(df: DataFrame, model: Model, names: Sequence[str]) -> DataFrame:
    """(param, value) of the winning last stage."""
    last = best_pipeline(model).stages[-1]
    rows = [F.struct(F.lit(n).alias("param"), F.lit(float(last.getOrDefault(n))).alias("value")) for n in names]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def score(
    model: Model, df: DataFrame, keep: Sequence[str], features_out: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns, prediction and the probability of class 1 as ``score``."""
    scored = best_pipeline(model).transform(df)
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        F.get(vector_to_array("probability"), F.lit(1)).alias("score"),
        *features_out,
    )


def split_metrics(model: Model, splits: Mapping[str, DataFrame], label: str) -> DataFrame:
    """(split, metric, value) for several splits in the same few jobs; every row is scored once."""
    scored = [
        score(model, df, [F.col(label).cast("int").alias("label")]).withColumn("split", F.lit(name))
        for name, df in splits.items()
    ]
    return metric_set(pin(reduce(DataFrame.unionByName, scored)), by="split")


def kfold_predictions(df: DataFrame, stages: Sequence, k: int, label: str, fold: str = "fold") -> DataFrame:
    """(label, fold, prediction, score): every row scored by the model of all other folds, and stored."""
    rows = compact(df)

    def held_out(i: int) -> DataFrame:
        model = Pipeline(stages=list(stages)).fit(rows.filter(F.col(fold) != i))
        return score(model, rows.filter(F.col(fold) == i), [F.col(label).cast("int").alias("label"), fold])

    try:
        return pin(reduce(DataFrame.unionByName, side_by_side(held_out, range(k))))
    finally:
        rows.unpersist()


def kfold_scores(df: DataFrame, stages: Sequence, k: int, label: str, fold: str = "fold") -> DataFrame:
    """(fold, metric, value): fit on all other folds, evaluate on the fold."""
    return metric_set(kfold_predictions(df, stages, k, label, fold), by=fold)


def learning_curve(
    train: DataFrame,
    validation: DataFrame,
    stages: Sequence,
    fractions: Sequence[float],
    label: str,
    key: str | Sequence[str],
    seed: int = 42,
) -> DataFrame:
    """(fraction, split, metric, value): nested training subsets, same validation rows."""
    marked, held_out = compact(with_uniform(train, key, seed, "__u")), compact(validation)

    def step(f: float) -> list[DataFrame]:
        subset = marked.filter(F.col("__u") < f).drop("__u")
        model = Pipeline(stages=list(stages)).fit(subset)
        return [
            score(model, df, [F.col(label).cast("int").alias("label")]).withColumns(
                {"fraction": F.lit(float(f)), "split": F.lit(name)}
            )
            for name, df in (("train", subset), ("val", held_out))
        ]

    try:
        scored = pin(reduce(DataFrame.unionByName, [df for dfs in side_by_side(step, fractions) for df in dfs]))
    finally:
        marked.unpersist()
        held_out.unpersist()
    return metric_set(scored, by=["fraction", "split"])


def feature_importance(
    model: Model, df: DataFrame, features: str = "features", top: int | None = None, by_source: bool = True
) -> DataFrame:
    """(feature, importance), one-hot slots summed back into their source column.

    Slot names come from the vector's metadata.  ``df`` is any frame the model transforms.
    """
    fitted = best_pipeline(model)
    slots = feature_slots(fitted.transform(df.limit(0)), features)
    values = fitted.stages[-1].featureImportances.toArray().tolist()
    rows = [(source if by_source else name, float(values[i])) for i, name, source in slots]
    table = (
        df.sparkSession.createDataFrame(rows, "feature string, importance double")
        .groupBy("feature")
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
    return table.limit(top) if top else table


def kmeans(k: int = 8, features: str = "features", out: str = "cluster", seed: int = 42, **kw) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=out, **kw)


def gaussian_mixture(k: int = 8, features: str = "features", out: str = "cluster", seed: int = 42, **kw):
    return GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol=out, **kw)


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Mean simplified silhouette with squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(df)


def cluster_quality(model: PipelineModel, df: DataFrame, cluster: str = "cluster", features: str = "features") -> DataFrame:
    """One row: clusters, rows, within-cluster sum of squares and silhouette."""
    assigned = model.transform(df).select(features, cluster)
    fitted = model.stages[-1]
    cost = float(fitted.summary.trainingCost) if hasattr(fitted.summary, "trainingCost") else None
    return assigned.agg(
        F.lit(int(fitted.summary.k)).alias("k"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(cost).cast("double").alias("inertia"),
        F.lit(silhouette(assigned, features, cluster)).alias("silhouette"),
    )


