"""Evaluation of predictions, entirely on the executors.

Curves and areas start from counts per distinct score, so heavy ties cost nothing, and use
bucketed running totals, so a continuous score costs no single-task sort.  ``by`` names
columns (split, model, fold) to evaluate separately in the same jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.prefix import running_totals
from strata.runtime import as_list


def _share(a: Column, b: Column) -> Column:
    """a / b as DOUBLE, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: str | Sequence[str] = ()
) -> DataFrame:
    """(label, prediction, n) over the full grid of classes, zeros included."""
    by = as_list(by)
    counts = (
        df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(*by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # From here on there is one row per pair of classes that occurs.
    classes = counts.agg(
        F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction")))
    ).scalar()
    grid = (
        counts.select(*by)
        .distinct()
        .withColumn("label", F.explode(classes))
        .withColumn("prediction", F.explode(classes))
        .withColumn("n", F.lit(0).cast("long"))
    ) if by else (
        df.sparkSession.range(1)
        .select(F.explode(classes).alias("label"))
        .select("label", F.explode(classes).alias("prediction"), F.lit(0).cast("long").alias("n"))
    )
    return counts.unionByName(grid).groupBy(*by, "label", "prediction").agg(F.sum("n").alias("n"))


def binary_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: str | Sequence[str] = (),
    positive: int = 1,
) -> DataFrame:
    """accuracy, precision, recall, f1 of the positive class; an undefined ratio is 0."""
    by = as_list(by)
    is_pos, said_pos = F.col(label) == positive, F.col(prediction) == positive
    counts = df.groupBy(*by).agg(
        F.count_if(F.col(label).isNotNull() & F.col(prediction).isNotNull()).alias("n"),
        F.count_if(F.col(label).cast("int") == F.col(prediction).cast("int")).alias("hit"),
        F.count_if(is_pos & said_pos).alias("tp"),
        F.count_if(~is_pos & said_pos).alias("fp"),
        F.count_if(is_pos & ~said_pos).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *by,
        _share(F.col("hit"), F.col("n")).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def weighted_precision(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: str | Sequence[str] = ()
) -> DataFrame:
    """Per-class precision averaged with the class frequencies; also plain accuracy."""
    by = as_list(by)
    cells = confusion_matrix(df, label, prediction, by)
    as_label = cells.groupBy(*by, F.col("label").alias("class")).agg(F.sum("n").alias("actual"))
    as_said = cells.groupBy(*by, F.col("prediction").alias("class")).agg(
        F.sum("n").alias("said"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"),
    )
    return (
        as_label.join(as_said, [*by, "class"])
        .groupBy(*by)
        .agg(
            _share(F.sum(F.col("actual") * _share(F.col("tp"), F.col("said"))), F.sum("actual")).alias(
                "weighted_precision"
            ),
            _share(F.sum("tp"), F.sum("actual")).alias("accuracy"),
        )
    )


def _counted(label: str, score: str) -> Column:
    """Rows that curves and areas see: labelled and scored; a NaN score is no score."""
    return F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))


def score_counts(
    df: DataFrame, label: str, score: str, by: str | Sequence[str] = (), positive: int = 1
) -> DataFrame:
    """(by, score, pos, neg): labelled, scored rows per distinct score."""
    return (
        df.filter(_counted(label, score))
        .groupBy(*as_list(by), F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(F.col(label) == positive).alias("pos"),
            F.count_if(F.col(label) != positive).alias("neg"),
        )
    )


def score_curve(
    df: DataFrame,
    label: str,
    score: str,
    by: str | Sequence[str] = (),
    positive: int = 1,
    buckets: int | None = None,
) -> DataFrame:
    """(by, score, pos, neg, tp, fp): true and false positives when everything at or above
    ``score`` is called positive."""
    by = as_list(by)
    counts = score_counts(df, label, score, by, positive)
    return (
        running_totals(counts, "score", ["pos", "neg"], by, descending=True, buckets=buckets)
        .withColumnRenamed("cum_pos", "tp")
        .withColumnRenamed("cum_neg", "fp")
    )


def ranking_metrics(
    df: DataFrame, label: str, score: str, by: str | Sequence[str] = (), positive: int = 1, buckets: int | None = None
) -> DataFrame:
    """(by, auc, pr_auc): ROC area with ties counted half, and average precision.

    Both are NULL when one of the classes is absent.
    """
    curve = score_curve(df, label, score, by, positive, buckets)
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    won = F.sum(neg * (tp - pos + pos / 2))
    stepped = F.sum(pos * tp / (tp + fp))
    p, n = F.sum(pos), F.sum(neg)
    both = (p > 0) & (n > 0)
    return curve.groupBy(*as_list(by)).agg(
        F.when(both, F.try_divide(won, p * n)).alias("auc"),
        F.when(both, F.try_divide(stepped, p)).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label: str, score: str, by: str | Sequence[str] = (), **kw) -> DataFrame:
    return ranking_metrics(df, label, score, by, **kw).select(*as_list(by), "auc")


def average_precision(df: DataFrame, label: str, score: str, by: str | Sequence[str] = (), **kw) -> DataFrame:
    return ranking_metrics(df, label, score, by, **kw).select(*as_list(by), "pr_auc")


def _class_totals(df: DataFrame, label: str, score: str, by: list[str], positive: int) -> DataFrame:
    return (
        df.filter(_counted(label, score))
        .groupBy(*[F.col(c).alias(f"__g_{c}") for c in by])
        .agg(
            F.count_if(F.col(label) == positive).cast("double").alias("__p"),
            F.count_if(F.col(label) != positive).cast("double").alias("__n"),
        )
    )


def _with_totals(curve: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return curve.join(totals, [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by])
    both = totals.select(F.struct("__p", "__n")).scalar()
    return curve.withColumns({"__p": both.getField("__p"), "__n": both.getField("__n")})


def roc_curve(
    df: DataFrame, label: str, score: str, by: str | Sequence[str] = (), positive: int = 1, buckets: int | None = None
) -> DataFrame:
    """(by, threshold, fpr, tpr) per distinct score, plus the start (infinity, 0, 0)."""
    by = as_list(by)
    totals = _class_totals(df, label, score, by, positive)
    start = totals.select(
        *[F.col(f"__g_{c}").alias(c) for c in by],
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    points = _with_totals(score_curve(df, label, score, by, positive, buckets), totals, by).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("__n")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("__p")).alias("tpr"),
    )
    return start.unionByName(points)


def pr_curve(
    df: DataFrame, label: str, score: str, by: str | Sequence[str] = (), positive: int = 1, buckets: int | None = None
) -> DataFrame:
    """(by, threshold, precision, recall) per distinct score, plus the end (NULL, 1, 0)."""
    by = as_list(by)
    totals = _class_totals(df, label, score, by, positive)
    end = totals.select(
        *[F.col(f"__g_{c}").alias(c) for c in by],
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    points = _with_totals(score_curve(df, label, score, by, positive, buckets), totals, by).select(
        *by,
        F.col("score").alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        F.try_divide(tp, F.col("__p")).alias("recall"),
    )
    return end.unionByName(points)


def metric_set(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    by: str | Sequence[str] = (),
) -> DataFrame:
    """(by, metric, value): auc, accuracy, precision, recall, f1, pr_auc in long form."""
    by = as_list(by)
    frames = [binary_metrics(df, label, prediction, by), ranking_metrics(df, label, score, by)]
    long = [f.unpivot(by, [c for c in f.columns if c not in by], "metric", "value") for f in frames]
    return reduce(DataFrame.unionByName, long)


def prefixed(metrics: DataFrame, split: str = "split", unprefixed: Sequence[str] = ("test",)) -> DataFrame:
    """Fold the split into the metric name (``train_auc``); splits in ``unprefixed`` stay bare."""
    name = F.when(F.col(split).isin(*unprefixed), F.col("metric")).otherwise(
        F.concat_ws("_", F.col(split), F.col("metric"))
    )
    return metrics.withColumn("metric", name).drop(split)


def summarize_folds(metrics: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """(by, metric, mean, stddev, n) over folds."""
    return metrics.groupBy(*as_list(by), "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("stddev"), F.count("value").alias("n")
    )


def model_comparison(metrics: DataFrame, names: Sequence[str], model: str = "model", digits: int = 4) -> DataFrame:
    """One row per model, one rounded column per metric."""
    wide = metrics.groupBy(model).pivot("metric", list(names)).agg(F.max("value"))
    return wide.select(model, *[F.round(m, digits).alias(m) for m in names])


def best_run(runs: DataFrame, metric: str = "val_auc", run_id: str = "run_id") -> DataFrame:
    """The run with the highest ``metric``; a missing metric ranks last, ties go by run id."""
    return runs.orderBy(F.col(metric).desc_nulls_last(), run_id).limit(1)


def best_per_model(
    runs: DataFrame, metric: str = "val_auc", model: str = "model", run_id: str = "run_id"
) -> DataFrame:
    """The best run of each model name."""
    order = Window.partitionBy(model).orderBy(F.col(metric).desc_nulls_last(), run_id)
    return runs.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") == 1).drop("__r")


def runs_table(log: DataFrame, metrics: Sequence[str], keys: Mapping[str, str] | None = None) -> DataFrame:
    """Pivot the long metric log into one row per run."""
    keys = dict(keys or {"run_id": "run_id"})
    return (
        log.groupBy(*[F.col(c).alias(a) for c, a in keys.items()])
        .pivot("metric", list(metrics))
        .agg(F.max("value"))
    )


def _exploded(df: DataFrame, cluster: str, vector: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(
        F.col(cluster).alias("cluster"), *keep, F.posexplode(vector).alias("dim", "x")
    ).withColumn("x", F.col("x").cast("double"))


def wssse(df: DataFrame, cluster: str = "cluster", vector: str = "features") -> DataFrame:
    """One row: sum of squared distances to the cluster means of an array column."""
    sums = (
        _exploded(df, cluster, vector)
        .groupBy("cluster", "dim")
        .agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("x").alias("n"))
    )
    return sums.agg(F.sum(F.col("q") - F.try_divide(F.col("s") * F.col("s"), F.col("n"))).alias("wssse"))


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str]) -> DataFrame:
    """Per cluster: rows, share of all rows, and the mean of each column."""
    per = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in cols]
    )
    total = per.agg(F.sum("n")).scalar()
    return per.withColumn("share", F.col("n").cast("double") / total)
