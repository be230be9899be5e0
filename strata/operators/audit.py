"""Second opinions on models: facts recomputed from the scored rows by another way than the one that reported them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import derive
from strata.operators.evaluate import score_counts
from strata.operators.prefix import running_totals
from strata.runtime import as_list


def rank_auc(df: DataFrame, label: str, score: str, by: str | Sequence[str] = ()) -> DataFrame:
    """(by, rank_auc): ROC area from the positives' sum of mean ranks; NULL without both classes.

    Rows of one score share the mean of their ranks, so they travel as one row of counts.
    """
    by = as_list(by)
    counts = score_counts(df, label, score, by).withColumn("rows", F.col("pos") + F.col("neg"))
    ranked = running_totals(counts, "score", ["rows"], by)
    last, rows, pos = (F.col(c).cast("double") for c in ("cum_rows", "rows", "pos"))
    p, n = F.sum(pos), F.sum("neg").cast("double")
    won = F.sum(pos * (last - (rows - 1) / 2)) - p * (p + 1) / 2
    return ranked.groupBy(*by).agg(F.when((p > 0) & (n > 0), F.try_divide(won, p * n)).alias("rank_auc"))


def feature_roles(df: DataFrame, target: str, exclude: str | Sequence[str] = ()) -> DataFrame:
    """(feature, role, n_present) of the columns a model may learn from, in one scan; NaN is not present."""
    numeric, categorical = derive.feature_columns(df, target, exclude)
    if not numeric + categorical:
        return df.sparkSession.createDataFrame([], "feature string, role string, n_present long")
    present = [F.count_if(F.col(c).isNotNull() & ~F.coalesce(F.isnan(F.col(c).cast("double")), F.lit(False))) for c in numeric]
    present += [F.count_if(F.col(c).isNotNull()) for c in categorical]
    roles = [(c, "numeric") for c in numeric] + [(c, "categorical") for c in categorical]
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(r).alias("role"), n.alias("n_present")) for (c, r), n in zip(roles, present)]
    return df.agg(F.array(*rows).alias("__rows")).select(F.inline("__rows"))
