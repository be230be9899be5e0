"""The segmentation plan: encode, scale, cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from strata.operators import derive, features, models
from strata.runtime import as_list


def fit_segments(
    df: DataFrame,
    k: int = 8,
    exclude: str | Sequence[str] = (),
    method: str = "kmeans",
    scale: bool = True,
    seed: int = 42,
    **kw,
) -> tuple[PipelineModel, DataFrame]:
    """Fit a clustering over all numeric and categorical columns but ``exclude``.

    Name the label, its sources and the key in ``exclude``: segments should not be told
    the outcome.  Returns the model and the completed input it was fitted on.
    """
    numeric, categorical = derive.feature_columns(df, "", as_list(exclude))
    full = features.complete_features(df, numeric, categorical)
    stages = features.encoder_stages(numeric, categorical, scale=scale)
    make = models.kmeans if method == "kmeans" else models.gaussian_mixture
    # Every stage of the fit reads the rows again.
    held = full.select(*numeric, *categorical).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if categorical:
            features.check_cardinality(held, categorical)
        return Pipeline(stages=[*stages, make(k, seed=seed, **kw)]).fit(held), full
    finally:
        held.unpersist()
