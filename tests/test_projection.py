"""Principal components against numpy's singular value decomposition."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from strata.operators import projection


def vectors(spark, x, parts=5):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>")
    return df.repartition(parts).withColumn("features", array_to_vector("v"))


def spread(rng, n, d, scale):
    return rng.standard_normal((n, d)) * scale @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 1000.0


@pytest.mark.parametrize("basis", [128, 24])
def test_components_equal_the_exact_ones(spark, basis):
    rng = np.random.default_rng(1)
    x = spread(rng, 700, 40, np.array([9, 7, 5] + [1.0] * 37))
    got = projection.components(vectors(spark, x), k=3, basis=basis)
    centred = x - x.mean(axis=0)
    _, size, right = np.linalg.svd(centred, full_matrices=False)
    tolerance = 1e-8 if basis == 128 else 0.02
    assert np.allclose(got.vectors.T @ got.vectors, np.eye(3), atol=1e-10)
    assert np.allclose(np.abs(np.sum(got.vectors.T * right[:3], axis=1)), 1, atol=tolerance)
    assert np.allclose(got.share, size[:3] ** 2 / np.square(centred).sum(), rtol=tolerance)
    assert np.allclose(got.deviation, centred.dot(got.vectors).std(axis=0, ddof=1), rtol=tolerance)


def test_projection_is_the_product_and_keeps_rows(spark):
    rng = np.random.default_rng(2)
    x = spread(rng, 300, 6, np.array([5, 3, 1, 1, 1, 1.0]))
    df = vectors(spark, x)
    found = projection.components(df, k=2)
    out = projection.project(df, found).select("id", vector_to_array("pca").alias("p")).orderBy("id").collect()
    assert np.allclose([r["p"] for r in out], (x - x.mean(axis=0)) @ found.vectors, atol=1e-9)


def test_rows_that_are_not_finite_repeat_or_lack(spark):
    x = np.vstack([np.tile([1.0, 2.0, 3.0], (50, 1)), [[1.0, 4.0, 3.0]], [[np.nan, 0, 0]], [[np.inf, 0, 0]]])
    got = projection.components(vectors(spark, x), k=2)
    assert np.allclose(got.vectors[:, 0], [0, 1, 0]) and got.share[0] == pytest.approx(1) and got.deviation[1] == pytest.approx(0)
    same = projection.components(vectors(spark, x[:3]), k=2)
    assert np.allclose(same.share, 0) and np.allclose(same.vectors.T @ same.vectors, np.eye(2))
    with pytest.raises(ValueError, match="no rows"):
        projection.components(vectors(spark, x).limit(0))
    with pytest.raises(ValueError, match="components of"):
        projection.components(vectors(spark, x), k=4)
