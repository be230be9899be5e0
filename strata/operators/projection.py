"""Principal components without a covariance matrix: a random range finder and a tall, narrow QR.

For n rows X (centred) of width d and k wanted components, a basis B of at most ``basis``
directions is found by block Krylov steps: each multiplies the last block by X'X in one scan, as
X'(X Q) summed over tasks, d x (k + ``EXTRA``) numbers a task.  Then X B = Q R, where only R is
needed: each task keeps the R of its rows, and stacks of R are factored again in two steps.  The
singular values and right vectors of R are those of X within the basis.  With d <= ``basis``
the basis is the identity and the result is exact in one scan.

No step holds more than d x ``basis`` numbers, on the driver or in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASIS = 128
#: Directions of a block beyond those wanted.
EXTRA = 8
#: The second of the two merge steps takes the results of at most so many groups of tasks.
FOLDS = 64
BATCH_ROWS = 4096


class Components(NamedTuple):
    """mean (d), vectors (d x k, the entry of largest size of each is positive), deviation (k), share of the variance (k)."""

    mean: np.ndarray
    vectors: np.ndarray
    deviation: np.ndarray
    share: np.ndarray


def _rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The finite rows of a batch of equal arrays, in pieces."""
    for at in range(0, batch.num_rows, BATCH_ROWS):
        lists = batch.column(0).slice(at, BATCH_ROWS).drop_null()
        if len(lists):
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            yield x[np.isfinite(x).all(axis=1)]


def _folded(arrays: DataFrame, start: Callable[[], list], add: Callable, merge: Callable) -> list[np.ndarray] | None:
    """``add`` rows to what ``start`` makes in each task, ``merge`` the results: a few per group, then few on the driver."""
    schema = "fold int, shapes array<int>, parts array<binary>"

    def packed(fold: int, state: list[np.ndarray]) -> pa.RecordBatch:
        shapes = [n for a in state for n in a.shape]
        data = [pa.array([fold], pa.int32()), pa.array([shapes], pa.list_(pa.int32())), pa.array([[a.astype("<f8").tobytes() for a in state]], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(data, names=["fold", "shapes", "parts"])

    def unpacked(shapes: list[int], parts: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(bytes(p), "<f8").reshape(shapes[2 * i], shapes[2 * i + 1]) for i, p in enumerate(parts)]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            for x in _rows(batch):
                if len(x):
                    state = add(state, x)
        yield packed(TaskContext.get().partitionId() % FOLDS, state)

    def group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            for shapes, parts in zip(batch.column("shapes").to_pylist(), batch.column("parts").to_pylist()):
                one = unpacked(shapes, parts)
                state = one if state is None else merge(state, one)
        yield packed(key[0].as_py(), state)

    state = None
    for row in arrays.mapInArrow(each, schema).groupBy("fold").applyInArrow(group, schema).orderBy("fold").collect():
        one = unpacked(row["shapes"], row["parts"])
        state = one if state is None else merge(state, one)
    return state


def _sum(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)]


def _stacked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack([a, b]), mode="r")


def components(df: DataFrame, features: str = "features", k: int = 2, basis: int = BASIS, seed: int = 42) -> Components:
    """The first ``k`` components of the vector column; rows that are NULL or hold a NaN or an infinity do not count.

    Equal to the exact ones up to rounding where the width is at most ``basis``; beyond it the
    subspace is the best of the basis, whose error falls with every block.
    """
    arrays = df.select(vector_to_array(features).alias("x")).filter("x IS NOT NULL")
    first = arrays.first()
    if first is None:
        raise ValueError("no rows to project")
    d = len(first["x"])
    if not 1 <= k <= d:
        raise ValueError(f"{k} components of {d} columns")
    sums = lambda s, x: [s[0] + len(x), s[1] + x.sum(axis=0)]
    n, total = _folded(arrays, lambda: [np.zeros((1, 1)), np.zeros((1, d))], sums, _sum)
    n = int(n[0, 0])
    if n == 0:
        raise ValueError("no finite rows to project")
    mean = total[0] / n

    if d <= basis:
        b = np.eye(d)
    else:
        width = min(d, k + EXTRA)
        q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
        b = q
        while b.shape[1] + width <= max(basis, 2 * width):
            (z,) = _folded(arrays, lambda: [np.zeros((d, width))], lambda s, x, q=q: [s[0] + (x - mean).T @ ((x - mean) @ q)], _sum)
            for _ in range(2):  # once more, as the first pass leaves rounding along the basis
                z = z - b @ (b.T @ z)
                q = z = np.linalg.qr(z)[0]
            b = np.hstack([b, q])
    m = b.shape[1]
    narrow = lambda s, x: [_stacked(s[0], (x - mean) @ b), s[1] + np.square(x - mean).sum()]
    r, spread = _folded(arrays, lambda: [np.zeros((0, m)), np.zeros((1, 1))], narrow, lambda s, t: [_stacked(s[0], t[0]), s[1] + t[1]])
    _, size, right = np.linalg.svd(np.vstack([r, np.zeros((max(0, m - len(r)), m))]))
    vectors = b @ right[:k].T
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    share = np.square(size[:k]) / spread[0, 0] if spread[0, 0] > 0 else np.zeros(k)
    return Components(mean, vectors, size[:k] / np.sqrt(max(1, n - 1)), share)


def project(df: DataFrame, found: Components, features: str = "features", out: str = "pca") -> DataFrame:
    """Add the coordinates of each row along the components as a vector column; a NULL vector is an error as in any ML stage."""
    mean, vectors = found.mean, found.vectors

    @F.arrow_udf("array<double>")
    def along(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(mean))
        at = (flat - mean) @ vectors
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * vectors.shape[1], pa.int32()), pa.array(at.ravel()))

    return df.withColumn(out, array_to_vector(along(vector_to_array(features))))
