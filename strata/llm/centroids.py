"""Exact k-means on integer vectors with an incremental distance matrix.

Every vector keeps its exact dot product with every centroid.  When centroids move, a dot
product changes by the sum, over the components that moved, of the move times the vector's
component; components and centroids that stayed cost nothing.  The squared distance is
|x|^2 - 2 x.c + |c|^2, so the argmin is taken anew from the stored products alone.

Vectors, products and assignment lie in one table that each round reads and writes once; a
round's table replaces the one before, so at most two exist.  Component sums per cluster come
from one row per task and cluster.  The driver holds the centroids only: ``clusters`` times
``size`` integers, whatever the input.

Defined cases: vectors of another length, with a NULL, NaN or infinite component and NULL
vectors are left out; a NULL id is kept and comes last among the candidates for a start;
repeated rows are vectors of their own (equal ones in the start choice: ordered by their
components); fewer vectors than centroids start as many centroids as there are vectors; ties
go to the smaller number; an empty table gives an empty result; other columns are not looked
at.  A component beyond +-2^27 after scaling has no distance that fits a BIGINT: the job ends
with an error that says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches, stored
from strata.llm.store import located

SIZE = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
LARGEST = 1 << 27
STATE = "vec_id long, vector binary, products binary, cluster int, distance long"


def narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes that hold them all: 2, 4 or 8."""
    most = int(np.abs(values).max(initial=0))
    return values.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


def to_binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix; its length tells the width of the numbers."""
    n, size = rows.shape
    packed = narrow(rows)
    width = size * packed.itemsize
    return pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype("<i4").tobytes()), pa.py_buffer(np.ascontiguousarray(packed).tobytes())]
    )


def from_binary(column: pa.Array, size: int) -> np.ndarray:
    """The matrix of such a column; rows of one batch may differ in width."""
    n = len(column)
    out = np.empty((n, size), np.int64)
    if not n:
        return out
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    widths = np.diff(offsets) // size
    edges = np.flatnonzero(np.diff(widths)) + 1
    for a, b in zip(np.append(0, edges), np.append(edges, n)):
        part = data[offsets[a] : offsets[b]].tobytes()
        out[a:b] = np.frombuffer(part, f"<i{int(widths[a])}").reshape(b - a, size)
    return out


def scaled(vectors: pa.Array, size: int = SIZE, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows that count, their integer components) of a list column."""
    lengths = pc.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    flat = vectors.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), size)  # NULL becomes NaN
    good = np.isfinite(values).all(axis=1)
    rows, values = rows[good], np.floor(values[good] * scale)
    if len(values) and np.abs(values).max() > LARGEST:
        raise ValueError(f"a component times {scale} lies beyond {LARGEST}: its distance does not fit a BIGINT")
    return rows, values.astype(np.int64)


def moved(vectors: np.ndarray, products: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Dot products with ``new`` from those with ``old``, touching only components that differ."""
    change = new - old
    if int(np.abs(change).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * max(1, change.shape[1]) < 1 << 53:
        vectors, change = vectors.astype(np.float64), change.astype(np.float64)  # whole numbers, exact below 2^53
    vectors = np.asfortranarray(vectors)  # a component is one stretch of memory
    for j in np.flatnonzero(change.any(axis=1)):
        where = np.flatnonzero(change[j])
        part = vectors if len(where) == change.shape[1] else vectors[:, where]
        products[:, j] += (part @ change[j, where]).astype(np.int64)
    return products


def nearest(vectors: np.ndarray, products: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); the smaller number wins ties."""
    rest = (centroids * centroids).sum(axis=1) - 2 * products
    cluster = rest.argmin(axis=1)
    return cluster, (vectors * vectors).sum(axis=1) + rest[np.arange(len(rest)), cluster]


def _state(ids: pa.Array, vectors: np.ndarray, products: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    cluster, distance = nearest(vectors, products, centroids)
    return pa.RecordBatch.from_pydict(
        {"vec_id": ids, "vector": to_binary(vectors), "products": to_binary(products), "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance, pa.int64())}
    )


def start(rows: DataFrame, clusters: int, seed: str, size: int, scale: int) -> np.ndarray:
    """The first centroids: the vectors with the smallest sha256 of ``seed:<vec_id>``, a top-k of ``clusters`` rows."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, values = scaled(batch.column("vector"), size, scale)
            ids = batch.column("vec_id").take(pa.array(which))
            yield pa.RecordBatch.from_pydict({"vec_id": ids, "vector": pa.array(values.tolist(), pa.list_(pa.int64()))})

    first = rows.mapInArrow(keep, "vec_id long, vector array<long>")
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    taken = first.orderBy(place.asc_nulls_last(), "vector").limit(clusters).collect()
    return np.array([r["vector"] for r in taken], np.int64).reshape(len(taken), size)


def cluster_sums(state: DataFrame, size: int) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and exact component sums of each cluster."""
    names = [f"s{i}" for i in range(size)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            vectors, cluster = from_binary(batch.column("vector"), size), batch.column("cluster").to_numpy()
            for c in np.unique(cluster).tolist():
                mine = vectors[cluster == c]
                n, sums = total.get(c, (0, np.zeros(size, np.int64)))
                total[c] = n + len(mine), sums + mine.sum(axis=0)
        sums = np.array([s for _, s in total.values()], np.int64).reshape(len(total), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(total.keys(), pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()), *[pa.array(sums[:, i]) for i in range(size)]],
            names=["cluster", "n", *names],
        )

    schema = ", ".join(["cluster int", "n long", *[f"{s} long" for s in names]])
    parts = state.select("vector", "cluster").mapInArrow(add, schema)
    wide = [F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in names]  # a row per task and cluster
    return {r["cluster"]: (r["n"], [int(r[s]) for s in names]) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect()}


def _drop(table: DataFrame) -> None:
    """Remove a table of our own that a later one has replaced."""
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    for folder in folders:
        system, path = located(folder)
        system.delete_dir(path)


def fit(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = "2",
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = SIZE,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(stored table of vec_id, vector, products, cluster, distance; final centroids)."""
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    centroids = start(rows, clusters, seed, size, scale)
    if not len(centroids):
        return spark.createDataFrame([], STATE), centroids

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            which, vectors = scaled(batch.column("vector"), size, scale)
            none = np.zeros((len(vectors), len(centroids)), np.int64)
            products = moved(vectors, none, np.zeros_like(centroids), centroids)
            yield _state(batch.column("vec_id").take(pa.array(which)), vectors, products, centroids)

        yield from in_batches(batches, piece)

    def advance(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = from_binary(batch.column("vector"), size)
                products = moved(vectors, from_binary(batch.column("products"), len(old)), old, new)
                yield _state(batch.column("vec_id"), vectors, products, new)

        return state.select("vec_id", "vector", "products").mapInArrow(step, STATE)

    state = stored(rows.mapInArrow(begin, STATE), "vectors")
    for _ in range(rounds):
        new = centroids.copy()
        for c, (n, sums) in cluster_sums(state, size).items():
            new[c] = [s // n for s in sums]
        if (new == centroids).all():
            break  # nothing moves any more: later rounds would repeat this one
        earlier, state = state, stored(advance(state, centroids, new), "vectors")
        _drop(earlier)
        centroids = new
    return state, centroids


def assigned(embeddings: DataFrame, **options) -> DataFrame:
    """Per vector its cluster, squared distance, the cluster's and the total inertia, and the centroid's checksum."""
    spark = embeddings.sparkSession
    state, centroids = fit(embeddings, **options)
    totals = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    whole = sum(int(r["inertia"]) for r in totals)
    facts = [
        (r["cluster"], int(r["inertia"]), whole, hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in totals
    ]
    lookup = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = state.select("vec_id", "cluster", "distance").join(F.broadcast(lookup), "cluster")  # a row per centroid
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
