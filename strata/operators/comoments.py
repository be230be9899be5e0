"""Pairwise co-moments of any number of columns in one scan.

Columns are cut into blocks of ``TILE``; a pair of blocks is a tile.  Over a batch of rows, with
X the values (0 where missing) and M the presence mask, M'M, X'M, (X*X)'M and X'X give for every
pair of columns the rows that have both, the two sums, the two sums of squares and the sum of
products over exactly these rows.  They become means and centred moments at once and are merged
from then on by the pairwise update

    n = n1 + n2,  mean = mean1 + d n2 / n,  C = C1 + C2 + dx dy n1 n2 / n,

which does not lose digits where values are large against their spread.  A task emits one row per
tile; tiles of many tasks are merged in two steps, and no step holds more than one accumulator per
tile.  NULL and NaN are missing; an infinite value is present but has no moments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 64
#: Bytes of accumulators that a task may hold: tables of more columns take a scan per so many tiles.
HELD_BYTES = 512 << 20
#: First merge step: tasks per accumulator is a 64th.
FOLDS = 64
#: rows that have both; the two means; the two centred squares; the centred product; rows with an infinity;
#: the two largest shifts, whose rounding the squares cannot tell from zero
_FIELDS = 9


def _batch_tile(x: np.ndarray, m: np.ndarray, inf: np.ndarray, shift: np.ndarray, left: slice, right: slice) -> np.ndarray:
    """The accumulator of one tile over a batch of values less their column's ``shift``."""
    xl, xr, ml, mr = x[:, left], x[:, right], m[:, left], m[:, right]
    n = ml.T @ mr
    sum_l, sum_r = xl.T @ mr, ml.T @ xr
    rows = np.maximum(n, 1)

    def centred(squares: np.ndarray, sums: np.ndarray) -> np.ndarray:
        spread = squares - sums * sums / rows
        # equal values leave what the summation of their squares has rounded
        return np.where(spread <= (8 + 4 * np.sqrt(rows)) * np.finfo(float).eps * squares, 0, spread)

    return np.stack(
        [
            n,
            sum_l / rows + shift[left, None],
            sum_r / rows + shift[None, right],
            centred((xl * xl).T @ mr, sum_l),
            centred(ml.T @ (xr * xr), sum_r),
            xl.T @ xr - sum_l * sum_r / rows,
            inf[:, left].T @ (mr + inf[:, right]) + ml.T @ inf[:, right],
            np.broadcast_to(np.abs(shift[left, None]), n.shape),
            np.broadcast_to(np.abs(shift[None, right]), n.shape),
        ]
    )


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Accumulators of two sets of rows as that of both."""
    n = a[0] + b[0]
    rows = np.maximum(n, 1)
    dl, dr = b[1] - a[1], b[2] - a[2]
    dl, dr = np.where((a[0] > 0) & (b[0] > 0), dl, 0), np.where((a[0] > 0) & (b[0] > 0), dr, 0)
    share, cross = b[0] / rows, a[0] * b[0] / rows
    return np.stack(
        [
            n,
            np.where(a[0] > 0, a[1] + dl * share, b[1]),
            np.where(a[0] > 0, a[2] + dr * share, b[2]),
            a[3] + b[3] + dl * dl * cross,
            a[4] + b[4] + dr * dr * cross,
            a[5] + b[5] + dl * dr * cross,
            a[6] + b[6],
            np.maximum(a[7], b[7]),
            np.maximum(a[8], b[8]),
        ]
    )


def _shift(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A value near each column's values: their mean, or the value itself where all are equal."""
    held = m.any(axis=0)
    low = np.where(m, x, np.inf).min(axis=0, initial=np.inf)
    high = np.where(m, x, -np.inf).max(axis=0, initial=-np.inf)
    with np.errstate(over="ignore", invalid="ignore"):
        mean = np.where(m, x, 0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
    mean = np.where(np.isfinite(mean), mean, low)
    return np.where(held, np.where(low == high, low, mean), 0.0)


def _tiles(batch: pa.RecordBatch, blocks: list[slice], wanted: list[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    raw = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
    inf = np.isinf(raw)
    m = ~np.isnan(raw) & ~inf
    shift = _shift(raw, m)
    x = np.where(m, raw, shift) - shift
    mask, infinite = m.astype(np.float64), inf.astype(np.float64)
    out = {}
    with np.errstate(over="ignore", invalid="ignore"):
        for i, j in wanted:
            out[i, j] = _batch_tile(x, mask, infinite, shift, blocks[i], blocks[j])
    return out


def _rows(tiles: dict[tuple[int, int], np.ndarray], part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "i": pa.array([i for i, _ in tiles], pa.int32()),
            "j": pa.array([j for _, j in tiles], pa.int32()),
            "part": pa.array([part] * len(tiles), pa.int32()),
            "moments": pa.array([t.astype("<f8").tobytes() for t in tiles.values()], pa.binary()),
        }
    )


def correlations(df: DataFrame, cols: Sequence[str], tile: int = TILE, held_bytes: int = HELD_BYTES) -> DataFrame:
    """(a, b, n, r) for every ordered pair of the DOUBLE columns ``cols``.

    ``r`` is NULL when either column is constant over the ``n`` rows that have both, when there
    are none, or when one of those rows holds an infinity.
    """
    cols = list(cols)
    blocks = [slice(k, min(k + tile, len(cols))) for k in range(0, len(cols), tile)]
    every = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks))]
    each = max(1, held_bytes // (tile * tile * 8 * _FIELDS))
    rows = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    schema = "i int, j int, part int, moments binary"

    def shape(i: int, j: int) -> tuple[int, int, int]:
        return _FIELDS, blocks[i].stop - blocks[i].start, blocks[j].stop - blocks[j].start

    def scan(wanted: list[tuple[int, int]]):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                if batch.num_rows:
                    for key, t in _tiles(batch, blocks, wanted).items():
                        total[key] = merge(total[key], t) if key in total else t
            yield _rows(total, TaskContext.get().partitionId() % FOLDS)

        return task

    def merged(batches: Iterator[pa.RecordBatch]) -> tuple[tuple[int, int], np.ndarray]:
        key, total = None, None
        for batch in batches:
            for i, j, blob in zip(*[batch.column(c).to_pylist() for c in ("i", "j", "moments")]):
                t = np.frombuffer(blob, "<f8").reshape(shape(i, j))
                key, total = (i, j), t if total is None else merge(total, t)
        return key, total

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = merged(batches)
        yield _rows({key: total}, 0)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (i, j), t = merged(batches)
        n, mean_l, mean_r, left, right, both, infinite, shift_l, shift_r = t

        def flat(squares: np.ndarray, mean: np.ndarray, shift: np.ndarray) -> np.ndarray:
            return squares <= n * (16 * np.finfo(float).eps * (np.abs(mean) + shift)) ** 2

        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            r = both / (np.sqrt(left) * np.sqrt(right))
            none = flat(left, mean_l, shift_l) | flat(right, mean_r, shift_r) | (infinite > 0) | ~np.isfinite(r)
        r = np.clip(np.where(none, 0.0, r), -1.0, 1.0)
        if i == j:  # one value for both orders of a pair, whatever order its products were added in
            below = np.tril_indices(len(r), -1)
            r[below], none[below] = r.T[below], none.T[below]
        a, b = (np.array(cols[blocks[k]], object) for k in (i, j))
        a, b = np.repeat(a, len(b)), np.tile(b, len(a))
        n, r, none = n.ravel().astype(np.int64), r.ravel(), none.ravel()
        sides = [(a, b)] if i == j else [(a, b), (b, a)]
        for x, y in sides:
            yield pa.RecordBatch.from_pydict({"a": pa.array(x, pa.string()), "b": pa.array(y, pa.string()), "n": pa.array(n), "r": pa.array(r, mask=none)})

    def one(wanted: list[tuple[int, int]]) -> DataFrame:
        folded = rows.mapInArrow(scan(wanted), schema).groupBy("i", "j", "part").applyInArrow(fold, schema)
        return folded.groupBy("i", "j").applyInArrow(finish, "a string, b string, n long, r double")

    return reduce(DataFrame.unionAll, [one(every[k : k + each]) for k in range(0, len(every), each)])
