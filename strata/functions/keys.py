"""Column expressions that turn row keys into reproducible randomness.

A random choice made from a hash of the row's own key gives the same answer however the
table is partitioned and whichever task is retried, which ``rand`` and ``randomSplit``
cannot promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def check_key(df: DataFrame, key: Sequence[str]) -> None:
    """Keys must be named and have one text form, which binary floating point has not."""
    if not key:
        raise ValueError("name the columns that identify a row")
    for name in key:
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            raise TypeError(f"key column {name} is floating point; use an integer or string key")


def row_hash(key: Sequence[str], seed: int) -> Column:
    """32 hex digits: md5 of ``seed:key[:key...]``; a NULL holds its place as a zero byte."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def uniform(hash_col: Column) -> Column:
    """The first 13 hex digits of a hash as a DOUBLE in [0, 1): all 52 bits a DOUBLE holds apart."""
    return F.conv(F.substring(hash_col, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def stratum_id(cols: Sequence[str]) -> Column:
    """One non-NULL string per combination of values, NULL included, without collisions.

    ``concat_ws`` skips NULL and lets ('A_B','C') meet ('A','B_C'); length prefixes do not.
    Being non-NULL it can be an ordinary equi-join key.
    """
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.concat(*parts)
