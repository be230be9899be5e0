"""Derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from strata.functions import parse
from strata.runtime import as_list


def binary_flag(df: DataFrame, col: str, positives: Sequence[str], out: str) -> DataFrame:
    """1 where ``col`` is one of ``positives``, else 0 (NULL included)."""
    return df.withColumn(out, F.when(F.col(col).isin(*positives), 1).otherwise(0))


def stratum_key(df: DataFrame, cols: Sequence[str], out: str, sep: str = "_") -> DataFrame:
    """A readable stratum label.  It skips NULL and may collide; group by the columns themselves."""
    return df.withColumn(out, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))


def ratio(df: DataFrame, num: str, den: str, out: str, offset: float = 1.0) -> DataFrame:
    """``num / (den + offset)``; a zero denominator gives NULL."""
    return df.withColumn(out, F.try_divide(F.col(num), F.col(den) + F.lit(offset)))


def years_between_months(df: DataFrame, later: str, earlier: str, out: str) -> DataFrame:
    """Difference of the years in two month texts such as ``Dec-2015``."""
    return df.withColumn(out, parse.month_text_year(later) - parse.month_text_year(earlier))


def month_text_year(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, parse.month_text_year(col))


def first_int(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, parse.first_int(col))


def feature_columns(
    df: DataFrame, target: str, exclude: str | Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names by type.

    The target and everything in ``exclude`` stay out: the columns a label was computed
    from, keys and weights must not come back as features.
    """
    out = {target, *as_list(exclude)}
    kept = [f for f in df.schema.fields if f.name not in out]
    numeric = [f.name for f in kept if isinstance(f.dataType, NumericType)]
    categorical = [f.name for f in kept if isinstance(f.dataType, StringType)]
    return numeric, categorical
