"""Accent-free lower case text."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


_NON_ASCII = re.compile(r"[^\x00-\x7F]+")


@lru_cache(maxsize=65_536)
def _without_marks(run: str) -> str:
    return "".join(ch for ch in run if not unicodedata.combining(ch))


def _fold(text: str) -> str:
    """Only the runs outside ASCII, mostly single marks after decomposition, are looked at."""
    return _NON_ASCII.sub(lambda run: _without_marks(run[0]), unicodedata.normalize("NFKD", text)).lower()


@F.pandas_udf(StringType())
def _decompose_and_lower(texts: pd.Series) -> pd.Series:
    return texts.map(_fold, na_action="ignore")


def fold_text(col: str | Column) -> Column:
    """NFKD, combining marks removed, lower case; NULL stays NULL.

    Pure ASCII text needs only ``lower`` and stays in the JVM: the Arrow batches carry a
    NULL in its place, so the Python side sees accented rows alone.
    """
    text = F.col(col) if isinstance(col, str) else col
    ascii_only = ~text.rlike(r"[^\x00-\x7F]")
    return F.when(ascii_only, F.lower(text)).otherwise(
        _decompose_and_lower(F.when(~ascii_only, text))
    )
