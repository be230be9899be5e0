"""Text-to-value expressions.  Bad text gives NULL under ANSI mode instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_to_double(col: str | Column) -> Column:
    """``"13.5%"`` to 13.5."""
    return F.regexp_replace(col, "%", "").try_cast("double")


def to_double(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")


def first_int(col: str | Column) -> Column:
    """The first run of digits: ``"10+ years"`` to 10, no digits to NULL."""
    return F.regexp_extract(col, r"\d+", 0).try_cast("int")


def month_text_date(col: str | Column) -> Column:
    """``"Dec-2015"`` to the first day of that month."""
    return F.try_to_date(F.concat(F.lit("01-"), col), "dd-MMM-yyyy")


def month_text_year(col: str | Column) -> Column:
    return F.year(month_text_date(col))
