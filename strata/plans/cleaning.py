"""The cleaning plan: raw loan rows to the processed table.

Statistics are learned once (``learn``) and applied as plain numbers (``apply``), so the
table itself is read once more and written without a shuffle, and rows that arrive later
are treated exactly like those the statistics came from.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import parse, text
from strata.operators import clean, derive
from strata.operators.quantiles import quantile_map


@dataclass(frozen=True)
class LoanRoles:
    """Which column plays which part.  Columns a table lacks are skipped."""

    # Column names of the loan table and the labels that mean default.
    categorical: Sequence[str] = (
        "term", "grade", "emp_length", "home_ownership", "verification_status", "purpose", "loan_status",
    )
    numeric: Sequence[str] = (
        "loan_amnt", "int_rate", "installment", "fico_range_low", "fico_range_high", "annual_inc",
        "dti", "open_acc", "total_acc", "revol_bal", "revol_util",
    )
    percent: Sequence[str] = ("int_rate", "revol_util")
    clipped: Sequence[str] = ("annual_inc", "dti", "loan_amnt", "int_rate", "revol_util")
    positives: Sequence[str] = ("Charged Off", "Default")
    strata: Sequence[str] = ("grade", "loan_status")
    index_columns: Sequence[str] = ("_c0",)
    free_text: Sequence[str] = ("emp_title",)
    sentinels: dict = field(default_factory=dict)
    top_k: int = 100

    def present(self, df: DataFrame, names: Sequence[str]) -> list[str]:
        return [c for c in names if c in df.columns]


@dataclass(frozen=True)
class CleaningStats:
    medians: dict[str, float | None]
    bounds: dict[str, list[float | None]]


def typed(df: DataFrame, roles: LoanRoles) -> DataFrame:
    """Numbers parsed, error markers removed, the index column gone."""
    df = df.drop(*roles.index_columns)
    numeric = roles.present(df, roles.numeric)
    df = df.withColumns(
        {c: parse.percent_to_double(c) if c in roles.percent else parse.to_double(c) for c in numeric}
    )
    return clean.sentinel_to_null(df, roles.sentinels) if roles.sentinels else df


def learn(df: DataFrame, roles: LoanRoles = LoanRoles(), accuracy: int | None = None) -> CleaningStats:
    """Medians of the parsed numbers, then clip bounds of the imputed ones.

    The numbers are parsed once and kept (spilling to disk) while the passes run.
    """
    numeric = roles.present(df, roles.numeric)
    clipped = roles.present(df, roles.clipped)
    rows = typed(df, roles).select(*numeric).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        medians = {c: v[0] for c, v in quantile_map(rows, numeric, [0.5], accuracy).items()}
        imputed = clean.impute_median(rows, numeric, medians=medians)
        return CleaningStats(medians, quantile_map(imputed, clipped, [0.01, 0.99], accuracy))
    finally:
        rows.unpersist()


def apply(df: DataFrame, stats: CleaningStats, roles: LoanRoles = LoanRoles()) -> DataFrame:
    """The processed table.  Label and stratum come before rare categories are collapsed."""
    df = typed(df, roles)
    categorical = roles.present(df, roles.categorical)
    df = clean.impute_median(df, roles.present(df, roles.numeric), medians=stats.medians)
    df = clean.fill_constant(df, "missing", categorical)
    if "loan_status" in df.columns:
        df = derive.binary_flag(df, "loan_status", roles.positives, "default_flag")
        df = derive.stratum_key(df, roles.present(df, roles.strata), "grade_status")
    df = clean.winsorize(df, roles.present(df, roles.clipped), bounds=stats.bounds)
    new = {}
    if {"loan_amnt", "annual_inc"} <= set(df.columns):
        new["loan_to_income"] = F.try_divide("loan_amnt", F.col("annual_inc") + 1.0)
    if {"issue_d", "earliest_cr_line"} <= set(df.columns):
        new["credit_age"] = parse.month_text_year("issue_d") - parse.month_text_year("earliest_cr_line")
    new.update({c: text.fold_text(c) for c in roles.present(df, roles.free_text)})
    return clean.top_k_categories(df.withColumns(new), categorical, roles.top_k)


def prepare(df: DataFrame, roles: LoanRoles = LoanRoles(), accuracy: int | None = None) -> DataFrame:
    return apply(df, learn(df, roles, accuracy), roles)
