"""Schema and value contracts, and a leakage audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.runtime import as_list


@dataclass(frozen=True)
class Rule:
    """One rule of a contract.

    kind is ``type`` (args: type name), ``not_null``, ``range`` (args: low, high; None is
    open), ``in_set`` (args: the values) or ``unique`` (column may be several).
    """

    column: str | tuple[str, ...]
    kind: str
    args: Sequence[Any] = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{'+'.join(as_list(self.column))}:{self.kind}"


def _violations(df: DataFrame, rule: Rule) -> Column:
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return F.count_if(c.isNull())
    if rule.kind == "range":
        low, high = rule.args
        bad = F.lit(False)
        if low is not None:
            bad = bad | (c < low)
        if high is not None:
            bad = bad | (c > high)
        return F.count_if(bad)
    if rule.kind == "in_set":
        return F.count_if(c.isNotNull() & ~c.isin(*rule.args))
    if rule.kind == "type":
        right = df.schema[rule.column].dataType.simpleString() == rule.args[0]
        return F.lit(0).cast("long") if right else F.count(F.lit(1))
    raise ValueError(f"unknown rule kind {rule.kind}")


def contract_check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations): row-wise rules in one aggregate, uniqueness by its key.

    A ``unique`` rule counts surplus rows, after partial counting per key; as in SQL, keys
    that hold a NULL are not compared.  No rules give no rows.
    """
    row_rules = [r for r in rules if r.kind != "unique"]
    parts = []
    if row_rules:
        found = [F.struct(F.lit(r.name).alias("rule"), _violations(df, r).alias("violations")) for r in row_rules]
        parts.append(df.agg(F.array(*found).alias("f")).select(F.inline("f")))
    for rule in rules:
        if rule.kind == "unique":
            parts.append(
                df.dropna(subset=as_list(rule.column))
                .groupBy(*as_list(rule.column))
                .agg((F.count(F.lit(1)) - 1).alias("surplus"))
                .agg(F.coalesce(F.sum("surplus"), F.lit(0)).cast("long").alias("violations"))
                .select(F.lit(rule.name).alias("rule"), "violations")
            )
    if not parts:
        return df.sparkSession.createDataFrame([], "rule string, violations long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def leak_audit(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """(column, n_values, n_rows, purity, pct_determined) per categorical column.

    ``purity`` is the share of rows whose label is the majority label of their value;
    ``pct_determined`` the percentage of rows whose value occurs with one label only.  Both
    at their maximum mean the column gives the label away.
    """
    cells = (
        df.select(F.col(label).cast("string").alias("label"), *[F.col(c).cast("string").alias(f"c_{c}") for c in cols])
        .unpivot(["label"], [f"c_{c}" for c in cols], "column", "value")
        .groupBy("column", "value", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    values = cells.groupBy("column", "value").agg(
        F.sum("n").alias("rows"), F.max("n").alias("top"), F.count(F.lit(1)).alias("labels")
    )
    rows = F.sum("rows").cast("double")
    return values.groupBy(F.substring("column", 3, 1_000_000).alias("column")).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.sum("rows").alias("n_rows"),
        (F.sum("top") / rows).alias("purity"),
        (F.sum(F.when(F.col("labels") == 1, F.col("rows")).otherwise(0)) * 100 / rows).alias("pct_determined"),
    )
