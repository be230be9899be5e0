"""The loan table played by the order tables, and the same view as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import read_table

LABEL_SOURCES = ("loan_status",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _order_columns() -> dict[str, Column]:
    key = F.col("o_orderkey")
    status = F.when(key % 13 != 0, F.col("o_orderstatus"))
    rate = (
        F.when(key % 11 == 0, F.lit(None))
        .when(key % 101 == 1, F.lit("n/a"))
        .otherwise(F.concat((key % 31).cast("string"), F.lit("%")))
    )
    return {
        "loan_id": key,
        "loan_amnt": F.when(key % 7 != 0, F.col("o_totalprice")),
        "int_rate": rate,
        "grade": F.col("o_orderpriority"),
        "loan_status": status,
        "default_flag": F.when(status == "F", 1).otherwise(0),
        "issue_d": F.date_format("o_orderdate", "MMM-yyyy"),
        "dti": F.when(key % 50 == 0, F.lit(999)).otherwise((key % 40).cast("int")),
    }


def order_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan view without the columns of the customer: a projection of the orders, no join.

    Every order has its customer, so the rows are those of ``loan_view``.
    """
    return table(spark, sf_dir, "orders").select(*[c.alias(name) for name, c in _order_columns().items()])


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the customer's attributes; see FIXTURES.md section 3.

    The customer side carries the earliest order of each customer, so the order table meets
    one unique-key table in one join.
    """
    orders = table(spark, sf_dir, "orders")
    earliest = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first_order"))
    customers = table(spark, sf_dir, "customer").join(earliest, "c_custkey")
    columns = _order_columns() | {
        "annual_inc": F.col("c_acctbal"),
        "home_ownership": F.col("c_mktsegment"),
        "earliest_cr_line": F.date_format("first_order", "MMM-yyyy"),
    }
    names = [
        "loan_id", "loan_amnt", "annual_inc", "int_rate", "grade", "loan_status", "default_flag",
        "home_ownership", "issue_d", "earliest_cr_line", "dti",
    ]
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(*[columns[n].alias(n) for n in names])


LOAN_VIEW_SQL = """
first_order AS (
  SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey
),
lv AS (
  SELECT o.o_orderkey AS loan_id,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice END AS loan_amnt,
         c.c_acctbal AS annual_inc,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
              WHEN o.o_orderkey % 101 = 1 THEN 'n/a'
              ELSE concat(CAST(o.o_orderkey % 31 AS VARCHAR), '%') END AS int_rate,
         o.o_orderpriority AS grade,
         CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderstatus END AS loan_status,
         CASE WHEN o.o_orderkey % 13 <> 0 AND o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS default_flag,
         c.c_mktsegment AS home_ownership,
         strftime(o.o_orderdate, '%b-%Y') AS issue_d,
         strftime(f.first_order, '%b-%Y') AS earliest_cr_line,
         CAST(CASE WHEN o.o_orderkey % 50 = 0 THEN 999 ELSE o.o_orderkey % 40 END AS INTEGER) AS dti
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN first_order f ON f.o_custkey = o.o_custkey
)"""
