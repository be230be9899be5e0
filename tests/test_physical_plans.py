"""What the plans must look like to hold up on large tables."""

import re

from pyspark.sql import functions as F

from strata.operators import clean, evaluate, profile, sampling
from strata.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def wide(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = physical(QUERIES["parquet_scan"](spark, SF_DIR))
    assert "GreaterThan(o_totalprice,100000.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"o_orderkey", "o_totalprice", "o_orderstatus"}


def test_the_split_never_shuffles_the_table_itself(spark):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    marked = sampling.mark_stratified_test(wide(spark), "l_returnflag", 0.2, 1, keys)
    plan = physical(marked)
    # Columns that only pass through occur in the top join's streamed side, under no exchange.
    shuffled = [line for line in plan.splitlines() if "l_extendedprice" in line and "Exchange" in line]
    assert shuffled == [] and "BroadcastHashJoin" in plan


def test_cleaning_applies_statistics_in_one_map_only_pass(spark):
    out = clean.winsorize(clean.impute_median(wide(spark), "l_tax"), ["l_extendedprice", "l_quantity"])
    assert "Exchange" not in physical(out)


def test_ranking_computes_the_score_counts_once(spark):
    df = wide(spark).select("l_extendedprice", F.col("l_linenumber").isin(1, 2).cast("int").alias("y"))
    out = evaluate.ranking_metrics(df, "y", "l_extendedprice")
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_profiles_merge_one_row_per_task(spark):
    plan = physical(profile.null_profile(wide(spark)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_top_values_limits_ranks_before_the_shuffle(spark):
    assert "WindowGroupLimit" in physical(clean.top_values(wide(spark), ["l_returnflag"], 2))
