"""Cleaning and derivation over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import balance, clean, derive, joins
from strata.plans import cleaning as plan
from strata.plans.catalog.registry import query
from strata.plans.loan_view import LOAN_VIEW_SQL, loan_view, order_view, table

LV = "WITH " + LOAN_VIEW_SQL


@query(LV + "\nSELECT loan_id, try_cast(replace(int_rate, '%', '') AS DOUBLE) AS int_rate FROM lv")
def percent_to_double(spark, sf):
    return clean.percent_to_double(order_view(spark, sf).select("loan_id", "int_rate"), "int_rate")


@query(
    LV
    + """
SELECT loan_id, try_cast(int_rate AS DOUBLE) AS int_rate, CAST(dti AS DOUBLE) AS dti,
       try_cast(substr(issue_d, 5) AS DOUBLE) AS issue_d FROM lv"""
)
def cast_double(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "int_rate", "dti", F.substring("issue_d", 5, 4).alias("issue_d"))
    return clean.to_double(lv, ["int_rate", "dti", "issue_d"])


@query(
    LV
    + """
SELECT loan_id, loan_amnt, int_rate, loan_status FROM lv
WHERE loan_amnt IS NOT NULL AND int_rate IS NOT NULL AND loan_status IS NOT NULL"""
)
def drop_nulls(spark, sf):
    cols = ["loan_amnt", "int_rate", "loan_status"]
    return clean.drop_nulls(order_view(spark, sf).select("loan_id", *cols), cols)


@query(
    LV
    + """
SELECT loan_id, coalesce(loan_status, 'missing') AS loan_status, coalesce(int_rate, 'missing') AS int_rate,
       coalesce(loan_amnt, 0.0) AS loan_amnt FROM lv"""
)
def fill_constant(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "loan_status", "int_rate", "loan_amnt")
    return clean.fill_constant(clean.fill_constant(lv, "missing", ["loan_status", "int_rate"]), 0.0, "loan_amnt")


@query(
    LV
    + """, typed AS (SELECT loan_id, loan_amnt, try_cast(replace(int_rate, '%', '') AS DOUBLE) AS int_rate FROM lv)
SELECT loan_id, round(coalesce(loan_amnt, (SELECT quantile_cont(loan_amnt, 0.5) FROM typed)), 4) AS loan_amnt,
       round(coalesce(int_rate, (SELECT quantile_cont(int_rate, 0.5) FROM typed)), 4) AS int_rate FROM typed"""
)
def impute_median(spark, sf):
    lv = clean.percent_to_double(order_view(spark, sf).select("loan_id", "loan_amnt", "int_rate"), "int_rate")
    out = clean.impute_median(lv, ["loan_amnt", "int_rate"])
    return out.withColumns({c: F.round(c, 4) for c in ("loan_amnt", "int_rate")})


@query(LV + "\nSELECT loan_id, nullif(dti, 999) AS dti FROM lv")
def sentinel_null(spark, sf):
    return clean.sentinel_to_null(order_view(spark, sf).select("loan_id", "dti"), {"dti": 999})


@query(
    """
WITH b AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events)
SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value
FROM events, b"""
)
def winsorize(spark, sf):
    out = clean.winsorize(table(spark, sf, "events").select("event_id", "value"), "value")
    return out.withColumn("value", F.round("value", 6))


@query(
    """
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.05) AS lo1, quantile_cont(l_extendedprice, 0.95) AS hi1,
                  quantile_cont(l_quantity, 0.05) AS lo2, quantile_cont(l_quantity, 0.95) AS hi2 FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       round(least(greatest(l_extendedprice, lo1), hi1), 6) AS l_extendedprice,
       round(least(greatest(l_quantity, lo2), hi2), 6) AS l_quantity
FROM lineitem, b"""
)
def winsorize_many(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    cols = ["l_extendedprice", "l_quantity"]
    out = clean.winsorize(table(spark, sf, "lineitem").select(*keys, *cols), cols, 0.05, 0.95)
    return out.withColumns({c: F.round(c, 6) for c in cols})


@query("SELECT doc_id, lower(strip_accents(text)) AS text FROM documents")
def normalize_text(spark, sf):
    return clean.normalize_text(table(spark, sf, "documents").select("doc_id", "text"), "text")


_TOP_SQL = """
SELECT {c} AS v FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT {k}"""


@query(
    "SELECT p_partkey, CASE WHEN p_name IN (" + _TOP_SQL.format(c="p_name", t="part", k=10)
    + ") THEN p_name ELSE 'other' END AS p_name, CASE WHEN p_brand IN ("
    + _TOP_SQL.format(c="p_brand", t="part", k=10)
    + ") THEN p_brand ELSE 'other' END AS p_brand FROM part"
)
def top_k_categories(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return clean.top_k_categories(part, ["p_name", "p_brand"], k=10)


@query(
    """
WITH c AS (SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 2
           UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2)
SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INTEGER) AS rank
FROM c QUALIFY rank <= 2"""
)
def top_values(spark, sf):
    return clean.top_values(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], 2)


@query(LV + "\nSELECT loan_id, CASE WHEN loan_status IN ('F', 'P') THEN 1 ELSE 0 END AS flag FROM lv")
def binary_flag(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "loan_status")
    return derive.binary_flag(lv, "loan_status", ["F", "P"], "flag").drop("loan_status")


@query(LV + "\nSELECT loan_id, concat_ws('_', grade, loan_status) AS grade_status FROM lv")
def stratum_key(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "grade", "loan_status")
    return derive.stratum_key(lv, ["grade", "loan_status"], "grade_status").select("loan_id", "grade_status")


@query(LV + "\nSELECT loan_id, round(loan_amnt / nullif(annual_inc + 1, 0), 6) AS loan_to_income FROM lv")
def ratio(spark, sf):
    lv = loan_view(spark, sf).select("loan_id", "loan_amnt", "annual_inc")
    out = derive.ratio(lv, "loan_amnt", "annual_inc", "loan_to_income")
    return out.select("loan_id", F.round("loan_to_income", 6).alias("loan_to_income"))


@query(
    LV
    + """
SELECT loan_id, CAST(year(try_strptime('01-' || issue_d, '%d-%b-%Y'))
                     - year(try_strptime('01-' || earliest_cr_line, '%d-%b-%Y')) AS INTEGER) AS credit_age FROM lv"""
)
def credit_age(spark, sf):
    lv = loan_view(spark, sf).select("loan_id", "issue_d", "earliest_cr_line")
    return derive.years_between_months(lv, "issue_d", "earliest_cr_line", "credit_age").select("loan_id", "credit_age")


@query(LV + "\nSELECT loan_id, CAST(year(try_strptime('01-' || issue_d, '%d-%b-%Y')) AS INTEGER) AS issue_year FROM lv")
def month_year(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "issue_d")
    return derive.month_text_year(lv, "issue_d", "issue_year").drop("issue_d")


@query(
    LV
    + """
SELECT loan_id, try_cast(regexp_extract(grade, '\\d+', 0) AS INTEGER) AS grade_num,
       try_cast(regexp_extract(home_ownership, '\\d+', 0) AS INTEGER) AS none_num FROM lv"""
)
def first_int(spark, sf):
    lv = loan_view(spark, sf).select("loan_id", "grade", "home_ownership")
    out = derive.first_int(derive.first_int(lv, "grade", "grade_num"), "home_ownership", "none_num")
    return out.select("loan_id", "grade_num", "none_num")


@query(
    LV
    + """
SELECT grade, loan_status, loan_amnt, int_rate, annual_inc, dti FROM lv
WHERE grade = '2-HIGH' AND loan_status = 'F' ORDER BY loan_id LIMIT 3"""
)
def filter_project_show(spark, sf):
    return (
        loan_view(spark, sf)
        .filter((F.col("grade") == "2-HIGH") & (F.col("loan_status") == "F"))
        .orderBy("loan_id")
        .limit(3)
        .select("grade", "loan_status", "loan_amnt", "int_rate", "annual_inc", "dti")
    )


@query(
    """
WITH n AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT quality, n, round(CAST((SELECT sum(n) FROM n) AS DOUBLE) / ((SELECT count(*) FROM n) * n), 6) AS weight FROM n"""
)
def class_weights(spark, sf):
    return balance.class_weights(table(spark, sf, "labels"), "quality").withColumn("weight", F.round("weight", 6))


@query(
    LV
    + """, n AS (SELECT loan_status, count(*) AS n FROM lv WHERE loan_status IS NOT NULL GROUP BY 1)
SELECT loan_id, lv.loan_status,
       round(CAST((SELECT sum(n) FROM n) AS DOUBLE) / ((SELECT count(*) FROM n) * n.n), 6) AS weight
FROM lv LEFT JOIN n ON lv.loan_status = n.loan_status"""
)
def add_class_weight(spark, sf):
    lv = order_view(spark, sf).select("loan_id", "loan_status")
    return balance.add_class_weight(lv, "loan_status").withColumn("weight", F.round("weight", 6))


@query(
    """
SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance, NULL AS name FROM customer
UNION ALL BY NAME SELECT s_suppkey AS id, s_acctbal AS balance, s_name AS name FROM supplier"""
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return joins.union_by_name(customers, suppliers)


@query(
    "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier"
)
def union_all(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return customers.union(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"))


@query(LV + "\nSELECT DISTINCT grade, loan_status FROM lv")
def distinct_strata(spark, sf):
    return joins.distinct_rows(order_view(spark, sf), ["grade", "loan_status"])


@query(
    LV
    + """, typed AS (
  SELECT * REPLACE (try_cast(replace(int_rate, '%', '') AS DOUBLE) AS int_rate,
                    CAST(nullif(dti, 999) AS DOUBLE) AS dti) FROM lv),
med AS (SELECT quantile_cont(loan_amnt, .5) AS m1, quantile_cont(int_rate, .5) AS m2,
               quantile_cont(annual_inc, .5) AS m3, quantile_cont(dti, .5) AS m4 FROM typed),
filled AS (
  SELECT loan_id, coalesce(loan_amnt, m1) AS loan_amnt, coalesce(int_rate, m2) AS int_rate,
         coalesce(annual_inc, m3) AS annual_inc, coalesce(dti, m4) AS dti,
         coalesce(grade, 'missing') AS grade, coalesce(loan_status, 'missing') AS loan_status,
         coalesce(home_ownership, 'missing') AS home_ownership, issue_d, earliest_cr_line FROM typed, med),
b AS (SELECT quantile_cont(loan_amnt, .01) AS l1, quantile_cont(loan_amnt, .99) AS h1,
             quantile_cont(int_rate, .01) AS l2, quantile_cont(int_rate, .99) AS h2,
             quantile_cont(annual_inc, .01) AS l3, quantile_cont(annual_inc, .99) AS h3,
             quantile_cont(dti, .01) AS l4, quantile_cont(dti, .99) AS h4 FROM filled),
clipped AS (
  SELECT * REPLACE (least(greatest(loan_amnt, l1), h1) AS loan_amnt, least(greatest(int_rate, l2), h2) AS int_rate,
                    least(greatest(annual_inc, l3), h3) AS annual_inc, least(greatest(dti, l4), h4) AS dti)
  FROM filled, b),
g AS (SELECT grade AS v FROM filled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
s AS (SELECT loan_status AS v FROM filled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
o AS (SELECT home_ownership AS v FROM filled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
SELECT loan_id, round(loan_amnt, 4) AS loan_amnt, round(annual_inc, 4) AS annual_inc, round(int_rate, 4) AS int_rate,
       CASE WHEN grade IN (FROM g) THEN grade ELSE 'other' END AS grade,
       CASE WHEN loan_status IN (FROM s) THEN loan_status ELSE 'other' END AS loan_status,
       CASE WHEN home_ownership IN (FROM o) THEN home_ownership ELSE 'other' END AS home_ownership,
       issue_d, earliest_cr_line, round(dti, 4) AS dti,
       CASE WHEN loan_status IN ('F') THEN 1 ELSE 0 END AS default_flag,
       concat_ws('_', grade, loan_status) AS grade_status,
       round(loan_amnt / nullif(annual_inc + 1, 0), 4) AS loan_to_income,
       CAST(year(try_strptime('01-' || issue_d, '%d-%b-%Y'))
            - year(try_strptime('01-' || earliest_cr_line, '%d-%b-%Y')) AS INTEGER) AS credit_age
FROM clipped"""
)
def cleaned_loans(spark, sf):
    roles = plan.LoanRoles(positives=("F",), sentinels={"dti": 999}, top_k=3)
    out = plan.prepare(loan_view(spark, sf).drop("default_flag"), roles)
    return out.withColumns(
        {c: F.round(c, 4) for c in ("loan_amnt", "annual_inc", "int_rate", "dti", "loan_to_income")}
    )
