"""Evaluation of fixed scores, and drift, over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import drift, evaluate, models, sampling
from strata.operators.features import array_to_features
from strata.plans.catalog.registry import query
from strata.plans.loan_view import table
from strata.runtime import scratch_path
from strata.sources import read_table, write_table

DOCS_SQL = """
docs AS (SELECT d.doc_id, d.lang, d.n_chars, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score,
                CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS prediction
         FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def scored_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(labels, "doc_id").withColumns(
        {
            "score": F.col("n_chars").cast("double"),
            "prediction": F.when(F.col("n_chars") >= 1000, 1).otherwise(0),
        }
    )


LINES_SQL = """
lines AS (SELECT l_linestatus, l_discount, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
          FROM lineitem)"""


def scored_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_linestatus",
        "l_discount",
        "l_extendedprice",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )


def curve_sql(source: str, score: str, by: str = "") -> str:
    """CTEs ``curve`` (running counts per score) and ``area`` (auc, pr_auc) in DuckDB."""
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""
sc AS (SELECT {lead}CAST({score} AS DOUBLE) AS score, CAST(sum(label) AS DOUBLE) AS pos,
              CAST(sum(1 - label) AS DOUBLE) AS neg FROM {source} GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC) AS tp, sum(neg) OVER ({part}ORDER BY score DESC) AS fp,
                 sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n FROM sc),
area AS (SELECT {lead}
           CASE WHEN max(p) > 0 AND max(n) > 0 THEN round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), 8) END AS auc,
           CASE WHEN max(p) > 0 AND max(n) > 0 THEN round(sum(pos * tp / (tp + fp)) / max(p), 8) END AS pr_auc
         FROM curve{group})"""


def _r8(df, *cols):
    return df.withColumns({c: F.round(c, 8) for c in cols})


@query(
    "WITH"
    + DOCS_SQL
    + """
SELECT a.c AS label, b.c AS prediction, count(doc_id) AS n
FROM (SELECT unnest([0, 1]) AS c) a CROSS JOIN (SELECT unnest([0, 1]) AS c) b
LEFT JOIN docs ON docs.label = a.c AND docs.prediction = b.c GROUP BY ALL"""
)
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(scored_documents(spark, sf))


_BINARY_SQL = """
cm AS (SELECT {by} count(*) AS n, count(*) FILTER (label = prediction) AS hit,
              CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
              count(*) FILTER (label = 0 AND prediction = 1) AS fp,
              count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM docs {group}),
bm AS (SELECT {by} round(CAST(hit AS DOUBLE) / n, 8) AS accuracy,
              round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision,
              round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall,
              round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1 FROM cm)"""


@query("WITH" + DOCS_SQL + "," + _BINARY_SQL.format(by="", group="") + "\nSELECT * FROM bm")
def binary_metrics(spark, sf):
    return _r8(evaluate.binary_metrics(scored_documents(spark, sf)), "accuracy", "precision", "recall", "f1")


@query(
    """
WITH ev AS (SELECT CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END AS label,
                   CASE WHEN value >= 60 THEN 2 WHEN value >= 30 THEN 1 ELSE 0 END AS prediction FROM events),
c AS (SELECT label AS class, count(*) AS actual FROM ev GROUP BY 1),
s AS (SELECT prediction AS class, count(*) AS said, count(*) FILTER (label = prediction) AS tp FROM ev GROUP BY 1)
SELECT round(sum(actual * coalesce(CAST(tp AS DOUBLE) / nullif(said, 0), 0)) / sum(actual), 8) AS weighted_precision,
       round(CAST(sum(coalesce(tp, 0)) AS DOUBLE) / sum(actual), 8) AS accuracy
FROM c LEFT JOIN s ON c.class = s.class"""
)
def weighted_precision(spark, sf):
    kind = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2).otherwise(0)
    said = F.when(F.col("value") >= 60, 2).when(F.col("value") >= 30, 1).otherwise(0)
    rows = table(spark, sf, "events").select(kind.alias("label"), said.alias("prediction"))
    return _r8(evaluate.weighted_precision(rows), "weighted_precision", "accuracy")


@query("WITH" + DOCS_SQL + "," + curve_sql("docs", "score") + "\nSELECT auc FROM area")
def roc_auc(spark, sf):
    return _r8(evaluate.roc_auc(scored_documents(spark, sf), "label", "score"), "auc")


@query("WITH" + LINES_SQL + "," + curve_sql("lines", "l_discount", "l_linestatus") + "\nSELECT l_linestatus, auc, pr_auc FROM area")
def ranking_metrics_ties(spark, sf):
    got = evaluate.ranking_metrics(scored_lines(spark, sf), "label", "l_discount", by="l_linestatus")
    return _r8(got, "auc", "pr_auc")


@query("WITH" + LINES_SQL + "," + curve_sql("lines", "l_extendedprice") + "\nSELECT auc, pr_auc FROM area")
def ranking_metrics_continuous(spark, sf):
    return _r8(evaluate.ranking_metrics(scored_lines(spark, sf), "label", "l_extendedprice"), "auc", "pr_auc")


@query("WITH" + LINES_SQL + "," + curve_sql("lines", "l_discount") + "\nSELECT pr_auc FROM area")
def average_precision(spark, sf):
    return _r8(evaluate.average_precision(scored_lines(spark, sf), "label", "l_discount"), "pr_auc")


@query(
    "WITH"
    + DOCS_SQL
    + ","
    + curve_sql("docs", "score")
    + """
SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL SELECT score, fp / n, tp / p FROM curve"""
)
def roc_curve(spark, sf):
    return evaluate.roc_curve(scored_documents(spark, sf), "label", "score")


@query(
    "WITH"
    + LINES_SQL
    + ","
    + curve_sql("lines", "l_extendedprice", "l_linestatus")
    + """
SELECT DISTINCT l_linestatus, CAST(NULL AS DOUBLE) AS threshold, CAST(1 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall
FROM lines UNION ALL
SELECT l_linestatus, score, tp / (tp + fp), tp / p FROM curve"""
)
def pr_curve(spark, sf):
    return evaluate.pr_curve(scored_lines(spark, sf), "label", "l_extendedprice", by="l_linestatus")


@query(
    "WITH"
    + DOCS_SQL
    + ","
    + _BINARY_SQL.format(by="lang,", group="GROUP BY lang")
    + ","
    + curve_sql("docs", "score", "lang")
    + """
SELECT lang, metric, value FROM (SELECT bm.*, auc, pr_auc FROM bm JOIN area ON bm.lang = area.lang)
UNPIVOT INCLUDE NULLS (value FOR metric IN (accuracy, precision, recall, f1, auc, pr_auc))"""
)
def metric_set(spark, sf):
    return _r8(evaluate.metric_set(scored_documents(spark, sf), by="lang"), "value")


RUNS_SQL = (
    "WITH"
    + DOCS_SQL
    + """,
folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || doc_id), doc_id) - 1) * 3
                          // count(*) OVER (PARTITION BY label) AS INTEGER) AS fold FROM docs),
scored AS (SELECT 'long' AS model, fold, label, CAST(n_chars AS DOUBLE) AS score FROM folded
           UNION ALL SELECT 'short', fold, label, -CAST(n_chars AS DOUBLE) FROM folded
           UNION ALL SELECT 'late', fold, label, CAST(doc_id AS DOUBLE) FROM folded),"""
    + curve_sql("scored", "score", "model, fold")
    + ", runs AS (SELECT model || '-' || fold AS run_id, model, fold, auc, pr_auc FROM area)"
)


def scored_runs(spark, sf):
    """One run per scoring rule and fold: (run_id, model, fold, auc, pr_auc)."""
    docs = scored_documents(spark, sf).select("doc_id", "n_chars", "label")
    folded = sampling.stratified_kfolds(docs, "label", 3, 42, "doc_id")
    scores = F.inline(
        F.array(
            F.struct(F.lit("long").alias("model"), F.col("n_chars").cast("double").alias("score")),
            F.struct(F.lit("short").alias("model"), (-F.col("n_chars")).cast("double").alias("score")),
            F.struct(F.lit("late").alias("model"), F.col("doc_id").cast("double").alias("score")),
        )
    )
    rows = folded.select("label", "fold", scores)
    found = evaluate.ranking_metrics(rows, "label", "score", by=["model", "fold"])
    return _r8(found, "auc", "pr_auc").withColumn("run_id", F.concat_ws("-", "model", "fold"))


def _long_runs(spark, sf):
    return scored_runs(spark, sf).unpivot(["model", "fold"], ["auc", "pr_auc"], "metric", "value")


_LONG_RUNS_SQL = """, long AS (SELECT model, fold, 'auc' AS metric, auc AS value FROM runs
                     UNION ALL SELECT model, fold, 'pr_auc', pr_auc FROM runs)"""


@query(
    RUNS_SQL
    + _LONG_RUNS_SQL
    + """
SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stddev, count(value) AS n
FROM long GROUP BY ALL"""
)
def fold_summary(spark, sf):
    got = evaluate.summarize_folds(_long_runs(spark, sf), by="model")
    return got.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    RUNS_SQL
    + """
SELECT model, round(avg(auc), 4) AS auc, round(avg(pr_auc), 4) AS pr_auc FROM runs GROUP BY model"""
)
def model_comparison(spark, sf):
    means = _long_runs(spark, sf).groupBy("model", "metric").agg(F.avg("value").alias("value"))
    return evaluate.model_comparison(means, ["auc", "pr_auc"])


@query(RUNS_SQL + "\nSELECT run_id, model, fold, auc, pr_auc FROM runs ORDER BY auc DESC NULLS LAST, run_id LIMIT 1")
def best_run(spark, sf):
    return evaluate.best_run(scored_runs(spark, sf), "auc")


@query(
    RUNS_SQL
    + """
SELECT run_id, model, fold, auc, pr_auc FROM runs
QUALIFY row_number() OVER (PARTITION BY model ORDER BY auc DESC NULLS LAST, run_id) = 1"""
)
def best_per_model(spark, sf):
    return evaluate.best_per_model(scored_runs(spark, sf), "auc")


_POINTS_SQL = """
WITH pts AS (SELECT vec_id, label, unnest(embedding) AS xf, unnest(range(len(embedding))) AS dim FROM embeddings),
pt AS (SELECT vec_id, label, dim, CAST(xf AS DOUBLE) AS x FROM pts),
cd AS (SELECT label, dim, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM pt GROUP BY ALL)"""


@query(_POINTS_SQL + "\nSELECT round(sum(q - s * s / n), 4) AS wssse FROM cd")
def wssse_given_labels(spark, sf):
    got = evaluate.wssse(table(spark, sf, "embeddings"), "label", "embedding")
    return got.select(F.round("wssse", 4).alias("wssse"))


@query(
    _POINTS_SQL
    + """,
c AS (SELECT label, max(n) AS n, sum(q) / max(n) AS msq FROM cd GROUP BY 1),
norm AS (SELECT vec_id, label, sum(x * x) AS sq FROM pt GROUP BY ALL),
dot AS (SELECT pt.vec_id, cd.label AS other, sum(pt.x * cd.s / cd.n) AS d FROM pt JOIN cd ON pt.dim = cd.dim GROUP BY ALL),
dist AS (SELECT norm.vec_id, norm.label, c.label AS other, c.n, sq + msq - 2 * d AS far
         FROM dot JOIN norm ON dot.vec_id = norm.vec_id JOIN c ON c.label = dot.other),
ab AS (SELECT vec_id, max(n) FILTER (label = other) AS n,
              max(far) FILTER (label = other) * max(n) FILTER (label = other)
                / nullif(max(n) FILTER (label = other) - 1, 0) AS a,
              min(far) FILTER (label <> other) AS b FROM dist GROUP BY vec_id)
SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette
FROM ab"""
)
def silhouette_given_labels(spark, sf):
    rows = array_to_features(table(spark, sf, "embeddings"), "embedding")
    value = models.silhouette(rows, "features", "label")
    return spark.range(1).select(F.round(F.lit(value), 6).alias("silhouette"))


@query(
    """
SELECT label, count(*) AS n, round(avg(embedding[1]), 6) AS avg_x0, round(avg(embedding[2]), 6) AS avg_x1,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM embeddings), 6) AS share FROM embeddings GROUP BY label"""
)
def cluster_profile(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "label", F.get("embedding", F.lit(0)).alias("x0"), F.get("embedding", F.lit(1)).alias("x1")
    )
    got = evaluate.cluster_profile(rows, "label", ["x0", "x1"])
    return got.withColumns({c: F.round(c, 6) for c in ("avg_x0", "avg_x1", "share")})


@query(
    "SELECT label, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM embeddings), 6) AS share, "
    + ", ".join(f"round(avg(embedding[{i + 1}]), 6) AS avg_x{i}" for i in range(64))
    + " FROM embeddings GROUP BY label"
)
def cluster_profile_all(spark, sf):
    """Size, share and the mean of all 64 parts per cluster."""
    parts = [f"x{i}" for i in range(64)]
    rows = table(spark, sf, "embeddings").select("label", *[F.get("embedding", F.lit(i)).alias(p) for i, p in enumerate(parts)])
    got = evaluate.cluster_profile(rows, "label", parts)
    return got.withColumns({c: F.round(c, 6) for c in ("share", *[f"avg_{p}" for p in parts])})


@query(
    "WITH"
    + DOCS_SQL
    + ","
    + _BINARY_SQL.format(by="lang,", group="GROUP BY lang")
    + ","
    + curve_sql("docs", "score", "lang")
    + """,
long AS (SELECT lang, metric, value FROM (SELECT bm.*, auc, pr_auc FROM bm JOIN area ON bm.lang = area.lang)
  UNPIVOT INCLUDE NULLS (value FOR metric IN (accuracy, precision, recall, f1, auc, pr_auc)))
SELECT CASE WHEN lang = 'en' THEN metric ELSE lang || '_' || metric END AS metric, value FROM long"""
)
def prefixed_metrics_csv(spark, sf):
    """Metric sets of several splits, prefixed but for one, as a CSV result table that is read back."""
    long = evaluate.metric_set(scored_documents(spark, sf), by="lang")
    path = scratch_path(spark, "results")
    write_table(evaluate.prefixed(long, "lang", unprefixed=("en",)), path, format="csv", files=1)
    back = read_table(spark, path, format="csv")
    return back.select("metric", F.round(F.col("value").cast("double"), 8).alias("value"))


_SIDES_SQL = """
WITH base AS (SELECT l_extendedprice AS price, l_quantity AS qty FROM lineitem WHERE l_linestatus = 'F'),
cur AS (SELECT l_extendedprice AS price, l_quantity AS qty FROM lineitem WHERE l_linestatus = 'O')"""


def _sides(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_linestatus", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty")
    )
    return lines.filter("l_linestatus = 'F'"), lines.filter("l_linestatus = 'O'")


def _psi_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", round(sum((p - q) * ln(p / q)), 6) AS psi FROM (
  SELECT bin, greatest(CAST(count(*) FILTER (side = 'b') AS DOUBLE) / (SELECT count(*) FROM base), 1e-6) AS p,
         greatest(CAST(count(*) FILTER (side = 'c') AS DOUBLE) / (SELECT count(*) FROM cur), 1e-6) AS q
  FROM (SELECT side, len(list_filter(e, lambda x: v > x)) AS bin
        FROM (SELECT 'b' AS side, {c} AS v FROM base UNION ALL SELECT 'c', {c} FROM cur),
             (SELECT quantile_cont({c}, [.1, .2, .3, .4, .5, .6, .7, .8, .9]) AS e FROM base))
  GROUP BY bin)"""


@query(_SIDES_SQL + _psi_sql("price") + "\nUNION ALL" + _psi_sql("qty"))
def psi_drift(spark, sf):
    base, current = _sides(spark, sf)
    return drift.psi(base, current, ["price", "qty"]).withColumn("psi", F.round("psi", 6))


def _ks_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", round(max(abs(cb / (SELECT count(*) FROM base) - cc / (SELECT count(*) FROM cur))), 8) AS ks
FROM (SELECT CAST(sum(b) OVER (ORDER BY v) AS DOUBLE) AS cb, CAST(sum(c) OVER (ORDER BY v) AS DOUBLE) AS cc
      FROM (SELECT v, sum(b) AS b, sum(c) AS c
            FROM (SELECT {c} AS v, 1 AS b, 0 AS c FROM base UNION ALL SELECT {c}, 0, 1 FROM cur) GROUP BY v))"""


@query(_SIDES_SQL + _ks_sql("price") + "\nUNION ALL" + _ks_sql("qty"))
def ks_drift(spark, sf):
    base, current = _sides(spark, sf)
    return drift.ks(base, current, ["price", "qty"]).withColumn("ks", F.round("ks", 8))
