"""One query per operator over its whole table, with an SQL oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import centroids, decontaminate, html_text, jaccard, lm_score, mixing, packing, periodic, quality, sharding, token_files, toxicity, warc
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op2_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op3_html_text(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"))


@_query
def op4_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))[0].select("doc_id", "size", "source_size", "target", "taken")


@_query
def op5_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op6_jaccard_join(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


@_query
def op7_warc(spark, sf_dir):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.round_trip(table(spark, sf_dir, "pages")).select(*names)


@_query
def op8_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@_query
def op9_sharding(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"))


@_query
def op10_lm_score(spark, sf_dir):
    return lm_score.score(table(spark, sf_dir, "documents"), stable=True)


@_query
def op11_periodic_runs(spark, sf_dir):
    return periodic.digest(periodic.collapse(table(spark, sf_dir, "documents"), rewrite=periodic.planted))


@_query
def op12_centroid_clusters(spark, sf_dir):
    return centroids.assigned(table(spark, sf_dir, "embeddings"))


@_query
def op13_sequence_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM docs),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y
  WHERE 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
ends AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, e.y FROM reach r JOIN ends e ON r.b = e.x)
SELECT doc_id, len(s) AS n_shingles, c AS component_id
FROM sets JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = doc_id
"""

ORACLES["op7_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to FROM g
"""


def _cluster_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Whole distances in every round: a nearest-centroid table and a floor of means per round."""
    parts = [
        """kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v AS w FROM kept ORDER BY sha256('2:' || vec_id) LIMIT {clusters})""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, c, s FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s, c) AS place FROM (
    SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - w[i]) * (v[i] - w[i]))) AS s FROM kept CROSS JOIN c{r})) WHERE place = 1)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(w2, w) AS w FROM c{r} o LEFT JOIN (
    SELECT c, list(((t - ((t % n) + n) % n) // n)::BIGINT ORDER BY d) AS w2 FROM (
      SELECT c, d, sum(x)::BIGINT AS t, count(*) AS n FROM (SELECT c, unnest(range(64)) AS d, unnest(v) AS x FROM a{r}) GROUP BY c, d) GROUP BY c) m ON m.c = o.c)"""
            )
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(s AS BIGINT) AS distance, CAST(sum(s) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(s) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON a.c = f.c"""
    )


ORACLES["op12_centroid_clusters"] = _cluster_sql()
