"""Queries that search: documents for benchmark texts, hard negatives for anchors, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm import negatives, search
from tenderspark.llm.common import table


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP12_SQL = f"""
WITH tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL
), lens AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lens
), ms AS (
  SELECT doc_id, 10 + (90 * n * docs) // words AS m FROM lens, total
), ws AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), asked AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN ws USING (term) JOIN tf USING (term) JOIN ms USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {search.TOP}
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return negatives.hard_negatives(negatives.prepared(rows), F.col("vec_id") % 50 == 0)


OP13_SQL = f"""
WITH rs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM rs a JOIN rs r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {negatives.POSITIVES}
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= {negatives.NEGATIVES}
"""

QUERIES = {"op12_ranked_search": op12_ranked_search, "op13_hard_negatives": op13_hard_negatives}
SQL = {"op12_ranked_search": OP12_SQL, "op13_hard_negatives": OP13_SQL}
