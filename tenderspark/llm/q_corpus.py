"""Queries over whole corpus tables: contamination, fingerprints, quality, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm import decontaminate, quality, simhash
from tenderspark.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")



OP1_SQL = r"""
WITH bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bg AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS p FROM bw WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), dg AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM dw, (SELECT DISTINCT n FROM bg) WHERE len(w) >= n)
), hits AS (
  SELECT dg.doc_id, dg.p, dg.n, bg.item_id FROM dg JOIN bg ON dg.n = bg.n AND dg.gram = bg.gram
), hit_words AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS x FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

#: The statistics, cutoffs and verdicts; ``documents`` and ``labels`` as given.
OP10_CTES = rf"""
dw AS (
  SELECT doc_id, coalesce(lang, 'other') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS gram FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS p FROM dw WHERE len(w) >= 3)
), repeats AS (
  SELECT doc_id, count(DISTINCT x) AS n FROM (
    SELECT doc_id, unnest([p, p + 1, p + 2]) AS x FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams) WHERE c > 1
  ) GROUP BY doc_id
), stats AS (
  SELECT dw.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: strlen(x) > 2 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS BIGINT) AS n_shout_words
  FROM dw LEFT JOIN repeats USING (doc_id)
), shares AS (
  SELECT doc_id, stratum, unnest(['symbol_share', 'dup_line_share', 'repeat_word_share', 'shout_share']) AS rule,
         unnest([coalesce(n_symbols / nullif(word_chars, 0), 0), coalesce(n_dup_lines / nullif(n_lines, 0), 0), coalesce(n_repeat_words / nullif(n_words, 0), 0), coalesce(n_shout_words / nullif(n_words, 0), 0)]) AS share
  FROM stats
), given AS (
  SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), counted AS (
  SELECT stratum, rule, i / 20.0::DOUBLE AS cutoff, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS bad,
         count(*) FILTER (good AND share > i / 20.0::DOUBLE) AS k, count(*) FILTER (NOT good AND share > i / 20.0::DOUBLE) AS caught
  FROM shares JOIN given USING (doc_id), generate_series(1, 19) AS g(i) GROUP BY ALL
), tailed AS (
  SELECT *, CASE WHEN n = 0 OR k >= n THEN 1 ELSE
    list_sum(list_transform(generate_series(0, k), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - CASE WHEN n = j THEN 0 ELSE lgamma(n - j + 1) END + j * ln({quality.RISK / len(quality.RULES)}) + (n - j) * ln({1 - quality.RISK / len(quality.RULES)})))) END AS tail
  FROM counted
), admitted AS (
  SELECT *, max(tail) OVER (PARTITION BY stratum, rule ORDER BY cutoff DESC) <= {quality.DELTA} / ((SELECT count(DISTINCT stratum) FROM counted) * {len(quality.RULES)}) AS ok, caught / greatest(bad, 1) - {quality.COST} * (k / n) AS gain FROM tailed
), cutoffs AS (
  SELECT stratum, rule, cutoff FROM admitted WHERE ok QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, cutoff DESC) = 1
), failed AS (
  SELECT DISTINCT doc_id FROM shares JOIN cutoffs USING (stratum, rule) WHERE share > cutoff
), verdicts AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND failed.doc_id IS NULL AS kept
  FROM stats LEFT JOIN failed USING (doc_id)
)
"""
OP10_SQL = f"WITH {OP10_CTES} SELECT * FROM verdicts"

QUERIES = {"op1_decontaminate": op1_decontaminate, "op9_simhash": op9_simhash, "op10_quality_rules": op10_quality_rules}
SQL = {"op1_decontaminate": OP1_SQL, "op10_quality_rules": OP10_SQL}
