"""Queries over document texts: tokens and secrets, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm import bpe, lines, secrets, substrings
from tenderspark.llm.common import table


def vocabulary() -> str:
    """Where the public word BPE lies; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


OP3_SQL = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), grams AS (
  SELECT doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS p FROM dw WHERE len(w) >= 50)
), low AS (
  SELECT h, min(doc_id) AS first FROM grams GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(p, p + 49)) AS x FROM grams JOIN low USING (h) WHERE first < doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY x) AS words FROM (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS x FROM dw) ANTI JOIN gone USING (doc_id, x) GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM dw LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(), digests=True)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


def _kind_sql(i: int, kind: str) -> str:
    regex, group, least = secrets.BASE.get(kind, (secrets.WEAK.get(kind), 0, 1))
    regex = regex.replace("'", "''")
    ok = f"length(vs[i]) >= {least}"
    if kind == "random":
        ok = "regexp_matches(vs[i], '[a-z]') AND regexp_matches(vs[i], '[A-Z]') AND regexp_matches(vs[i], '[0-9]')"
    return f"""SELECT doc_id, {i} AS kind, CAST(list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda m: length(m))), 0) AS BIGINT) AS start,
      CAST(list_sum(list_transform(gs[1:i], lambda g: length(g))) + list_sum(list_transform(ms[1:i], lambda m: length(m))) AS BIGINT) AS stop, {ok} AS ok
    FROM (SELECT doc_id, gs, ms, vs, unnest(generate_series(1, len(ms))) AS i FROM (
      SELECT doc_id, string_split_regex(text, '{regex}') AS gs, regexp_extract_all(text, '{regex}') AS ms, regexp_extract_all(text, '{regex}', {group}) AS vs FROM documents WHERE regexp_matches(text, '{regex}')))"""


_UNION = "\n    UNION ALL\n    ".join(_kind_sql(i, k) for i, k in enumerate(secrets.KINDS))
OP8_SQL = f"""
WITH found AS (
    SELECT doc_id, kind, start, stop FROM ({_UNION}) WHERE ok
), met AS (
  SELECT w.doc_id, w.kind, w.start, w.stop,
         bool_or(o.kind = 1) AS id_strong, bool_or(o.kind IN (3, 4)) AS id_weak, bool_or(o.kind IN (0, 2)) AS secret_strong, bool_or(o.kind = 6) AS secret_weak, bool_or(o.kind = 5) AS endpoint
  FROM found w JOIN found o ON w.doc_id = o.doc_id AND w.kind >= 3 AND (w.start - o.stop BETWEEN 0 AND {secrets.SCOPE} OR o.start - w.stop BETWEEN 0 AND {secrets.SCOPE})
  GROUP BY ALL
), reported AS (
  SELECT doc_id, kind, start, stop FROM found WHERE kind < 3
  UNION ALL
  SELECT doc_id, kind, start, stop FROM met
  WHERE kind IN (3, 4) AND (secret_strong OR secret_weak AND endpoint)
     OR kind = 6 AND (id_strong OR id_weak AND endpoint)
     OR kind = 5 AND (id_strong AND (secret_strong OR secret_weak) OR id_weak AND secret_strong)
), texts AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(s, ',' ORDER BY start, kind) AS spans
  FROM (SELECT *, ({str(secrets.KINDS)})[kind + 1] || ':' || start || ':' || stop AS s FROM reported) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN texts USING (doc_id)
"""


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP11_SQL = rf"""
WITH ln AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS p FROM documents
), keyed AS (
  SELECT doc_id, p, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM ln
), heavy AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {lines.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {lines.LEAST_DOCS}
), marked AS (
  SELECT doc_id, p, line, last IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN heavy USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op3_substring_dedup": op3_substring_dedup, "op4_bpe": op4_bpe, "op8_secret_scan": op8_secret_scan, "op11_line_dedup": op11_line_dedup}
SQL = {"op3_substring_dedup": OP3_SQL, "op8_secret_scan": OP8_SQL, "op11_line_dedup": OP11_SQL}
