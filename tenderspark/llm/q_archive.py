"""Queries over pages and licence notices, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm import licenses, warc
from tenderspark.llm.common import table


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_matches(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))
    return found.withColumn("line_licenses", F.array_join("line_licenses", ","))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_quoted = lambda s: "'" + s.replace("'", "''") + "'"


def _canonical_sql(x: str) -> str:
    out = f"regexp_replace(regexp_replace(lower({x}), {_quoted('(?m)' + licenses.COPYRIGHT_LINES)}, '', 'g'), '[^\\p{{L}}\\p{{N}}\\n]+', '  ', 'g')"
    out = f"' ' || replace({out}, chr(10), ' ' || chr(10) || ' ') || ' '"
    for word, same in licenses.SPELLINGS.items():
        out = f"replace({out}, ' {word} ', ' {same} ')"
    return f"trim(regexp_replace(regexp_replace({out}, ' +', ' ', 'g'), ' ?\\n ?', chr(10), 'g'))"


_entire = lambda c: f"trim(regexp_replace({c}, '\\n+', ' ', 'g'))"
_whole = [(k, t) for k, body in licenses.TEXTS.items() for t in (body, *(f"{title}\n\n{body}" for title in licenses.TITLES.get(k, [])))]
_KNOWN = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in [*_whole, *((k, t) for k, ts in licenses.NOTICES.items() for t in ts)])
_LONG = ", ".join(f"({_quoted(k)}, {_quoted(d)})" for k, d in licenses.LONG_TEXTS.items())
OP5_SQL = f"""
WITH given AS (
  SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS c FROM documents
), forms AS (
  SELECT license_id, {_canonical_sql('text')} AS c FROM (VALUES {_KNOWN}) AS t(license_id, text)
), parts AS (
  SELECT license_id, {_entire('p')} AS p FROM (SELECT license_id, unnest(string_split_regex(c, '\\n\\n+')) AS p FROM forms)
), known AS (
  SELECT digest, min(license_id) AS license_id FROM (
    SELECT license_id, sha256({_entire('c')}) AS digest FROM forms
    UNION ALL SELECT license_id, digest FROM (VALUES {_LONG}) AS t(license_id, digest)
    UNION ALL SELECT min(license_id), sha256(p) FROM parts WHERE len(string_split(p, ' ')) >= {licenses.PART_WORDS} GROUP BY p HAVING count(DISTINCT license_id) = 1
  ) GROUP BY digest
), pieces AS (
  SELECT doc_id, 2 AS kind, x AS form FROM (SELECT doc_id, unnest(string_split_regex(c, '\\n+')) AS x FROM given) WHERE x <> ''
  UNION ALL
  SELECT doc_id, 1, {_entire('x')} FROM (SELECT doc_id, unnest(string_split_regex(c, '\\n\\n+')) AS x FROM given) WHERE contains(trim(x, chr(10)), chr(10))
), met AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses, count(*) FILTER (kind = 2) AS n_lines, count(*) FILTER (kind = 1) AS n_blocks
  FROM pieces JOIN known ON sha256(form) = digest GROUP BY doc_id
)
SELECT doc_id, document_digest, known.license_id AS whole_license, coalesce(line_licenses, '') AS line_licenses, coalesce(n_lines, 0) AS n_lines_matched, coalesce(n_blocks, 0) AS n_blocks_matched
FROM (SELECT doc_id, sha256({_entire('c')}) AS document_digest FROM given) LEFT JOIN known ON document_digest = known.digest LEFT JOIN met USING (doc_id)
"""

_DIGITS = ", ".join(f"(CAST('0x' || substr(sha1(payload), {5 * j + 1}, 5) AS INT) >> {s}) & 31" for j in range(8) for s in (15, 10, 5, 0))
OP6_SQL = f"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, list_aggregate(list_transform([{_DIGITS}], lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(d AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS last
  FROM rows
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to
FROM digests
"""

QUERIES = {"op5_license_scan": op5_license_scan, "op6_warc": op6_warc}
SQL = {"op5_license_scan": OP5_SQL, "op6_warc": OP6_SQL}
