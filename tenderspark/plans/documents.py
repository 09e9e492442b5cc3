"""Document queries: conversations as ordered pages, documents as long texts, items checked against perturbed copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators import documents as D
from tenderspark.operators.retention import retention
from tenderspark.plans.demo import ITEMS, Plans, items, r4, sql4, table
from tenderspark.sources.files import scratch
from tenderspark.streaming.tables import BucketTable

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql


@add("document_text", "SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, role, text) AS text, count(*) AS n_pages FROM conversations GROUP BY conv_id")
def document_text(spark, sf_dir):
    return D.document_text(table(spark, sf_dir, "conversations"), "conv_id", ["turn", "role"], "text")


@add("pages_per_document", "SELECT conv_id, count(DISTINCT turn) AS n_pages FROM conversations GROUP BY conv_id")
def pages_per_document(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.countDistinct("turn").alias("n_pages"))


@add("chunk_text", "SELECT doc_id, CAST(chunk AS INT) AS chunk, substr(text, CAST(chunk * 1800 + 1 AS BIGINT), 2000) AS chunk_text FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(0, CAST(ceil((length(text) - 2000) / 1800.0) AS BIGINT)))) AS chunk FROM documents WHERE length(text) > 0)")
def chunk_text(spark, sf_dir):
    return D.chunk_text(table(spark, sf_dir, "documents"), "doc_id", "text", 2000, 200)


@add("route_strategy", f"WITH {ITEMS}, n AS (SELECT document, count(*) AS n_items, CAST(sum(quantity) * 40 AS BIGINT) AS text_len FROM items GROUP BY document) SELECT document, n_items, CASE WHEN n_items > text_len / 1000 THEN 'whole' ELSE 'window' END AS strategy FROM n")
def route_strategy(spark, sf_dir):
    n = items(spark, sf_dir).groupBy("document").agg(F.count(F.lit(1)).alias("n_items"), (F.sum("quantity") * 40).cast("long").alias("text_len"))
    return n.select("document", "n_items", D.route_strategy(F.col("n_items"), F.col("text_len"), 9000, 8000).alias("strategy"))


# Extraction simulated by a deterministic perturbation of the items.
_EXTRACTED = f"""{ITEMS}, ex AS (SELECT item_key, document, number, quantity AS rq, unit_price AS rp, (document + number) % 11 <> 0 AS found, CASE WHEN code % 5 = 0 THEN quantity * 2 ELSE quantity END AS q,
  CASE WHEN code % 7 = 0 THEN NULL WHEN code % 7 = 1 THEN unit_price * 1.2 WHEN code % 7 = 2 THEN unit_price * 5 ELSE unit_price END AS p FROM items),
checked AS (SELECT *, CASE WHEN NOT found THEN 'not_found' WHEN NOT (abs(q - rq) <= greatest(1.0, 0.01 * rq) OR coalesce(abs((p - rp) / rp) <= 0.01 AND rp >= 1000, false)) THEN 'quantity_differs' WHEN p IS NULL THEN 'confirmed_no_price' WHEN rp <= 0 THEN 'confirmed_no_reference'
  WHEN abs((p - rp) / rp) <= 0.01 THEN 'confirmed' WHEN p / rp < 0.3 OR p / rp > 3 THEN 'confirmed_price_suspect' ELSE 'confirmed_differs' END AS status FROM ex),
verdicts AS (SELECT document, CASE WHEN count(*) FILTER (status <> 'no_text') = 0 THEN 'illegible' WHEN count(*) FILTER (status LIKE 'confirmed%') = 0 THEN 'suspect' ELSE 'ok' END AS verdict, count(*) AS n_items FROM checked GROUP BY document)"""


def checked(spark, sf_dir):
    i, c = items(spark, sf_dir), F.col("code") % 7
    ex = i.withColumn("found", (F.col("document") + F.col("number")) % 11 != 0).withColumn("q", F.when(F.col("code") % 5 == 0, F.col("quantity") * 2).otherwise(F.col("quantity")))
    ex = ex.withColumn("p", F.when(c == 0, None).when(c == 1, F.col("unit_price") * 1.2).when(c == 2, F.col("unit_price") * 5).otherwise(F.col("unit_price")))
    return ex.select("item_key", "document", "number", "quantity", "unit_price", "supplier", "code", "p", D.validate_extraction(F.col("found"), F.col("q"), F.col("p"), F.col("quantity"), F.col("unit_price")).alias("v")).select("*", F.col("v.status").alias("check"), F.col("v.divergence").alias("divergence")).drop("v")


def with_verdicts(spark, sf_dir):
    c = checked(spark, sf_dir)
    return c, D.doc_verdict(c, "document", "check").join(c.groupBy("document").agg(F.count(F.lit(1)).alias("n_items")), "document")


@add("validate_extraction", f"WITH {_EXTRACTED} SELECT item_key, status, {sql4('CASE WHEN status = ' + chr(39) + 'confirmed' + chr(39) + ' THEN 0.0 WHEN status IN (' + chr(39) + 'confirmed_price_suspect' + chr(39) + ', ' + chr(39) + 'confirmed_differs' + chr(39) + ') THEN (p - rp) / rp END')} AS divergence FROM checked")
def validate_extraction(spark, sf_dir):
    return checked(spark, sf_dir).select("item_key", F.col("check").alias("status"), r4("divergence").alias("divergence"))


@add("doc_verdict", f"WITH {_EXTRACTED} SELECT document, verdict FROM verdicts")
def doc_verdict(spark, sf_dir):
    return with_verdicts(spark, sf_dir)[1].select("document", "verdict")


@add("item_destination", f"WITH {_EXTRACTED} SELECT item_key, CASE WHEN status LIKE 'confirmed%' THEN 'keep' WHEN verdict IN ('suspect', 'illegible') THEN 'review' ELSE 'discard' END AS destination FROM checked JOIN verdicts USING (document)")
def item_destination(spark, sf_dir):
    c, v = with_verdicts(spark, sf_dir)
    return c.join(v, "document").select("item_key", D.destination(F.col("check"), F.col("verdict")).alias("destination"))


@add("destination_counts", f"WITH {_EXTRACTED} SELECT CASE WHEN status LIKE 'confirmed%' THEN 'keep' WHEN verdict IN ('suspect', 'illegible') THEN 'review' ELSE 'discard' END AS destination, count(*) AS n, count(*) FILTER (p IS NULL) AS n_without_price FROM checked JOIN verdicts USING (document) GROUP BY 1")
def destination_counts(spark, sf_dir):
    c, v = with_verdicts(spark, sf_dir)
    return c.join(v, "document").groupBy(D.destination(F.col("check"), F.col("verdict")).alias("destination")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p").isNull()).alias("n_without_price"))


@add("gate_enriched", f"WITH {_EXTRACTED} SELECT item_key FROM checked JOIN verdicts USING (document) WHERE number > 5 OR status LIKE 'confirmed%'")
def gate_enriched(spark, sf_dir):
    c, v = with_verdicts(spark, sf_dir)
    known = c.where("number <= 5").join(v, "document").select("item_key", D.destination(F.col("check"), F.col("verdict")).alias("destination"))
    return c.select("item_key").join(known, "item_key", "left").where(F.coalesce("destination", F.lit("keep")) == "keep").select("item_key")


@add("escalate_strategy", f"WITH {_EXTRACTED} SELECT document, verdict IN ('suspect', 'illegible') AND n_items >= 2 AS escalated, CASE WHEN document % 2 = 0 OR verdict = 'illegible' THEN CASE WHEN document % 2 = 0 THEN 'ok' ELSE 'suspect' END ELSE verdict END AS verdict FROM verdicts")
def escalate_strategy(spark, sf_dir):
    v = with_verdicts(spark, sf_dir)[1]
    second = F.when(F.col("document") % 2 == 0, "ok").otherwise("suspect")
    return v.select("document", D.escalated(F.col("verdict"), F.col("n_items"), 2).alias("escalated"), D.better_verdict(F.col("verdict"), second).alias("verdict"))


@add("enriched_row", f"WITH {_EXTRACTED} SELECT item_key, status LIKE 'confirmed%' AS from_document, CASE WHEN status LIKE 'confirmed%' THEN 'document text ' || item_key ELSE 'source text' END AS final_description, rp AS price_source, CASE WHEN status LIKE 'confirmed%' THEN p END AS price_document FROM checked")
def enriched_row(spark, sf_dir):
    ok = F.col("check").startswith("confirmed")
    return checked(spark, sf_dir).select("item_key", ok.alias("from_document"), F.when(ok, F.concat(F.lit("document text "), F.col("item_key"))).otherwise("source text").alias("final_description"), F.col("unit_price").alias("price_source"), F.when(ok, F.col("p")).alias("price_document"))


@add("dedup_chunk_rows", "SELECT conv_id, arg_min(turn, (turn // 2, turn, text)) AS turn, arg_min(text, (turn // 2, turn, text)) AS text FROM conversations WHERE length(trim(coalesce(text, ''))) > 0 GROUP BY conv_id, role, substr(text, 1, 80)")
def dedup_chunk_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("chunk", F.floor(F.col("turn") / 2)).withColumn("seq", F.struct("turn", "text"))
    return D.dedup_chunk_rows(c, "conv_id", "chunk", "seq", "role", "text").select("conv_id", "turn", "text")


@add("match_items_to_table", """WITH a AS (SELECT DISTINCT conv_id, turn AS item, unnest(regexp_extract_all(lower(strip_accents(text)), '[0-9a-z]+')) AS w FROM conversations WHERE role = 'user'), b AS (SELECT DISTINCT conv_id, turn AS line, unnest(regexp_extract_all(lower(strip_accents(text)), '[0-9a-z]+')) AS w FROM conversations WHERE role <> 'user'),
n AS (SELECT conv_id, item, line, count(*) AS common FROM a JOIN b USING (conv_id, w) GROUP BY ALL) SELECT conv_id, item, line, common FROM n QUALIFY row_number() OVER (PARTITION BY conv_id, item ORDER BY common DESC, line) = 1""")
def match_items_to_table(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    a = c.where("role = 'user'").select("conv_id", F.col("turn").alias("item"), "text")
    b = c.where("role != 'user'").select("conv_id", F.col("turn").alias("line"), "text")
    return D.match_items_to_table(a, b, "conv_id", "item", "text", "line", "text")


@add("match_items_with_scorer", """WITH a AS (SELECT DISTINCT conv_id, turn AS item, unnest(regexp_extract_all(lower(strip_accents(text)), '[0-9a-z]+')) AS w FROM conversations WHERE role = 'user'), b AS (SELECT DISTINCT conv_id, turn AS line, unnest(regexp_extract_all(lower(strip_accents(text)), '[0-9a-z]+')) AS w FROM conversations WHERE role <> 'user'),
na AS (SELECT conv_id, item, count(*) AS x FROM a GROUP BY ALL), nb AS (SELECT conv_id, line, count(*) AS y FROM b GROUP BY ALL),
n AS (SELECT conv_id, item, line, count(*) AS common FROM a JOIN b USING (conv_id, w) GROUP BY ALL),
s AS (SELECT conv_id, item, line, round(common / (x + y - common), 6) AS score FROM n JOIN na USING (conv_id, item) JOIN nb USING (conv_id, line)) SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY conv_id, item ORDER BY score DESC, line) = 1""")
def match_items_with_scorer(spark, sf_dir):
    """Candidate rows are judged by a scorer, here the share of common words; any model takes its place."""
    c = table(spark, sf_dir, "conversations")
    a = c.where("role = 'user'").select("conv_id", F.col("turn").alias("item"), F.col("text").alias("item_text"))
    b = c.where("role != 'user'").select("conv_id", F.col("turn").alias("line"), F.col("text").alias("row_text"))
    return D.match_items_to_table(a, b, "conv_id", "item", "item_text", "line", "row_text", common_share)


def common_share(batch):
    """A scorer of pairs of texts: common words by all words of both."""
    import re
    import unicodedata

    def folded(text):
        plain = "".join(ch for ch in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(ch))
        return set(re.findall("[0-9a-z]+", plain))

    pairs = [(folded(x), folded(y)) for x, y in zip(batch["item_text"], batch["row_text"], strict=True)]
    return [round(len(x & y) / len(x | y), 6) for x, y in pairs]


_OLD = "gone AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 400 > 180 AND conv_id % 3 <> 0), p AS (SELECT conv_id IN (SELECT conv_id FROM gone) AS dead, text FROM conversations), l AS (SELECT ts < TIMESTAMP '2024-04-14' - INTERVAL 90 DAY AS dead FROM events)"


def retained(spark, sf_dir):
    """Pages and logs as tables in buckets, the documents that the pages belong to, and the two days of the check."""
    c = table(spark, sf_dir, "conversations")
    now = F.to_date(F.lit("2024-04-14"))
    docs = c.select("conv_id").distinct().select("conv_id", F.date_sub(now, (F.col("conv_id") % 400).cast("int")).alias("extracted_at"), F.when(F.col("conv_id") % 3 != 0, F.lit("https://example.org")).alias("url"))
    out = scratch(spark, "retention")
    pages = BucketTable(spark, f"{out}/pages", "conv_id long, turn long, text string", ["conv_id"], 32)
    logs = BucketTable(spark, f"{out}/logs", "event_id long, ts timestamp", ["event_id"], 32)
    pages.merge(c.select("conv_id", "turn", "text"), 0, lambda old, new: new)
    logs.merge(table(spark, sf_dir, "events").select("event_id", "ts"), 0, lambda old, new: new)
    return pages, docs, logs, now


@add("retention_plan", f"WITH {_OLD} SELECT 'page' AS target, count(*) AS n_rows, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars, false AS applied FROM p WHERE dead UNION ALL SELECT 'log', count(*), 0, false FROM l WHERE dead")
def retention_plan(spark, sf_dir):
    pages, docs, logs, now = retained(spark, sf_dir)
    return retention(pages, docs, "conv_id", logs, "ts", now)


@add("retention_apply", f"WITH {_OLD} SELECT 'page' AS target, count(*) AS n_left FROM p WHERE NOT dead UNION ALL SELECT 'log', count(*) FROM l WHERE dead IS NOT TRUE")
def retention_apply(spark, sf_dir):
    """What the two tables hold after an applied pass, and still after a second one."""
    pages, docs, logs, now = retained(spark, sf_dir)
    for _ in range(2):
        retention(pages, docs, "conv_id", logs, "ts", now, apply=True)
    left = lambda t, name: t.read().agg(F.count(F.lit(1)).alias("n_left")).select(F.lit(name).alias("target"), "n_left")
    return left(pages, "page").unionByName(left(logs, "log"))


#: Where a document's phrase (else its number) and up to two hits of each price spelling stand, as intervals; joined where they
#: overlap or touch; cut at the cap from the front.
_WINDOWS = r"""WITH p AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 1000 + doc_id::DOUBLE END AS price, regexp_extract(text, '(\S+ \S+ \S+)\s*$', 1) AS phrase, text FROM documents),
v AS (SELECT *, replace(format('{:.2f}', price), '.', ',') AS plain, replace(replace(replace(format('{:,.2f}', price), ',', ';'), '.', ','), ';', '.') AS money FROM p),
t AS (SELECT doc_id, plain, money, CASE WHEN doc_id % 3 <> 0 THEN phrase END AS phrase, concat_ws(' ', text, 'valor', coalesce(money, ''), 'reais') AS text FROM v),
f AS (SELECT *, lower(strip_accents(text)) AS folded, length(text) AS size, substr(lower(strip_accents(trim(phrase))), 1, 40) AS needle FROM t),
a AS (SELECT doc_id, size, CASE WHEN length(needle) > 0 AND strpos(folded, needle) > 0 THEN strpos(folded, needle) ELSE strpos(folded, 'item ' || doc_id) END AS pos, 300 AS r FROM f),
one AS (SELECT doc_id, size, text, w, strpos(text, w) AS pos FROM (SELECT doc_id, size, text, unnest([plain, money]) AS w FROM f WHERE plain IS NOT NULL)),
h AS (SELECT * FROM a UNION ALL SELECT doc_id, size, pos, 150 FROM one
  UNION ALL SELECT doc_id, size, CASE WHEN pos > 0 AND strpos(substr(text, pos + length(w)), w) > 0 THEN pos + length(w) - 1 + strpos(substr(text, pos + length(w)), w) ELSE 0 END, 150 FROM one),
s AS (SELECT doc_id, greatest(pos - 1 - r, 0) AS a, least(pos - 1 + r, size) AS b FROM h WHERE pos > 0),
g AS (SELECT *, a > coalesce(max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS opens FROM s),
i AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM g) GROUP BY doc_id, k),
c AS (SELECT *, coalesce(sum(b - a) OVER (PARTITION BY doc_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM i),
w AS (SELECT doc_id, string_agg(substr(text, CAST(a + 1 AS BIGINT), CAST(least(b - a, 900 - used) AS BIGINT)), chr(10) || '[...]' || chr(10) ORDER BY a) AS found FROM c JOIN f USING (doc_id) WHERE used < 900 GROUP BY doc_id)
SELECT doc_id, coalesce(found, substr(text, 1, 1200)) AS window FROM f LEFT JOIN w USING (doc_id)"""


@add("anchor_windows", _WINDOWS)
def anchor_windows(spark, sf_dir):
    """Windows of every document around a phrase of its own (for each third only a number, which no text has) and a price
    that stands behind its text."""
    d = table(spark, sf_dir, "documents")
    phrase = F.regexp_extract("text", r"^(?:[\s\S]*\s)?(\S+ \S+ \S+)\s*$", 1)  # looked for from the end, not from every character
    price = F.when(F.col("doc_id") % 2 == 0, 1000 + F.col("doc_id").cast("double"))
    text = F.concat_ws(" ", "text", F.lit("valor"), T.format_money_br(price), F.lit("reais"))
    return d.select("doc_id", D.anchor_windows(text, F.when(F.col("doc_id") % 3 != 0, phrase), F.col("doc_id"), price, 900, 300, 150).alias("window"))
