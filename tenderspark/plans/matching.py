"""Matching queries: benchmark texts against documents by language, vectors by label, labels against a text score."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators import matching as M
from tenderspark.operators import quality as Q
from tenderspark.plans.demo import Plans, r4, sql4, table
from tenderspark.sources.files import written

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql

_TOK = "regexp_extract_all(lower(strip_accents(coalesce(text, ''))), '[0-9a-z]+')"
_SIDES = f"""it AS (SELECT coalesce(lang, 'other') AS block, doc_id AS item, {_TOK} AS tokens FROM documents),
q AS (SELECT block, item_id AS code, {_TOK} AS tokens FROM benchmark, (SELECT DISTINCT block FROM it)),
posts AS (SELECT block, item, term, count(*) AS tf FROM (SELECT block, item, unnest(tokens) AS term FROM it) GROUP BY ALL),
stats AS (SELECT block, n_docs, coalesce(total, 0) / n_docs AS avg_len FROM (SELECT block, count(DISTINCT item) AS n_docs FROM it GROUP BY block) LEFT JOIN (SELECT block, sum(tf) AS total FROM posts GROUP BY block) USING (block)),
raw AS (SELECT block, term, n AS df, ln(n_docs - n + 0.5::DOUBLE) - ln(n + 0.5::DOUBLE) AS idf FROM (SELECT block, term, count(*) AS n FROM posts GROUP BY ALL) JOIN stats USING (block)),
idfs AS (SELECT block, term, df, CASE WHEN idf < 0 THEN 0.25 * avg(idf) OVER (PARTITION BY block) ELSE idf END AS idf FROM raw),
lens AS (SELECT block, item, sum(tf) AS dl FROM posts GROUP BY ALL),
qs AS (SELECT block, code, term, count(*) AS qtf FROM (SELECT block, code, unnest(tokens) AS term FROM q) GROUP BY ALL),
bm AS (SELECT block, code, item, sum(qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avg_len))) AS bm25
  FROM qs JOIN posts USING (block, term) JOIN lens USING (block, item) JOIN stats USING (block) JOIN idfs USING (block, term) GROUP BY ALL)"""
_NORM = """lim AS (SELECT block, CASE WHEN n = c * i THEN lo ELSE least(lo, 0) END AS lo, CASE WHEN n = c * i THEN hi ELSE greatest(hi, 0) END AS hi
  FROM (SELECT block, min(bm25) AS lo, max(bm25) AS hi, count(*) AS n FROM bm GROUP BY block) JOIN (SELECT block, count(DISTINCT code) AS c FROM q GROUP BY block) USING (block) JOIN (SELECT block, count(DISTINCT item) AS i FROM it GROUP BY block) USING (block)),
norm AS (SELECT block, code, item, bm25, CASE WHEN hi > lo THEN (bm25 - lo) / (hi - lo) ELSE 0 END AS norm FROM bm JOIN lim USING (block))"""


def sides(spark, sf_dir):
    """Benchmark texts, asked in every block, and the documents; a document's block is its language."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("other")).alias("block"), F.col("doc_id").alias("item"), T.tokenize_alnum(F.col("text")).alias("tokens"))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("code"), T.tokenize_alnum(F.col("text")).alias("tokens"))
    blocks = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("other")).alias("block")).distinct()
    return asked.crossJoin(F.broadcast(blocks)), docs  # a query set in each of a handful of blocks


@add("corpus_stats", f"WITH {_SIDES} SELECT block, n_docs, {sql4('avg_len')} AS avg_len FROM stats")
def corpus_stats(spark, sf_dir):
    _, docs = sides(spark, sf_dir)
    return M.corpus_stats(M.term_counts(docs, "block", "item", "tokens"), "block", "item", docs).select("block", "n_docs", r4("avg_len").alias("avg_len"))


@add("bm25_scores", f"WITH {_SIDES} SELECT block, code, item, {sql4('bm25')} AS bm25 FROM bm")
def bm25_scores(spark, sf_dir):
    q, docs = sides(spark, sf_dir)
    return M.bm25_scores(q, docs, "block", "code", "item", "tokens").withColumn("bm25", r4("bm25"))


@add("minmax_norm", f"WITH {_SIDES}, {_NORM} SELECT block, code, item, {sql4('norm')} AS norm FROM norm")
def minmax_norm(spark, sf_dir):
    q, docs = sides(spark, sf_dir)
    raw = written(M.bm25_scores(q, docs, "block", "code", "item", "tokens"), "bm25")
    out = M.minmax_in_block(raw, q, docs, "block", "code", "item", "bm25")
    return out.select("block", "code", "item", r4("norm").alias("norm"))


_BOTH = _SIDES + f""", {_NORM},
cs AS (SELECT block, code, item, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cosine FROM q JOIN it USING (block) JOIN embeddings a ON a.vec_id = code JOIN embeddings b ON b.vec_id = item),
zeros AS (SELECT block, CASE WHEN hi > lo THEN (0 - lo) / (hi - lo) ELSE 0 END AS zero FROM lim),
both_ AS (SELECT block, code, item, bm25, cosine, round(greatest(bm25, cosine), 9) AS score
  FROM (SELECT block, code, item, coalesce(norm, zero, 0) AS bm25, coalesce(cosine, 0) AS cosine FROM q JOIN it USING (block) LEFT JOIN norm USING (block, code, item) LEFT JOIN zeros USING (block) LEFT JOIN cs USING (block, code, item)))"""


@add("candidate_pairs", f"WITH {_BOTH} SELECT block, code, item, {sql4('bm25')} AS bm25, {sql4('cosine')} AS cosine, {sql4('score')} AS score FROM both_ WHERE score >= 0.2 QUALIFY row_number() OVER (PARTITION BY block, code ORDER BY score DESC, item) <= 20")
def candidate_pairs(spark, sf_dir):
    """Both signals over all blocks; the vectors are those of the same number, which most documents lack."""
    q, docs = sides(spark, sf_dir)
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    q = q.join(v.withColumnRenamed("vec_id", "code"), "code", "left")
    docs = docs.join(v.withColumnRenamed("vec_id", "item"), "item", "left")
    out = M.candidate_pairs(q, docs, "block", "code", "item", "tokens", 20, 0.2, "embedding")
    return out.select("block", "code", "item", r4("bm25").alias("bm25"), r4("cosine").alias("cosine"), r4("score").alias("score"))


_VEC = """va AS (SELECT label AS block, vec_id AS code, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 10 = 0), vb AS (SELECT label AS block, vec_id AS item, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 10 <> 0),
cs AS (SELECT block, code, item, list_cosine_similarity(va.v, vb.v) AS cosine FROM va JOIN vb USING (block))"""


def vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumnRenamed("label", "block")
    return e.where("vec_id % 10 = 0").select("block", F.col("vec_id").alias("code"), "embedding"), e.where("vec_id % 10 != 0").select("block", F.col("vec_id").alias("item"), "embedding")


@add("cosine_scores", f"WITH {_VEC} SELECT block, code, item, {sql4('cosine')} AS cosine FROM cs")
def cosine_scores(spark, sf_dir):
    return M.cosine_scores(*vectors(spark, sf_dir), "block", "code", "item", "embedding").withColumn("cosine", r4("cosine"))


@add("candidate_product", f"WITH {_VEC} SELECT block, code, item FROM cs")
def candidate_product(spark, sf_dir):
    return M.candidate_product(*vectors(spark, sf_dir), "block", "code", "item")


@add("topk_pairs", f"WITH {_VEC} SELECT block, code, item, {sql4('cosine')} AS score, CAST(row_number() OVER (PARTITION BY block, code ORDER BY round(cosine, 9) DESC, item) AS INT) AS place FROM cs WHERE round(cosine, 9) >= 0.05 QUALIFY place <= 10")
def topk_pairs(spark, sf_dir):
    found = M.best_by_cosine(*vectors(spark, sf_dir), "block", "code", "item", "embedding", 10, 0.05)
    return found.select("block", "code", "item", r4("score").alias("score"), "place")


@add("refilter_topk", f"WITH {_VEC} SELECT block, code, item, s AS score, CASE WHEN s < 0.1 THEN 'floor' WHEN rank() OVER (PARTITION BY block, code ORDER BY s DESC) > 5 THEN 'top_k' END AS cut_by, NOT (s < 0.1 OR rank() OVER (PARTITION BY block, code ORDER BY s DESC) > 5) AS kept FROM (SELECT block, code, item, floor(cosine * 50 + 1e-7) / 50 AS s FROM cs)")
def refilter_topk(spark, sf_dir):
    """A second, narrower cut of a table of scored pairs, here all of a block, their scores in steps of .02."""
    pairs = M.cosine_scores(*vectors(spark, sf_dir), "block", "code", "item", "embedding")
    return M.refilter_top_k(pairs.select("block", "code", "item", (F.floor(F.col("cosine") * 50 + 1e-7) / 50).alias("score")), ["block", "code"], "score", 5, 0.1)


@add("product_size", "SELECT CAST(sum(c * i) AS BIGINT) AS n_pairs, CAST(sum(c * least(i, 15)) AS BIGINT) AS n_top_k FROM (SELECT label, count(*) FILTER (vec_id % 10 = 0) AS c, count(*) FILTER (vec_id % 10 <> 0) AS i FROM embeddings GROUP BY label) WHERE c > 0 AND i > 0")
def product_size(spark, sf_dir):
    return M.product_size(*vectors(spark, sf_dir), "block", "code", "item", 15)


@add("common_categories", "SELECT DISTINCT label AS block FROM embeddings WHERE vec_id % 10 = 0 INTERSECT SELECT DISTINCT label FROM embeddings WHERE vec_id % 10 <> 0")
def common_categories(spark, sf_dir):
    a, b = vectors(spark, sf_dir)
    return a.select("block").intersect(b.select("block"))


# A score of each labelled document: the share of its characters that are letters; quality marks the truth.
_SCORED = "scored AS (SELECT doc_id, quality = 1 AS good, toxic, length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / nullif(length(text), 0) AS score FROM documents JOIN labels USING (doc_id))"
_SCORE = "round(score::DOUBLE, 9)"


def scored(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    share = F.try_divide(F.length(F.regexp_replace("text", "[^a-zA-Z]", "")), F.length("text"))
    return d.select("doc_id", (F.col("quality") == 1).alias("good"), "toxic", share.alias("score"))


_DECIDE = "CASE WHEN score >= 0.8 THEN 'accept' WHEN score <= 0.72 THEN 'reject' WHEN score IS NOT NULL THEN 'ambiguous' END"
_VERDICT = "CASE WHEN doc_id % 7 = 0 THEN 'yes' WHEN doc_id % 7 = 1 THEN 'no' WHEN doc_id % 7 = 2 THEN 'undetermined' END"
_FINAL = "CASE WHEN decision = 'accept' OR verdict = 'yes' THEN 'confirmed' WHEN verdict IN ('no', 'undetermined') OR decision = 'reject' AND verdict IS NULL THEN 'rejected' ELSE 'pending' END"
_DECIDED = f"{_SCORED}, decided AS (SELECT *, {_FINAL} AS final_decision FROM (SELECT *, {_DECIDE} AS decision, {_VERDICT} AS verdict FROM scored))"


def decided(spark, sf_dir):
    m = F.col("doc_id") % 7
    d = scored(spark, sf_dir).withColumn("decision", M.decide(F.col("score"), 0.8, 0.72)).withColumn("verdict", F.when(m == 0, "yes").when(m == 1, "no").when(m == 2, "undetermined"))
    return d.withColumn("final_decision", M.final_decision(F.col("decision"), F.col("verdict")))


@add("rerank_decide", f"WITH {_DECIDED} SELECT doc_id, decision FROM decided")
def rerank_decide(spark, sf_dir):
    return decided(spark, sf_dir).select("doc_id", "decision")


@add("final_decision", f"WITH {_DECIDED} SELECT doc_id, decision, verdict, final_decision FROM decided")
def final_decision(spark, sf_dir):
    return decided(spark, sf_dir).select("doc_id", "decision", "verdict", "final_decision")


@add("confirmed_keys_union", f"WITH {_DECIDED} SELECT doc_id FROM decided WHERE decision = 'accept' UNION SELECT doc_id FROM decided WHERE verdict = 'yes'")
def confirmed_keys_union(spark, sf_dir):
    d = decided(spark, sf_dir)
    return d.where("decision = 'accept'").select("doc_id").union(d.where("verdict = 'yes'").select("doc_id")).distinct()


@add("accumulate_labels", f"WITH {_DECIDED} SELECT doc_id, substr(lang, 1, 500) AS catalog_text, substr(text, 1, 500) AS item_text, final_decision, CASE WHEN verdict IS NULL THEN 'rerank' ELSE 'llm' END AS origin FROM decided JOIN documents USING (doc_id) WHERE final_decision <> 'pending' AND doc_id % 3 <> 0")
def accumulate_labels(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("catalog_text"), F.col("text").alias("item_text"))
    have = table(spark, sf_dir, "labels").where("doc_id % 3 = 0").select("doc_id")
    return M.new_labels(decided(spark, sf_dir).join(texts, "doc_id"), have, "doc_id")


_MATRIX = f"WITH {_SCORED}, m AS (SELECT count(*) FILTER (good AND score >= 0.8) AS tp, count(*) FILTER (NOT good AND score >= 0.8) AS fp, count(*) FILTER (NOT good AND score <= 0.72) AS tn, count(*) FILTER (good AND score <= 0.72) AS fn, count(*) FILTER (score IS NULL OR score > 0.72 AND score < 0.8) AS undecided, count(*) AS n FROM scored WHERE good IS NOT NULL), r AS (SELECT *, {sql4('tp / nullif(tp + fp, 0)')} AS precision, {sql4('tp / nullif(tp + fn, 0)')} AS recall FROM m)"


@add("confusion_matrix", f"{_MATRIX} SELECT * FROM r")
def confusion_matrix(spark, sf_dir):
    return Q.confusion_matrix(scored(spark, sf_dir), "good", "score", 0.8, 0.72).withColumn("precision", r4("precision")).withColumn("recall", r4("recall"))


@add("regression_gate", f"{_MATRIX} SELECT precision, recall, coalesce(precision >= 0.85 AND recall >= 0.85, false) AS passed FROM r")
def regression_gate(spark, sf_dir):
    m = Q.confusion_matrix(scored(spark, sf_dir), "good", "score", 0.8, 0.72).withColumn("precision", r4("precision")).withColumn("recall", r4("recall"))
    return Q.regression_gate(m, 0.85).select("precision", "recall", "passed")


@add("threshold_sweep", f"WITH {_SCORED}, cell AS (SELECT good, least(greatest(floor(score * 100 + 1e-9), -1), 100) AS c FROM scored WHERE score IS NOT NULL), a AS (SELECT t, count(*) FILTER (good AND c >= t) AS tp, count(*) FILTER (c >= t) AS acc, count(*) FILTER (good) AS al FROM generate_series(0, 100) AS g(t), cell GROUP BY t) SELECT {sql4('t / 100')} AS t, {sql4('tp / nullif(acc, 0)')} AS precision, {sql4('tp / nullif(al, 0)')} AS recall, acc AS n_accepted FROM a")
def threshold_sweep(spark, sf_dir):
    return Q.threshold_sweep(scored(spark, sf_dir), "good", "score", 101).select(r4("t").alias("t"), r4("precision").alias("precision"), r4("recall").alias("recall"), "n_accepted")


@add("chosen_thresholds", f"""WITH {_SCORED}, cell AS (SELECT good, score IS NOT NULL AS has, least(greatest(floor(coalesce(score, 0) * 100 + 1e-9), 0), 100) AS c FROM scored WHERE good IS NOT NULL),
a AS (SELECT t, count(*) FILTER (good AND c >= t) / nullif(count(*) FILTER (good), 0) AS recall, count(*) FILTER (good AND has AND c >= t) / nullif(count(*) FILTER (has AND c >= t), 0) AS precision FROM generate_series(0, 100) AS g(t), cell GROUP BY t)
SELECT {sql4("max(t) FILTER (recall >= 0.99) / 100")} AS reject_at, {sql4("arg_max(recall, t) FILTER (recall >= 0.99)")} AS reject_recall,
{sql4("min(t) FILTER (t % 5 = 0 AND precision >= 0.97) / 100")} AS accept_at, {sql4("arg_min(precision, t) FILTER (t % 5 = 0 AND precision >= 0.97)")} AS accept_precision FROM a""")
def chosen_thresholds(spark, sf_dir):
    found = Q.chosen_thresholds(scored(spark, sf_dir), "good", "score")
    return found.select(*[r4(c).alias(c) for c in found.columns])


@add("stratified_sample", f"WITH {_SCORED}, b AS (SELECT doc_id, CAST(CASE WHEN hi > lo THEN least(floor((score - lo) / ((hi - lo) / 5)), 4) ELSE 0 END AS INT) AS bin FROM scored, (SELECT min(score) AS lo, max(score) AS hi FROM scored) WHERE score IS NOT NULL) SELECT doc_id, bin FROM b QUALIFY row_number() OVER (PARTITION BY bin ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) <= 20")
def stratified_sample(spark, sf_dir):
    return Q.stratified_sample(scored(spark, sf_dir), "score", "doc_id", 100).select("doc_id", "bin")
