"""Classification queries: item texts are part name and brand, labels come from keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators import classify as C
from tenderspark.plans.demo import DESCRIBED, Plans, described, r4, sql4, table

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql

RULES = {"fastener": ["bolt", "screw", "nut"], "ring": ["ring", "gear"], "red": ["red"]}
_HASH = "sha1(lower(description) || '|' || lower(unit))"
_HASHED = f"{DESCRIBED}, hashed AS (SELECT *, {_HASH} AS text_hash FROM described)"
_HAVE = "have AS (SELECT DISTINCT text_hash FROM hashed WHERE unit IN ('Brand#1', 'Brand#2', 'Brand#3'))"
_LABELS = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(description, '{w}')" for w in ws) + f" THEN '{k}' END" for k, ws in RULES.items()) + "], lambda x: x IS NOT NULL)"
_CATS = f"{_HASHED}, cats AS (SELECT DISTINCT item_key, document, unnest({_LABELS}) AS category FROM hashed)"


def hashed(spark, sf_dir):
    return described(spark, sf_dir).withColumn("text_hash", T.text_hash(F.col("description"), F.col("unit")))


def have(spark, sf_dir):
    return hashed(spark, sf_dir).where("unit in ('Brand#1', 'Brand#2', 'Brand#3')").select("text_hash", C.keyword_labels(F.col("description"), RULES).alias("labels")).distinct()


def cats(spark, sf_dir):
    h = hashed(spark, sf_dir)
    return h, C.item_categories(h, C.classify_distinct(h, have(spark, sf_dir), "text_hash", "item_key", "description", lambda c: C.keyword_labels(c, RULES)), "text_hash", "item_key")


@add("distinct_texts", f"WITH {_HASHED} SELECT text_hash, arg_min(description, item_key) AS description, arg_min(unit, item_key) AS unit, count(*) AS n_items FROM hashed GROUP BY text_hash")
def distinct_texts(spark, sf_dir):
    return C.distinct_texts(hashed(spark, sf_dir), "text_hash", "item_key", ["description", "unit"])


@add("pending_texts", f"WITH {_HASHED}, {_HAVE} SELECT text_hash, arg_min(description, item_key) AS description, count(*) AS n_items FROM hashed ANTI JOIN have USING (text_hash) GROUP BY text_hash")
def pending_texts(spark, sf_dir):
    return C.pending_texts(hashed(spark, sf_dir), have(spark, sf_dir), "text_hash", "item_key", ["description"])


@add("dedup_factor", f"WITH {_HASHED} SELECT count(*) AS n_items, count(DISTINCT text_hash) AS n_texts, {sql4('count(*) / count(DISTINCT text_hash)')} AS factor FROM hashed")
def dedup_factor(spark, sf_dir):
    return C.dedup_factor(hashed(spark, sf_dir), "text_hash").withColumn("factor", r4("factor"))


@add("classify_distinct", f"WITH {_HASHED} SELECT text_hash, array_to_string(any_value({_LABELS}), ',') AS labels FROM hashed GROUP BY text_hash")
def classify_distinct(spark, sf_dir):
    out = C.classify_distinct(hashed(spark, sf_dir), have(spark, sf_dir), "text_hash", "item_key", "description", lambda c: C.keyword_labels(c, RULES))
    return out.withColumn("labels", F.array_join("labels", ","))


def _words(pdf):
    """A scorer as a user would plug in: fails on texts it does not know how to read."""
    out = []
    for t in pdf["description"]:
        if "steel" in t:
            raise ValueError("unreadable")
        out.append(str(len(t.split())))
    return out


@add("batch_score", "SELECT p_partkey AS code, CASE WHEN NOT contains(p_name, 'steel') THEN CAST(len(string_split(p_name, ' ')) AS VARCHAR) END AS result, CASE WHEN contains(p_name, 'steel') THEN 'ValueError: unreadable' END AS error FROM part")
def batch_score(spark, sf_dir):
    return C.batch_score(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("description")), "code", ["description"], _words)


@add("item_category", f"WITH {_CATS} SELECT item_key, category FROM cats")
def item_category(spark, sf_dir):
    return cats(spark, sf_dir)[1]


@add("survivors", f"WITH {_CATS} SELECT item_key, item_key IN (SELECT item_key FROM cats) AS survives FROM hashed")
def survivors(spark, sf_dir):
    h, c = cats(spark, sf_dir)
    return C.survivors(h, c, "item_key").select("item_key", "survives")


@add("survivor_count", f"WITH {_CATS} SELECT document, count(*) AS n_items, count(*) FILTER (item_key IN (SELECT item_key FROM cats)) AS n_survivors FROM hashed GROUP BY document")
def survivor_count(spark, sf_dir):
    h, c = cats(spark, sf_dir)
    return C.survivor_count(C.survivors(h, c, "item_key"), "document")


@add("category_report", f"WITH {_CATS} SELECT category, count(DISTINCT item_key) AS n_items FROM cats GROUP BY category")
def category_report(spark, sf_dir):
    return C.category_report(cats(spark, sf_dir)[1], "item_key")


@add("classify_join", f"WITH {_CATS} SELECT item_key, document, quantity, c AS categories FROM hashed LEFT JOIN (SELECT item_key, string_agg(category, '|' ORDER BY category) AS c FROM cats GROUP BY item_key) USING (item_key)")
def classify_join(spark, sf_dir):
    h, c = cats(spark, sf_dir)
    sets = c.groupBy("item_key").agg(F.array_join(F.array_sort(F.collect_set("category")), "|").alias("categories"))
    return h.select("item_key", "document", "quantity").join(sets, "item_key", "left")


@add("load_pair_inputs", f"WITH {_CATS} SELECT cats.item_key, cats.category, coalesce(CASE WHEN flag = 'R' THEN upper(description) END, description) AS text FROM cats JOIN hashed USING (item_key)")
def load_pair_inputs(spark, sf_dir):
    h, c = cats(spark, sf_dir)
    enriched = h.where("flag = 'R'").select("item_key", F.upper("description").alias("final"))
    return c.join(h.select("item_key", "description"), "item_key").join(enriched, "item_key", "left").select("item_key", "category", F.coalesce(F.nullif("final", F.lit("")), "description").alias("text"))


@add("majority", f"WITH {DESCRIBED} SELECT supplier, category, n FROM (SELECT supplier, category, count(*) AS n FROM described GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY supplier ORDER BY n DESC, category) = 1")
def majority(spark, sf_dir):
    return C.majority(described(spark, sf_dir), ["supplier"], "category")


@add("mode_per_group", f"WITH {DESCRIBED}, sets AS (SELECT document, code, list_sort(list(DISTINCT flag)) AS flags FROM described GROUP BY ALL) SELECT code, array_to_string(flags, ',') AS flags, n FROM (SELECT code, flags, count(*) AS n FROM sets GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY code ORDER BY n DESC, array_to_string(flags, ',')) = 1")
def mode_per_group(spark, sf_dir):
    sets = described(spark, sf_dir).groupBy("document", "code").agg(F.array_join(F.array_sort(F.collect_set("flag")), ",").alias("flags"))
    return C.majority(sets, ["code"], "flags")


@add("class_divergence", f"WITH {DESCRIBED}, sets AS (SELECT document, code, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags FROM described GROUP BY ALL) SELECT code, count(DISTINCT flags) AS n_sets FROM sets GROUP BY code HAVING count(DISTINCT flags) > 1")
def class_divergence(spark, sf_dir):
    sets = described(spark, sf_dir).groupBy("document", "code").agg(F.array_join(F.array_sort(F.collect_set("flag")), ",").alias("flags"))
    return C.class_divergence(sets, "code", "flags")


_RULE = "CASE WHEN p_type IN ('PROMO', 'LARGE') THEN lower(p_type) END"
_OWN = "CASE WHEN p_partkey % 5 = 0 THEN 'cat' || CAST(p_partkey % 3 AS VARCHAR) END"
_CASCADE = f"""base AS (SELECT p_partkey AS code, CASE WHEN p_size <= 25 THEN 'p' || p_size ELSE 'q' || p_partkey END AS pdm, array_to_string(list_sort(list_distinct(string_split(p_name, ' '))), '|') || CASE WHEN p_size > 40 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS terms, {_RULE} AS rule, {_OWN} AS own FROM part),
by_pdm AS (SELECT pdm, own AS v FROM (SELECT pdm, own, count(*) AS n FROM base WHERE own IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY pdm ORDER BY n DESC, own) = 1),
by_terms AS (SELECT terms, own AS v FROM (SELECT terms, own, count(*) AS n FROM base WHERE own IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY terms ORDER BY n DESC, own) = 1),
cascade AS (SELECT code, terms, coalesce(own, by_pdm.v, by_terms.v, rule, 'other') AS category, CASE WHEN own IS NOT NULL THEN 'model' WHEN by_pdm.v IS NOT NULL THEN 'pdm' WHEN by_terms.v IS NOT NULL THEN 'terms' WHEN rule IS NOT NULL THEN 'rule' ELSE 'other' END AS source FROM base LEFT JOIN by_pdm USING (pdm) LEFT JOIN by_terms USING (terms))"""


def cascade(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    terms = F.array_join(F.array_sort(F.array_distinct(F.split("p_name", " "))), "|")
    codes = p.select(F.col("p_partkey").alias("code"), F.when(F.col("p_size") <= 25, F.concat(F.lit("p"), F.col("p_size"))).otherwise(F.concat(F.lit("q"), F.col("p_partkey"))).alias("pdm"), F.concat(terms, F.when(F.col("p_size") > 40, F.col("p_partkey").cast("string")).otherwise("")).alias("terms"), "p_type")
    model = p.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("code"), F.concat(F.lit("cat"), F.col("p_partkey") % 3).alias("category"))
    return p, C.category_cascade(codes, model, "code", "pdm", "terms", F.when(F.col("p_type").isin("PROMO", "LARGE"), F.lower("p_type")))


@add("category_cascade", f"WITH {_CASCADE} SELECT code, category, source FROM cascade")
def category_cascade(spark, sf_dir):
    return cascade(spark, sf_dir)[1]


@add("aggregate_terms", f"WITH {_CASCADE}, rows AS (SELECT code, category, unnest(list_distinct(string_split(p_name, ' '))) AS term FROM cascade JOIN part ON p_partkey = code WHERE category <> 'other') SELECT term, c AS codes, category FROM (SELECT term, string_agg(DISTINCT CAST(code AS VARCHAR), ',' ORDER BY CAST(code AS VARCHAR)) AS c FROM rows GROUP BY term) JOIN (SELECT term, category FROM (SELECT term, category, count(*) AS n FROM rows GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY term ORDER BY n DESC, category) = 1) USING (term)")
def aggregate_terms(spark, sf_dir):
    p, c = cascade(spark, sf_dir)
    codes = c.join(p.select(F.col("p_partkey").alias("code"), F.array_distinct(F.split("p_name", " ")).alias("terms")), "code").withColumn("code", F.col("code").cast("string"))
    return C.aggregate_terms(codes, "code", "terms", "category").withColumn("codes", F.array_join("codes", ","))


# ---- models as plug-ins: what is known is kept, what fails is left for the next run ----


def _label_model(batch):
    out = []
    for t in batch["p_name"]:
        if "steel" in t:
            raise ValueError("unreadable")
        out.append(sorted(set(t.split())))
    return out


@add("classify_with_model", "SELECT md5(p_name) AS text_hash, CASE WHEN p_partkey % 3 = 0 THEN 'known' WHEN NOT contains(p_name, 'steel') THEN array_to_string(list_sort(list_distinct(string_split(p_name, ' '))), ',') END AS labels, CASE WHEN p_partkey % 3 <> 0 AND contains(p_name, 'steel') THEN 'ValueError: unreadable' END AS error FROM (SELECT p_name, CASE WHEN bool_or(p_partkey % 3 = 0) THEN 0 ELSE 1 END AS p_partkey FROM part GROUP BY p_name)")
def classify_with_model(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("text_hash", F.md5("p_name"))
    have = p.where("p_partkey % 3 = 0").select("text_hash", F.array(F.lit("known")).alias("labels")).distinct()
    done, failed = C.classify_with(p, have, "text_hash", "p_name", _label_model)
    none = F.lit(None).cast("string")
    return done.select("text_hash", F.array_join("labels", ",").alias("labels"), none.alias("error")).unionByName(failed.select("text_hash", none.alias("labels"), "error"))


def _shape_model(batch):
    return [[float(len(t)), float(t.count(" ") + 1)] for t in batch["p_name"]]


@add("embed_missing", "SELECT text_hash, model, v[1] AS x, v[2] AS y FROM (SELECT DISTINCT md5(p_name) AS text_hash, 'other' AS model, [0.5::DOUBLE, 0.5::DOUBLE] AS v FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT DISTINCT md5(p_name), 'shape', CASE WHEN known THEN [0.0::DOUBLE, 0.0::DOUBLE] ELSE [length(p_name)::DOUBLE, len(string_split(p_name, ' '))::DOUBLE] END FROM (SELECT p_name, bool_or(p_partkey % 3 = 0) AS known FROM part GROUP BY p_name))")
def embed_missing(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("text_hash", F.md5("p_name"))
    had = lambda rows, model, x: rows.select("text_hash", F.lit(model).alias("model"), F.array(F.lit(x), F.lit(x)).alias("vector")).distinct()
    cache = had(p.where("p_partkey % 3 = 0"), "shape", 0.0).unionByName(had(p.where("p_partkey % 5 = 0"), "other", 0.5))
    done, _ = C.embed_missing(cache, p, "text_hash", "p_name", "shape", _shape_model)
    return done.select("text_hash", "model", F.col("vector")[0].alias("x"), F.col("vector")[1].alias("y"))


def _term_model(batch):
    return [sorted({n.lower(), t.lower(), n.lower().split(" ")[1]}) for n, t in zip(batch["p_name"], batch["p_type"], strict=True)]


@add("generate_terms", "SELECT p_partkey AS code, CASE WHEN p_partkey % 4 = 0 THEN 'done' ELSE array_to_string(list_sort(list_distinct([lower(p_name), lower(p_type), split_part(lower(p_name), ' ', 2)])), '|') END AS terms FROM part")
def generate_terms(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), "p_name", "p_type")
    had = p.where("code % 4 = 0").select("code", F.array(F.lit("done")).alias("terms"))
    done, _ = C.generate_terms(p, had, "code", ["p_name", "p_type"], _term_model)
    return done.select("code", F.array_join("terms", "|").alias("terms"))
