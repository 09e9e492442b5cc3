"""Catalogue, allow-list, term and keyed-table queries on part, supplier, orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.functions.fixed import GENERIC_TERMS, VARIANT_GROUPS
from tenderspark.operators import catalog as K
from tenderspark.operators import tables as B
from tenderspark.plans.demo import CATALOG, DESCRIBED, ITEMS, LINE_ORDER, Plans, catalog, described, items, r4, sql4, table
from tenderspark.sources.files import scratch, written
from tenderspark.sources.observed import counts_table, loaded, parsed

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql

# The allow-list: PDMs (sizes) of materials by supplier key, codes of services by customer key; some inactive.
_ALLOW = """allow AS (SELECT 'material' AS kind, CAST(s_suppkey % 40 AS VARCHAR) AS code, min(s_suppkey) % 7 <> 0 AS active FROM supplier GROUP BY 1, 2
  UNION ALL SELECT 'service' AS kind, CAST(c_custkey AS VARCHAR) AS code, c_custkey % 5 <> 0 AS active FROM customer)"""
_KEY = "CASE WHEN kind = 'material' THEN pdm ELSE code END"
_ALLOWED = f"{CATALOG}, {_ALLOW}, allowed AS (SELECT catalog.* FROM catalog SEMI JOIN (SELECT kind AS k, code AS c FROM allow WHERE active) a ON kind = k AND {_KEY} = c)"


def allow(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 40).cast("string").alias("code")).agg((F.min("s_suppkey") % 7 != 0).alias("active")).select(F.lit("material").alias("kind"), "code", "active")
    return s.unionByName(table(spark, sf_dir, "customer").select(F.lit("service").alias("kind"), F.col("c_custkey").cast("string").alias("code"), (F.col("c_custkey") % 5 != 0).alias("active")))


@add("filter_allow_list", f"WITH {_ALLOWED} SELECT kind, code, pdm FROM allowed")
def filter_allow_list(spark, sf_dir):
    return K.filter_allow_list(catalog(spark, sf_dir), allow(spark, sf_dir)).select("kind", "code", "pdm")


@add("filter_groups", f"WITH {CATALOG} SELECT kind, code, group_name FROM catalog WHERE group_name IN ('PROMO', 'LARGE')")
def filter_groups(spark, sf_dir):
    return K.filter_groups(catalog(spark, sf_dir), ["PROMO", "LARGE"]).select("kind", "code", "group_name")


@add("keyword_prefilter", f"WITH {CATALOG} SELECT code, hits FROM (SELECT code, CAST(len(list_filter(['red', 'bolt', 'brand', '12'], lambda t: contains(lower(description || ' ' || name), t))) AS INT) AS hits FROM catalog) WHERE hits > 0")
def keyword_prefilter(spark, sf_dir):
    return K.keyword_prefilter(catalog(spark, sf_dir), "Red  bolt de Brand 12", ["description", "name"], "code").select("code", "hits")


_CURRENT = "current AS (SELECT kind, code, 'cat' || substr(code, 1, 1) AS category FROM catalog WHERE CAST(code AS BIGINT) % 3 = 0)"


def current(spark, sf_dir):
    return catalog(spark, sf_dir).where("cast(code as bigint) % 3 = 0").select("kind", "code", F.concat(F.lit("cat"), F.substring("code", 1, 1)).alias("category"))


@add("derive_catalog", f"WITH {_ALLOWED}, {_CURRENT} SELECT kind, code, category, allowed.code IS NOT NULL AS active FROM allowed FULL JOIN current USING (kind, code)")
def derive_catalog(spark, sf_dir):
    return K.derive_catalog(catalog(spark, sf_dir), allow(spark, sf_dir), current(spark, sf_dir))


@add("prune_inactive", f"WITH {_ALLOWED}, {_CURRENT}, derived AS (SELECT code, allowed.code IS NOT NULL AS active FROM allowed FULL JOIN current USING (kind, code)), {ITEMS} SELECT item_key, code FROM items ANTI JOIN (SELECT CAST(code AS BIGINT) AS c FROM derived WHERE NOT active) d ON code = c")
def prune_inactive(spark, sf_dir):
    derived = K.derive_catalog(catalog(spark, sf_dir), allow(spark, sf_dir), current(spark, sf_dir)).withColumn("code", F.col("code").cast("bigint"))
    return K.prune_inactive(items(spark, sf_dir), derived, ["code"]).select("item_key", "code")


@add("doc_code_type", "SELECT code, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, count(DISTINCT kind) > 1 AS ambiguous FROM (SELECT CAST(p_size AS VARCHAR) AS code, CASE WHEN p_partkey % 2 = 0 THEN 'material' ELSE 'service' END AS kind FROM part) GROUP BY code")
def doc_code_type(spark, sf_dir):
    return K.code_types(catalog(spark, sf_dir).select(F.col("pdm").alias("code"), "kind")).withColumn("kinds", F.array_join("kinds", ","))


@add("list_allow_with_counts", f"WITH {CATALOG}, {_ALLOW} SELECT kind, allow.code, active, coalesce(n, 0) AS n_catalog FROM allow LEFT JOIN (SELECT kind, {_KEY} AS code, count(*) AS n FROM catalog GROUP BY ALL) USING (kind, code) WHERE kind = 'material'")
def list_allow_with_counts(spark, sf_dir):
    return K.list_allow_with_counts(allow(spark, sf_dir), catalog(spark, sf_dir), "material")


@add("link_existing_codes", f"WITH {CATALOG} SELECT DISTINCT term, code FROM (SELECT c_mktsegment AS term, CAST(c_custkey * 3 AS VARCHAR) AS code FROM customer) SEMI JOIN catalog USING (code)")
def link_existing_codes(spark, sf_dir):
    links = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("term"), (F.col("c_custkey") * 3).cast("string").alias("code"))
    return links.distinct().join(catalog(spark, sf_dir).select("code"), "code", "left_semi").select("term", "code")


@add("catalog_text", "SELECT p_partkey AS code, trim(coalesce(p_brand, '') || ' ' || coalesce(CASE WHEN p_size > 10 THEN p_name END, '')) AS text FROM part")
def catalog_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), F.trim(F.concat_ws(" ", F.coalesce("p_brand", F.lit("")), F.coalesce(F.when(F.col("p_size") > 10, F.col("p_name")), F.lit("")))).alias("text"))


@add("final_description", f"WITH {DESCRIBED} SELECT item_key, coalesce(nullif(CASE WHEN flag = 'R' THEN upper(description) WHEN flag = 'A' THEN '' END, ''), description) AS final_description FROM described")
def final_description(spark, sf_dir):
    d = described(spark, sf_dir)
    enriched = d.where("flag in ('R', 'A')").select("item_key", F.when(F.col("flag") == "R", F.upper("description")).otherwise("").alias("_final"))
    return d.join(enriched, "item_key", "left").select("item_key", F.coalesce(F.nullif("_final", F.lit("")), "description").alias("final_description"))


@add("lookup_final_attrs", f"WITH {DESCRIBED} SELECT item_key, code, description AS text, category AS group_name, s_name AS supplier_name FROM described JOIN supplier ON supplier = s_suppkey")
def lookup_final_attrs(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name"))
    return described(spark, sf_dir).join(s, "supplier", "left").select("item_key", "code", F.col("description").alias("text"), F.col("category").alias("group_name"), "supplier_name")


@add("filter_approved", "SELECT l_orderkey AS document, l_linenumber AS number, l_partkey AS code FROM lineitem WHERE trim('  ' || l_linestatus || ' ') = 'O'")
def filter_approved(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("l_linestatus"), F.lit(" "))
    return table(spark, sf_dir, "lineitem").where(F.trim(padded) == "O").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("code"))


@add("select_target_files", f"WITH {ITEMS} SELECT document, string_agg(item_key, ',' ORDER BY seq, item_key) AS files FROM (SELECT document, item_key, CASE WHEN number = 7 THEN 0 ELSE number END AS seq FROM items WHERE flag = 'R') GROUP BY document")
def select_target_files(spark, sf_dir):
    seq = F.coalesce(F.when(F.col("number") != 7, F.col("number")), F.lit(0))
    files = F.array_sort(F.collect_list(F.struct(seq.alias("seq"), "item_key")))
    return items(spark, sf_dir).where("flag = 'R'").groupBy("document").agg(F.array_join(F.transform(files, lambda x: x["item_key"]), ",").alias("files"))


@add("valid_categories", "SELECT p_partkey AS code, array_to_string(list_filter(list_transform(string_split(p_type || ' ,' || p_name, ','), lambda x: lower(trim(x))), lambda x: x IN ('promo', 'large', 'red bolt', 'blue ring')), '|') AS categories FROM part")
def valid_categories(spark, sf_dir):
    raw = F.split(F.concat(F.col("p_type"), F.lit(" ,"), F.col("p_name")), ",")
    known = F.filter(F.transform(raw, lambda x: F.lower(F.trim(x))), lambda x: x.isin("promo", "large", "red bolt", "blue ring"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), F.array_join(known, "|").alias("categories"))


# The fixed lists, and words of the parts' names beside them; every seventh part asks for a generic term, every fifth for
# one of many forms.
_GENERIC = [*GENERIC_TERMS, "ring", "BOLT", "widget"]
_GROUPS = [*VARIANT_GROUPS, ["red", "rubro"], ["small", "mini", "pequeno"]]
_GENERIC_SQL = "(" + ", ".join(f"'{g.lower()}'" for g in _GENERIC) + ")"
_EXTRA = "CASE WHEN p_partkey % 7 = 0 THEN ['equipamento'] ELSE [] END || CASE WHEN p_partkey % 5 = 0 THEN ['picape'] ELSE [] END"
_ASKED = f"asked AS (SELECT p_partkey AS code, lower(unnest(string_split(p_name, ' ') || {_EXTRA})) AS term FROM part)"
_TERMS = "terms AS (SELECT lower(unnest(string_split(p_name, ' '))) AS term FROM part)"
_VARIANTS = "groups(g, form) AS (VALUES " + ", ".join(f"('g{i}', '{form}')" for i, forms in enumerate(_GROUPS) for form in forms) + ")"


def terms(spark, sf_dir):
    k = F.col("p_partkey")
    more = F.concat(F.when(k % 7 == 0, F.array(F.lit("EQUIPAMENTO"))).otherwise(F.array()), F.when(k % 5 == 0, F.array(F.lit("Picape"))).otherwise(F.array()))
    return table(spark, sf_dir, "part").select(k.alias("code"), F.explode(F.concat(F.split(F.upper("p_name"), " "), more)).alias("term"))


def generic(spark):
    return spark.createDataFrame([(g,) for g in _GENERIC], "term string")


def variants(spark):
    return spark.createDataFrame([(f"g{i}", form) for i, forms in enumerate(_GROUPS) for form in forms], "group string, form string")


@add("drop_generic_terms", f"WITH {_ASKED} SELECT code, CASE term WHEN 'picape' THEN 'Picape' ELSE upper(term) END AS term FROM asked WHERE term NOT IN {_GENERIC_SQL}")
def drop_generic_terms(spark, sf_dir):
    return K.drop_generic_terms(terms(spark, sf_dir), generic(spark), "term")


@add("expand_variants", f"WITH {_ASKED}, {_VARIANTS} SELECT code, term FROM asked UNION SELECT code, o.form FROM asked JOIN groups i ON term = i.form JOIN groups o ON i.g = o.g")
def expand_variants(spark, sf_dir):
    return K.expand_variants(terms(spark, sf_dir), variants(spark), "code", "term")


@add("expand_terms", f"WITH {_ASKED}, {_VARIANTS} SELECT code, term FROM asked WHERE term NOT IN {_GENERIC_SQL} UNION SELECT code, o.form FROM asked JOIN groups i ON term = i.form JOIN groups o ON i.g = o.g")
def expand_terms(spark, sf_dir):
    return K.expand_terms(terms(spark, sf_dir), variants(spark), generic(spark), "code", "term")


@add("clean_terms", f"WITH {_TERMS} SELECT term, count(*) AS n FROM terms WHERE term NOT IN {_GENERIC_SQL} GROUP BY term")
def clean_terms(spark, sf_dir):
    clean, _ = terms_job(spark, sf_dir)
    kept = K.drop_generic_terms(clean, generic(spark), "term")
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def terms_job(spark, sf_dir):
    """The words of the parts' names, folded, with a count of those that nothing is left of."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.upper("p_name"), " ")).alias("word"))
    return parsed(words, "clean_terms", {"term": (F.col("word"), T.norm_term)}, [], {"term": lambda raw, x: (F.trim(raw) != "") & (F.coalesce(x, F.lit("")) == "")})


@add("path_key_join", "SELECT a.page_id, b.first_page FROM (SELECT page_id, lower(rtrim(split_part(split_part(url, '?', 1), '#', 1), '/')) AS k FROM pages) a JOIN (SELECT k, min(page_id) AS first_page FROM (SELECT page_id, lower(rtrim(split_part(split_part(url, '?', 1), '#', 1), '/')) AS k FROM pages) GROUP BY k) b USING (k)")
def path_key_join(spark, sf_dir):
    bare = F.regexp_replace("url", "[?#].*$", "")
    p = table(spark, sf_dir, "pages").select("page_id", F.replace(F.upper(bare), F.lit("/"), F.lit("\\")).alias("path"))
    keyed = p.select("page_id", K.path_key(F.col("path")).alias("k"))
    return keyed.join(keyed.groupBy("k").agg(F.min("page_id").alias("first_page")), "k").select("page_id", "first_page")


@add("merge_origins", "SELECT l_orderkey AS document, arg_min(l_suppkey, (l_shipdate, l_suppkey, l_partkey)) AS supplier, string_agg(DISTINCT o, '|' ORDER BY o) AS origins FROM (SELECT *, unnest([l_returnflag, l_linestatus || '1']) AS o FROM lineitem) GROUP BY l_orderkey")
def merge_origins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_suppkey").alias("supplier"), F.concat(F.col("l_returnflag"), F.lit("| "), F.col("l_linestatus"), F.lit("1|")).alias("origins"), "l_shipdate", "l_partkey")
    return K.merge_origins(rows, "document", "origins", ["l_shipdate", "supplier", "l_partkey"]).select("document", "supplier", "origins")


@add("first_wins", f"WITH {ITEMS} SELECT item_key, code, supplier FROM items")
def first_wins(spark, sf_dir):
    return items(spark, sf_dir).select("item_key", "code", "supplier")


_LAST = ", ".join(f"{c} DESC" for c in LINE_ORDER)


@add("last_wins", f"SELECT l_orderkey AS document, l_linenumber AS number, l_partkey AS code, l_suppkey AS supplier FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LAST}) = 1")
def last_wins(spark, sf_dir):
    return B.one_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc(c) for c in LINE_ORDER]).select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("supplier"))


@add("batch_dedup", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def batch_dedup(spark, sf_dir):
    return B.one_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"]).select("user_id", "event_type", "event_id")


@add("arrival_position", f"WITH {ITEMS} SELECT code, supplier, item_key, CAST(row_number() OVER (PARTITION BY code ORDER BY shipped, item_key) AS INT) AS position FROM (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY code, supplier ORDER BY shipped, item_key) = 1)")
def arrival_position(spark, sf_dir):
    from pyspark.sql import Window

    once = B.one_per_key(items(spark, sf_dir), ["code", "supplier"], ["shipped", "item_key"])
    return once.select("code", "supplier", "item_key", F.row_number().over(Window.partitionBy("code").orderBy("shipped", "item_key")).alias("position"))


# Two versions of the customer table: the batch holds every other key, repeated, with changes and new keys.
_UPSERT = """batch AS (SELECT c_custkey + CASE WHEN c_custkey % 10 = 0 THEN 1000000 ELSE 0 END AS k, upper(c_name) AS name, c_acctbal + 1 AS balance, 'NEW' AS segment FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(c_custkey, k) AS k, coalesce(c_name, name) AS name, CASE WHEN k IS NOT NULL THEN balance ELSE c_acctbal END AS balance, CASE WHEN c_custkey IS NULL THEN segment ELSE c_mktsegment END AS segment FROM customer FULL JOIN batch ON c_custkey = k"""


@add("upsert", f"WITH {_UPSERT}")
def upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    batch = c.where("k % 2 = 0").select((F.col("k") + F.when(F.col("k") % 10 == 0, 1000000).otherwise(0)).alias("k"), F.upper("name").alias("name"), (F.col("balance") + 1).alias("balance"), F.lit("NEW").alias("segment"), F.lit(1).alias("seq"))
    late = batch.withColumn("seq", F.lit(2)).withColumn("balance", F.col("balance") * 2)
    return B.upsert(c, batch.union(late), ["k"], ["seq"], ["balance"])


@add("append_missing", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 100)")
def append_missing(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return B.append_missing(e.where("event_type = 'signup' and value > 100"), e, ["user_id"]).select("event_id", "user_id")


_SNAP = """cur AS (SELECT p_partkey AS code, md5(coalesce(p_name, '') || coalesce(p_brand, '')) AS h FROM part WHERE p_partkey % 10 <> 1), prev AS (SELECT p_partkey AS code, md5(coalesce(CASE WHEN p_partkey % 10 = 3 THEN upper(p_name) ELSE p_name END, '') || coalesce(p_brand, '')) AS h FROM part WHERE p_partkey % 10 <> 2)"""


@add("catalog_delta", f"WITH {_SNAP} SELECT 'second' AS run, code, CASE WHEN prev.h IS NULL THEN 'new' WHEN cur.h IS NULL THEN 'removed' ELSE 'changed' END AS status FROM cur FULL JOIN prev USING (code) WHERE cur.h IS DISTINCT FROM prev.h")
def catalog_delta(spark, sf_dir):
    """Three runs against a stored baseline: the first sets it and finds nothing, the second finds the changes, the third, on the
    same catalogue, nothing again."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "code")
    now = p.where("code % 10 != 1").select("code", T.row_hash(F.col("p_name"), F.col("p_brand")).alias("h"))
    before = p.where("code % 10 != 2").select("code", T.row_hash(F.when(F.col("code") % 10 == 3, F.upper("p_name")).otherwise(F.col("p_name")), F.col("p_brand")).alias("h"))
    baseline = B.Snapshot(spark, scratch(spark, "catalog-baseline"))
    runs = [written(baseline.delta(rows, ["code"], "h").select(F.lit(run).alias("run"), "code", "status"), "delta") for run, rows in (("first", before), ("second", now), ("third", now))]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@add("null_safe_change", "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'X' ELSE c_mktsegment END AS segment FROM customer WHERE CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'X' ELSE c_mktsegment END IS DISTINCT FROM CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END")
def null_safe_change(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    now = c.withColumn("segment", F.when(F.col("k") % 6 != 0, F.col("segment")))
    new = c.withColumn("segment", F.when(F.col("k") % 3 == 1, "X").when(F.col("k") % 3 == 2, F.col("segment")))
    return B.changed_only(now, new, ["k"], "segment")


@add("config_diff", "WITH a AS (SELECT n_name AS k, CAST(n_regionkey AS VARCHAR) AS v FROM nation WHERE n_nationkey < 20), b AS (SELECT n_name AS k, CAST(n_regionkey + n_nationkey % 2 AS VARCHAR) AS v FROM nation WHERE n_nationkey > 4) SELECT k, a.v AS value_a, b.v AS value_b FROM a FULL JOIN b USING (k) WHERE a.v IS DISTINCT FROM b.v")
def config_diff(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_name", "k")
    a = n.where("n_nationkey < 20").select("k", F.col("n_regionkey").cast("string").alias("v"))
    b = n.where("n_nationkey > 4").select("k", (F.col("n_regionkey") + F.col("n_nationkey") % 2).cast("string").alias("v"))
    return B.value_diff(a, b, "k", "v")


@add("merge_keep_manual", "WITH old AS (SELECT p_brand AS term, bool_or(p_partkey % 50 = 0) AS manual FROM part WHERE p_size < 40 GROUP BY 1), gen AS (SELECT DISTINCT p_brand AS term FROM part WHERE p_size >= 20 AND p_brand <> 'Brand#7') SELECT term, CASE WHEN coalesce(manual, false) THEN 'manual' ELSE 'generated' END AS origin, coalesce(manual, false) OR gen.term IS NOT NULL AS active FROM old FULL JOIN gen USING (term)")
def merge_keep_manual(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumnRenamed("p_brand", "term")
    old = p.where("p_size < 40").groupBy("term").agg(F.bool_or(F.col("p_partkey") % 50 == 0).alias("manual"))
    gen = p.where("p_size >= 20 and term != 'Brand#7'").select("term")
    return B.retire_missing(gen, old, "term", F.col("manual"))


#: Orphans by name: child table and key, parent table and key.
_ORPHANS = [
    ("line_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("line_part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("line_supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("order_customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer_nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier_nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation_region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("label_document", "labels", "doc_id", "documents", "doc_id"),
]
#: Rules by name, table and condition of the rows that break them; a blank or missing hash stands for a text never hashed.
_RULES = [
    ("document_without_hash", "documents", "coalesce(trim(text), '') = ''"),
    ("label_not_0_or_1", "labels", "quality not in (0, 1) or toxic not in (0, 1)"),
    ("line_position", "lineitem", "l_linenumber <= 0"),
    ("line_shipped_unpriced", "lineitem", "l_linestatus = 'F' and coalesce(l_extendedprice, 0) <= 0"),
    ("vector_size", "embeddings", "SIZE(embedding) <> 64"),
]


def _orphan_sql() -> str:
    parts = [f"SELECT '{n}' AS check_name, count(*) AS n FROM {c} WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{pk} = {c}.{ck})" for n, c, ck, p, pk in _ORPHANS]
    parts += [f"SELECT '{n}', count(*) FROM {t} WHERE {cond.replace('SIZE(', 'len(')}" for n, t, cond in _RULES]
    return " UNION ALL ".join(parts)


@add("orphan_checks", _orphan_sql())
def orphan_checks(spark, sf_dir):
    """Eight checks for orphans and five rules; all are expected to count nothing in clean data."""
    tables = {t: table(spark, sf_dir, t) for t in {x for _, c, _, p, _ in _ORPHANS for x in (c, p)} | {t for _, t, _ in _RULES}}
    key = lambda t, k: tables[t].select(F.col(k).alias("k"))
    orphans = B.orphan_report([(n, key(c, ck), key(p, pk), ["k"]) for n, c, ck, p, pk in _ORPHANS])
    return orphans.unionByName(B.rule_report([(n, tables[t], F.expr(cond)) for n, t, cond in _RULES]))


@add("table_counts", "SELECT name AS table_name, n, e AS expected, n - e AS delta, abs(n - e) <= 0.01 * e AS ok FROM (SELECT 'nation' AS name, (SELECT count(*) FROM nation) AS n, 25::BIGINT AS e UNION ALL SELECT 'region', (SELECT count(*) FROM region), 5 UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), 101 UNION ALL SELECT 'part', (SELECT count(*) FROM part), 1900)")
def table_counts(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return B.count_report({"nation": (t("nation"), 25), "region": (t("region"), 5), "supplier": (t("supplier"), 101), "part": (t("part"), 1900)})


@add("load_report", "WITH r AS (SELECT CASE WHEN l_quantity > 45 THEN 'too_many' WHEN l_discount > 0.09 THEN 'discount' ELSE 'written' END AS metric FROM lineitem) SELECT 'lines' AS step, metric, count(*) AS n FROM r GROUP BY metric UNION ALL SELECT 'lines', 'read', count(*) FROM r")
def load_report(spark, sf_dir):
    """Lines are loaded; the job that writes them counts those read, dropped by reason and written."""
    _, seen = loaded(table(spark, sf_dir, "lineitem"), "lines", {"too_many": F.col("l_quantity") > 45, "discount": F.col("l_discount") > 0.09})
    return counts_table(spark, {"lines": seen})


@add("limit_units", f"WITH {ITEMS} SELECT item_key, code FROM items WHERE status = 'O' ORDER BY item_key LIMIT 1000")
def limit_units(spark, sf_dir):
    return items(spark, sf_dir).where("status = 'O'").orderBy("item_key").limit(1000).select("item_key", "code")


@add("filter_pending_docs", f"WITH {ITEMS}, pend AS (SELECT DISTINCT document FROM items WHERE item_key NOT IN (SELECT item_key FROM items WHERE flag = 'R') UNION SELECT document FROM items WHERE document % 1000 = 0) SELECT document FROM pend ORDER BY document LIMIT 5000")
def filter_pending_docs(spark, sf_dir):
    i = items(spark, sf_dir)
    open_docs = B.append_missing(i.where("flag = 'R'"), i, ["item_key"]).select("document")
    return open_docs.union(i.where("document % 1000 = 0").select("document")).distinct().orderBy("document").limit(5000)


@add("update_from", f"WITH {ITEMS} SELECT o_orderkey AS document, coalesce(n, 0) AS n_items, coalesce(q, 0) AS quantity, CASE WHEN n IS NULL THEN 'out_of_scope' ELSE o_orderstatus END AS state FROM orders LEFT JOIN (SELECT document, count(*) AS n, sum(quantity) AS q FROM items GROUP BY document) ON document = o_orderkey")
def update_from(spark, sf_dir):
    n = items(spark, sf_dir).groupBy("document").agg(F.count(F.lit(1)).alias("_n"), F.sum("quantity").alias("_q"))
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "document").join(n, "document", "left")
    return o.select("document", F.coalesce("_n", F.lit(0)).alias("n_items"), F.coalesce("_q", F.lit(0.0)).alias("quantity"), F.when(F.col("_n").isNull(), "out_of_scope").otherwise(F.col("o_orderstatus")).alias("state"))


@add("embedding_cache_join", f"SELECT vec_id, {sql4('list_cosine_similarity(embedding::DOUBLE[], [1.0] || list_transform(generate_series(2, 64), lambda x: 0.0))')} AS first_axis, vec_id % 3 = 0 AS cached FROM embeddings")
def embedding_cache_join(spark, sf_dir):
    from tenderspark.operators.matching import unit

    e = table(spark, sf_dir, "embeddings")
    cache = e.where("vec_id % 3 = 0").select("vec_id", unit(F.col("embedding")).alias("v"), F.lit(True).alias("cached"))
    fresh = B.append_missing(cache, e, ["vec_id"]).select("vec_id", unit(F.col("embedding")).alias("v"), F.lit(False).alias("cached"))
    return e.select("vec_id").join(cache.unionByName(fresh), "vec_id").select("vec_id", r4(F.col("v")[0]).alias("first_axis"), "cached")
