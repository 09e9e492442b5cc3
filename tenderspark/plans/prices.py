"""Price queries: unit prices of items by catalogue code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.operators.catalog import placed
from tenderspark.operators import prices as P
from tenderspark.plans.demo import CATALOG, DESCRIBED, ITEMS, Plans, catalog, described, items, r4, sql4, table

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql

_BOUNDS = "bounds AS (SELECT code, quantile_cont(CAST(unit_price AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(unit_price AS DOUBLE), 0.75) AS q3 FROM items GROUP BY code)"
_FLAGGED = "flagged AS (SELECT items.*, unit_price IS NULL OR unit_price <= 0 OR unit_price < q1 - 0.5 * (q3 - q1) OR unit_price > q3 + 0.5 * (q3 - q1) AS price_flag FROM items JOIN bounds USING (code))"
_BANDS = "bands AS (SELECT p_type AS category, CASE WHEN p_type <> 'SMALL' THEN min(p_retailprice) * 0.9 END AS price_min, CASE WHEN p_type <> 'PROMO' THEN max(p_retailprice) * 1.6 END AS price_max FROM part GROUP BY p_type)"


def bands(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.groupBy(F.col("p_type").alias("category")).agg((F.min("p_retailprice") * 0.9).alias("_a"), (F.max("p_retailprice") * 1.6).alias("_b")).select("category", F.when(F.col("category") != "SMALL", F.col("_a")).alias("price_min"), F.when(F.col("category") != "PROMO", F.col("_b")).alias("price_max"))


@add("iqr_bounds", f"WITH {ITEMS}, {_BOUNDS} SELECT code, {sql4('q1')} AS q1, {sql4('q3')} AS q3, {sql4('q1 - 3 * (q3 - q1)')} AS lo, {sql4('q3 + 3 * (q3 - q1)')} AS hi FROM bounds")
def iqr_bounds(spark, sf_dir):
    b = P.iqr_bounds(items(spark, sf_dir), ["code"], "unit_price")
    return b.select("code", *[r4(c).alias(c) for c in ("q1", "q3", "lo", "hi")])


@add("price_flags", f"WITH {ITEMS}, {_BOUNDS}, {_FLAGGED} SELECT item_key, code, unit_price, price_flag FROM flagged")
def price_flags(spark, sf_dir):
    return P.price_flags(items(spark, sf_dir), ["code"], "unit_price", 0.5).select("item_key", "code", "unit_price", "price_flag")


@add("price_band_flag", f"WITH {DESCRIBED}, {_BANDS} SELECT item_key, category, unit_price, coalesce(unit_price < price_min, false) OR coalesce(unit_price > price_max, false) AS price_flag FROM described LEFT JOIN bands USING (category)")
def price_band_flag(spark, sf_dir):
    d = described(spark, sf_dir).withColumn("price_flag", F.lit(False))
    return P.with_bands(d, bands(spark, sf_dir), "category", "unit_price").select("item_key", "category", "unit_price", "price_flag")


@add("group_report", f"WITH {ITEMS}, {_BOUNDS}, {_FLAGGED} SELECT code, count(DISTINCT item_key) FILTER (NOT price_flag) AS n_valid, count(DISTINCT item_key) FILTER (price_flag) AS n_flagged, count(DISTINCT item_key) FILTER (NOT price_flag) >= 20 AS closed FROM flagged GROUP BY code")
def group_report(spark, sf_dir):
    return P.group_report(P.price_flags(items(spark, sf_dir), ["code"], "unit_price", 0.5), ["code"], "item_key", 20)


@add("rank_cheapest", f"WITH {ITEMS} SELECT code, item_key, unit_price, CAST(row_number() OVER (PARTITION BY code ORDER BY unit_price, item_key) AS INT) AS position FROM items")
def rank_cheapest(spark, sf_dir):
    return P.rank_cheapest(items(spark, sf_dir), ["code"], "unit_price", "item_key").select("code", "item_key", "unit_price", "position")


@add("top_n_per_code", f"WITH {ITEMS} SELECT code, item_key, unit_price, CAST(row_number() OVER (PARTITION BY code ORDER BY unit_price, item_key) AS INT) AS position FROM items QUALIFY position <= 5")
def top_n_per_code(spark, sf_dir):
    return P.rank_cheapest(items(spark, sf_dir), ["code"], "unit_price", "item_key", 5).select("code", "item_key", "unit_price", "position")


@add("min_items_per_code", f"WITH {ITEMS} SELECT item_key, code FROM items SEMI JOIN (SELECT code FROM items GROUP BY code HAVING count(DISTINCT item_key) >= 25) USING (code)")
def min_items_per_code(spark, sf_dir):
    return P.enough_items(items(spark, sf_dir), ["code"], "item_key", 25).select("item_key", "code")


@add("rank_prices", f"""WITH {DESCRIBED}, {_BANDS}, bounds AS (SELECT code, quantile_cont(CAST(unit_price AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(unit_price AS DOUBLE), 0.75) AS q3 FROM described GROUP BY code),
valid AS (SELECT described.* FROM described JOIN bounds USING (code) LEFT JOIN bands USING (category)
  WHERE unit_price > 0 AND unit_price >= q1 - 3 * (q3 - q1) AND unit_price <= q3 + 3 * (q3 - q1) AND NOT coalesce(unit_price < price_min, false) AND NOT coalesce(unit_price > price_max, false)),
enough AS (SELECT code FROM valid GROUP BY code HAVING count(DISTINCT item_key) >= 3)
SELECT code, item_key, category, unit_price, CAST(row_number() OVER (PARTITION BY code ORDER BY unit_price, item_key) AS INT) AS position FROM valid SEMI JOIN enough USING (code) QUALIFY position <= 10""")
def rank_prices(spark, sf_dir):
    out = P.rank_prices(described(spark, sf_dir), ["code"], "unit_price", "item_key", bands(spark, sf_dir), "category", 3.0, 3, 10)
    return out.select("code", "item_key", "category", "unit_price", "position")


@add("pick_winner", "SELECT l_orderkey AS document, l_linenumber AS number, arg_min(l_suppkey, k) AS supplier, arg_min(l_extendedprice, k) AS price FROM (SELECT *, (CASE WHEN l_extendedprice > 5000 THEN 0 ELSE 1 END, CASE WHEN l_discount > 0.05 THEN 9999 ELSE CAST(l_tax * 100 AS INT) END, l_suppkey, l_extendedprice) AS k FROM lineitem) GROUP BY 1, 2")
def pick_winner(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("number"), F.col("l_suppkey").alias("supplier"), F.col("l_extendedprice").alias("price"), F.when(F.col("l_extendedprice") > 5000, 1).otherwise(0).alias("valid"), F.when(F.col("l_discount") <= 0.05, F.round(F.col("l_tax") * 100).cast("int")).alias("rank"), F.struct("l_suppkey", "l_extendedprice").alias("seq"))
    return P.pick_winner(rows, ["document", "number"], "valid", "rank", "seq").select("document", "number", "supplier", "price")


@add("homologated_price", f"WITH {ITEMS}, won AS (SELECT document, number, unit_price * 0.9 AS p, supplier AS s, shipped AS d FROM items WHERE flag <> 'N') SELECT item_key, CASE WHEN coalesce(p <> 0, false) THEN p ELSE unit_price END AS price, CASE WHEN coalesce(p <> 0, false) THEN s END AS supplier, CASE WHEN coalesce(p <> 0, false) THEN d END AS dated FROM items LEFT JOIN won USING (document, number)")
def homologated_price(spark, sf_dir):
    i = items(spark, sf_dir)
    won = i.where("flag != 'N'").select("document", "number", (F.col("unit_price") * 0.9).alias("price"), "supplier", F.col("shipped").alias("dated"))
    out = P.homologated_price(i.drop("supplier"), won, ["document", "number"], "unit_price")
    return out.select("item_key", "price", "supplier", "dated")


@add("sorted_listing", f"WITH {CATALOG} SELECT code, group_name, CAST(row_number() OVER (ORDER BY length(code), code) AS INT) AS place FROM catalog")
def sorted_listing(spark, sf_dir):
    return placed(catalog(spark, sf_dir), "code").select("code", "group_name", "place")
