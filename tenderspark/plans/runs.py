"""Run comparison, exports, lineage, cost and error queries; runs are ship years, cost calls are events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.operators import runs as R
from tenderspark.operators.tables import Snapshot, one_per_key
from tenderspark.plans.demo import DESCRIBED, ITEMS, Plans, described, items, parts, r4, sql4, table
from tenderspark.sources.files import scratch, written

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql

_RUN = lambda s: f"SELECT code, supplier, unit_price FROM items WHERE status = '{s}' QUALIFY row_number() OVER (PARTITION BY code, supplier ORDER BY shipped DESC, item_key DESC) = 1"


@add("run_diff", f"WITH {ITEMS}, a AS ({_RUN('F')}), b AS ({_RUN('O')}) SELECT code, supplier, CASE WHEN a.unit_price IS NULL THEN 'new' WHEN b.unit_price IS NULL THEN 'gone' ELSE 'changed' END AS status, a.unit_price AS price_a, b.unit_price AS price_b, {sql4('(b.unit_price - a.unit_price) / a.unit_price')} AS change FROM a FULL JOIN b USING (code, supplier) WHERE a.unit_price IS NULL OR b.unit_price IS NULL OR abs((b.unit_price - a.unit_price) / a.unit_price) > 0.1")
def run_diff(spark, sf_dir):
    i = items(spark, sf_dir)
    out = R.run_diff(i.where("status = 'F'"), i.where("status = 'O'"), ["code", "supplier"], "unit_price", ["shipped", "item_key"], 0.1)
    return out.withColumn("change", r4("change"))


_EXPORTED = "(SELECT DISTINCT code, supplier FROM items WHERE shipped < TIMESTAMP '1998-01-01')"


@add("new_since_export", f"WITH {ITEMS} SELECT 'second' AS run, item_key, code FROM items ANTI JOIN {_EXPORTED} s USING (code, supplier) UNION ALL SELECT 'first', item_key, code FROM items WHERE shipped < TIMESTAMP '1998-01-01'")
def new_since_export(spark, sf_dir):
    """Three exports: of the first everything is new, of the second what the first had not, of the third, the same rows, nothing."""
    i = written(items(spark, sf_dir).select("item_key", "code", "supplier", "shipped"), "report")  # read six times
    exported = Snapshot(spark, scratch(spark, "exported"))
    runs = [written(R.export_new(rows, exported, ["code", "supplier"]).select(F.lit(run).alias("run"), "item_key", "code"), "new") for run, rows in (("first", i.where("shipped < timestamp'1998-01-01'")), ("second", i), ("third", i))]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@add("latest_run_with_ranking", f"WITH {ITEMS} SELECT max(year(shipped)) AS run_id FROM items WHERE flag = 'R'")
def latest_run_with_ranking(spark, sf_dir):
    return items(spark, sf_dir).where("flag = 'R'").agg(F.max(F.year("shipped").cast("long")).alias("run_id"))


@add("confirmed_pairs", f"WITH {DESCRIBED} SELECT item_key, code, CASE WHEN flag = 'R' THEN upper(description) ELSE description END AS text, unit_price, o_orderdate AS dated, c_name AS buyer FROM described JOIN orders ON document = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE unit_price >= 2000")
def confirmed_pairs(spark, sf_dir):
    d = described(spark, sf_dir)
    enriched = d.where("flag = 'R'").select("item_key", F.upper("description").alias("_final"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document"), F.col("o_orderdate").alias("dated"), F.col("o_custkey").alias("c_custkey"))
    out = d.where("unit_price >= 2000").join(enriched, "item_key", "left").join(o, "document").join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("buyer")), "c_custkey")
    return out.select("item_key", "code", F.coalesce("_final", "description").alias("text"), "unit_price", "dated", "buyer")


@add("run_lines", f"WITH {DESCRIBED} SELECT item_key, code, category, s_name AS supplier_name, n_name AS buyer_nation, unit_price FROM described JOIN orders ON document = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON supplier = s_suppkey WHERE year(shipped) = 1997")
def run_lines(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    o = t("orders").select(F.col("o_orderkey").alias("document"), F.col("o_custkey").alias("c_custkey"))
    buyers = t("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(t("nation").select("n_nationkey", F.col("n_name").alias("buyer_nation")), "n_nationkey")
    run = described(spark, sf_dir).where((F.col("shipped") >= F.lit("1997-01-01").cast("timestamp")) & (F.col("shipped") < F.lit("1998-01-01").cast("timestamp")))
    return run.join(o, "document").join(buyers, "c_custkey").join(t("supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name")), "supplier").select("item_key", "code", "category", "supplier_name", "buyer_nation", "unit_price")


_RANKED = f"{DESCRIBED}, ranked AS (SELECT *, year(shipped) AS run_id, row_number() OVER (PARTITION BY year(shipped), code ORDER BY unit_price, item_key) AS position FROM described)"


def ranked(spark, sf_dir):
    from tenderspark.operators.prices import rank_cheapest

    return rank_cheapest(described(spark, sf_dir).withColumn("run_id", F.year("shipped").cast("long")), ["run_id", "code"], "unit_price", "item_key")


@add("audit_trail", f"WITH {_RANKED} SELECT run_id, code, CAST(position AS INT) AS position, item_key, o_orderdate AS dated, c_name AS buyer, r_name AS region, s_name AS supplier_name, CASE WHEN flag = 'R' THEN upper(description) END AS final_text, CASE WHEN unit IN ('Brand#1', 'Brand#2') THEN 'class-' || unit END AS text_class FROM ranked JOIN orders ON document = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON supplier = s_suppkey WHERE run_id = 1998")
def audit_trail(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    r = ranked(spark, sf_dir).where("run_id = 1998")
    d = described(spark, sf_dir)
    enriched = d.where("flag = 'R'").select("item_key", F.upper("description").alias("final_text"))
    classes = t("part").where("p_brand in ('Brand#1', 'Brand#2')").select(F.col("p_partkey").alias("code"), F.concat(F.lit("class-"), "p_brand").alias("text_class"))
    o = t("orders").select(F.col("o_orderkey").alias("document"), F.col("o_orderdate").alias("dated"), F.col("o_custkey").alias("c_custkey"))
    place = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    out = r.join(o, "document").join(t("customer").select("c_custkey", "c_nationkey", F.col("c_name").alias("buyer")), "c_custkey").join(place, "c_nationkey")
    out = out.join(enriched, "item_key", "left").join(classes, "code", "left").join(t("supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name")), "supplier", "left")
    return out.select("run_id", "code", "position", "item_key", "dated", "buyer", "region", "supplier_name", "final_text", "text_class")


_BR = lambda x: f"replace(replace(replace(format('{{:,.2f}}', floor({x} * 100 + 0.5) / 100), ',', ';'), '.', ','), ';', '.')"
_REPORT = f"""WITH {_RANKED}, r AS (SELECT *, document % 2 = 0 AS contract, lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS cnpj FROM ranked JOIN orders ON document = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON supplier = s_suppkey)
SELECT run_id, CAST(position AS INT) AS position, CAST(code AS VARCHAR) AS "Codigo CATMAT/CATSER", CASE WHEN code % 2 = 0 THEN 'Material' ELSE 'Serviço' END AS "Material/Servico", category AS "Tipo",
  CASE WHEN code % 2 = 0 THEN split_part(description, ' ', 1) ELSE unit END AS "Nome", CASE WHEN code % 2 = 0 THEN replace(description, ' ', ', ') ELSE description END AS "Descricao Base",
  CASE WHEN flag = 'R' THEN upper(description) ELSE '' END AS "Descricao Especifica", c_name AS "Orgao", cnpj AS "CNPJ Orgao", n_name AS "UF",
  cnpj || CASE WHEN contract THEN '-2-' ELSE '-1-' END || lpad(CAST(document AS VARCHAR), 8, '0') || '/' || year(o_orderdate) || CASE WHEN contract THEN '' ELSE '-' || (document % 90 + 1) END AS "Num Controle PNCP",
  CAST(document AS VARCHAR) AS "Seq Compra", CASE WHEN contract THEN '' ELSE CAST(document % 90 + 1 AS VARCHAR) END AS "Seq Ata", CASE WHEN code % 5 = 0 THEN CAST(run_id AS VARCHAR) ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "Ano",
  CAST(number AS VARCHAR) AS "Item", unit AS "Unidade", CAST(quantity AS VARCHAR) AS "Quantidade", {_BR('unit_price')} AS "Valor Homologado", CASE WHEN code % 3 = 0 THEN '' ELSE {_BR('unit_price * 2')} END AS "Valor Estimado",
  s_name AS "Fornecedor", strftime(shipped, '%d/%m/%Y') AS "Data Resultado", CASE WHEN contract THEN 'Contrato' ELSE 'Ata' END AS "Origem", strftime(CASE WHEN contract THEN o_orderdate + INTERVAL 12 MONTH ELSE shipped END, '%d/%m/%Y') AS "Fim de Vigencia" FROM r"""


@add("report_rows", _REPORT)
def report_rows(spark, sf_dir):
    """Lines meet their order where they are made unique, buyers join the orders, and texts come last, where the ranks are made:
    lines are shuffled by document, by supplier unless suppliers are few enough for a broadcast, and by code, with numbers and
    names alone. Ranks count lines without an order or supplier too, and each line once: what a line meets stays a list until then."""
    from tenderspark.operators.prices import rank_cheapest

    t = lambda n: table(spark, sf_dir, n)
    even, doc = F.col("code") % 2 == 0, F.col("document")
    o = t("orders").select(F.col("o_orderkey").alias("document"), F.col("o_orderdate").alias("signed"), F.col("o_custkey").alias("c_custkey"))
    buyers = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("c_name").alias("buyer"), F.col("n_name").alias("state"))
    s = t("supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name"))
    o = o.join(buyers, "c_custkey").groupBy("document").agg(F.collect_list(F.struct("signed", "c_custkey", "buyer", "state")).alias("_orders"))
    s = s.groupBy("supplier").agg(F.collect_list(F.struct("supplier_name")).alias("_suppliers"))
    lines = items(spark, sf_dir, by_document=True).drop("item_key", "status").join(o, "document", "left").join(s, "supplier", "left").drop("supplier")
    keyed = lines.join(parts(spark, sf_dir), "code").withColumns({"run_id": F.year("shipped").cast("long"), "item_key": F.concat_ws("::", doc.cast("string"), F.col("number").cast("string"))})
    r = rank_cheapest(keyed, ["code", "run_id"], "unit_price", "item_key").select("*", F.inline("_orders")).select("*", F.inline("_suppliers"))
    contract, cents = doc % 2 == 0, lambda c: F.floor(c * 100 + 0.5) / 100
    buyer_id = F.lpad(F.col("c_custkey").cast("string"), 14, "0")
    control = F.concat(buyer_id, F.when(contract, "-2-").otherwise("-1-"), F.lpad(doc.cast("string"), 8, "0"), F.lit("/"), F.year("signed"), F.when(contract, "").otherwise(F.concat(F.lit("-"), doc % 90 + 1)))
    rows = r.select("run_id", "position", "code", F.col("description").alias("catalog_text"), F.when(F.col("flag") == "R", F.upper("description")).alias("final_text"), "buyer", buyer_id.alias("buyer_id"), "state", control.alias("control"),
                    F.when(F.col("code") % 5 == 0, F.col("run_id")).alias("year"), "number", "unit", "quantity", cents(F.col("unit_price")).alias("price"), F.when(F.col("code") % 3 != 0, cents(F.col("unit_price") * 2)).alias("estimated"),
                    "supplier_name", F.col("shipped").alias("result_date"), F.when(contract, "Contract").otherwise("act").alias("document_kind"), "signed", F.col("shipped").alias("valid_until"))
    catalog = t("part").select(F.col("p_partkey").alias("code"), F.col("p_type").alias("class_name"), F.col("p_brand").alias("name"), F.col("p_name").alias("text"))
    catalog = catalog.select("code", F.when(even, "material").otherwise("service").alias("kind"), "class_name", "name", F.when(even, F.replace("text", F.lit(" "), F.lit(", "))).alias("description"))
    return R.report_rows(rows, catalog.hint("shuffle_hash"))  # else all rows would be sorted anew


_CALLS = "SELECT user_id % 10 AS run, event_type AS step, ts, value AS cost FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25'"


@add("cost_rollup", f"WITH calls AS ({_CALLS}) SELECT level, name, {sql4('sum(cost)')} AS cost, count(*) AS n FROM (SELECT cost, unnest([{{'level': 'run', 'name': CAST(run AS VARCHAR)}}, {{'level': 'step', 'name': step}}, {{'level': 'month', 'name': strftime(ts, '%Y-%m')}}, {{'level': 'total', 'name': 'total'}}], recursive := true) FROM calls) GROUP BY level, name")
def cost_rollup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("run"), F.col("event_type").alias("step"), "ts", F.col("value").alias("cost"))
    return R.cost_rollup(e, "run", "step", "ts", "cost", "2024-01-05", "2024-01-25").withColumn("cost", r4("cost"))


@add("run_cost_accumulate", f"WITH s AS (SELECT user_id, event_id, value, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events) SELECT user_id, {sql4('sum(value)')} AS total, min(event_id) FILTER (running > 900) AS first_above FROM s GROUP BY user_id")
def run_cost_accumulate(spark, sf_dir):
    return R.first_above_ceiling(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value", 900.0).withColumn("total", r4("total"))


@add("estimate_cost", f"SELECT count(DISTINCT p_name || '|' || p_brand) AS n_texts, {sql4('count(DISTINCT p_name || ' + chr(39) + '|' + chr(39) + ' || p_brand) * 0.0021')} AS paid, 0.0::DOUBLE AS local, CAST(NULL AS DOUBLE) AS unknown FROM part")
def estimate_cost(spark, sf_dir):
    n = table(spark, sf_dir, "part").agg(F.countDistinct("p_name", "p_brand").alias("n_texts"))
    return n.select("n_texts", r4(R.estimate_cost(F.col("n_texts"), 0.0021)).alias("paid"), R.estimate_cost(F.col("n_texts"), None, True).alias("local"), R.estimate_cost(F.col("n_texts"), None).alias("unknown"))


@add("latest_labels", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 200")
def latest_labels(spark, sf_dir):
    return table(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(200).select("event_id", "user_id")


@add("latest_completed", "SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type || '-' || event_id END AS fingerprint FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type <> 'click' THEN ts END DESC NULLS LAST, event_id DESC) = 1")
def latest_completed(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") != "error", F.concat_ws("-", "event_type", "event_id")).alias("fingerprint"), F.when(F.col("event_type") != "click", F.col("ts")).alias("finished"))
    return R.latest_completed(e, "user_id", "fingerprint", "finished", "event_id")


@add("max_watermark", "SELECT event_type, user_id % 10 AS term, max(ts) AS watermark FROM events GROUP BY ALL")
def max_watermark(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 10).alias("term")).agg(F.max("ts").alias("watermark"))


@add("first_ranked_price", f"WITH {ITEMS} SELECT code, arg_min(item_key, (unit_price, item_key)) AS item_key, min(unit_price) AS unit_price FROM items GROUP BY code")
def first_ranked_price(spark, sf_dir):
    return one_per_key(items(spark, sf_dir), ["code"], ["unit_price", "item_key"]).select("code", "item_key", "unit_price")
