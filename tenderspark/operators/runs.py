"""Comparison of runs and exports, report rows, lineage, costs and errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.functions.fixed import REPORT_COLUMNS

from tenderspark.operators.tables import Snapshot, one_per_key


def run_diff(a: DataFrame, b: DataFrame, keys: list[str], price: str, order: list, threshold: float = 0.0) -> DataFrame:
    """(keys, status, price_a, price_b, change): new, gone, or changed by more than ``threshold`` of the old price.

    A key that occurs twice in a run counts with its last row in ``order`` (ascending columns)."""
    last = [F.desc(c) for c in order]
    x = one_per_key(a, keys, last).select(*keys, F.col(price).alias("price_a"), F.lit(True).alias("_a"))
    y = one_per_key(b, keys, last).select(*keys, F.col(price).alias("price_b"), F.lit(True).alias("_b"))
    change = F.try_divide(F.col("price_b") - F.col("price_a"), F.col("price_a"))
    status = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "gone").when(F.abs(change) > threshold, "changed")
    return x.join(y, keys, "full").select(*keys, status.alias("status"), "price_a", "price_b", change.alias("change")).where("status is not null")


def new_since_export(report: DataFrame, snapshot: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the last export; without one everything is new."""
    return report if snapshot is None else report.join(snapshot.select(*keys).distinct(), keys, "left_anti")


def export_new(report: DataFrame, exported: Snapshot, keys: list[str]) -> DataFrame:
    """``new_since_export`` of ``report``, whose keys, all of them and not the new ones alone, become the snapshot: it is the
    picture of what has been delivered."""
    before = exported.read()
    exported.advance(report.select(*keys).distinct())
    return new_since_export(report, before, keys)


def cost_rollup(calls: DataFrame, run: str, step: str, ts: str, cost: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """(level, name, cost, n): cost by run, by step, by month and in total, in one pass over the calls."""
    rows = calls
    if since is not None:
        rows = rows.where(F.col(ts) >= F.lit(since).cast("timestamp"))
    if until is not None:
        rows = rows.where(F.col(ts) < F.lit(until).cast("timestamp"))
    month = F.date_format(ts, "yyyy-MM")
    levels = F.array(*[F.struct(F.lit(n).alias("level"), v.cast("string").alias("name")) for n, v in (("run", F.col(run)), ("step", F.col(step)), ("month", month), ("total", F.lit("total")))])
    return rows.select(F.explode(levels).alias("_l"), F.col(cost).alias("_c")).groupBy("_l.level", "_l.name").agg(F.sum("_c").alias("cost"), F.count(F.lit(1)).alias("n"))


def first_above_ceiling(calls: DataFrame, run: str, order: list[str], cost: str, ceiling: float) -> DataFrame:
    """(run, total, first_order): total cost of each run and the first call, by ``order``, whose running sum is above
    the ceiling (null if none)."""
    from pyspark.sql import Window

    w = Window.partitionBy(run).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = calls.withColumn("_sum", F.sum(cost).over(w))
    key = F.struct(*order)
    return sums.groupBy(run).agg(F.sum(cost).alias("total"), F.min(F.when(F.col("_sum") > ceiling, key)).alias("_f")).select(run, "total", F.col(f"_f.{order[-1]}").alias("first_above"))


def estimate_cost(units: Column, price: float | None, local: bool = False) -> Column:
    """Units times price; 0 for a local provider, null for an unknown price."""
    return F.lit(0.0) if local else units * F.lit(price).cast("double")


def latest_completed(steps: DataFrame, by: str, value: str, finished: str, tie: str) -> DataFrame:
    """The last non-null value of each step; unfinished rows come last."""
    return one_per_key(steps.where(F.col(value).isNotNull()), [by], [F.col(finished).desc_nulls_last(), F.desc(tie)]).select(by, value)


def error_state(errors: DataFrame, keys: list[str], ts: str, message: str) -> DataFrame:
    """One open error per key: attempts, first and last time, and the last message."""
    return errors.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempts"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), F.max_by(message, F.struct(ts, message)).alias("message"))


def report_rows(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """The columns of ``REPORT_COLUMNS`` in their order, after ``run_id`` and ``position``; what is missing is the empty string.

    ``rows``: run_id, position, code, catalog_text, final_text, buyer, buyer_id, state, control, year, number, unit, quantity,
    price, estimated, supplier_name, result_date, document_kind, signed, valid_until. ``catalog``: code, kind, class_name,
    name, description, one row per code; a code that it lacks keeps its row."""
    r = rows.join(catalog.select("code", F.col("kind").alias("_kind"), F.col("class_name").alias("_class"), F.col("name").alias("_name"), F.col("description").alias("_base")), "code", "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    p = T.parse_control_number(F.col("control"))
    part = lambda name: F.coalesce(p[name].cast("string"), F.lit(""))
    base = F.coalesce(T.blank_to_null(F.col("_base")), text("catalog_text"))
    day = lambda c: F.coalesce(F.date_format(c, "dd/MM/yyyy"), F.lit(""))
    cells = [
        text("code"), F.when(F.lower("_kind").startswith("serv"), "Serviço").otherwise("Material"), text("_class"), T.head_noun(base, F.col("_name")), base, text("final_text"),
        text("buyer"), text("buyer_id"), text("state"), text("control"), part("seq"), part("act_seq"), F.coalesce(T.blank_to_null(F.col("year").cast("string")), part("year")),
        text("number"), text("unit"), T.quantity_text(F.col("quantity")), T.format_money_br(F.col("price")), T.format_money_br(F.col("estimated")),
        text("supplier_name"), day("result_date"), F.when(F.lower("document_kind") == "contract", "Contrato").otherwise("Ata"), day(T.validity_end(F.col("document_kind"), F.to_date("valid_until"), F.to_date("signed"))),
    ]
    return r.select("run_id", "position", *[c.alias(name) for c, name in zip(cells, REPORT_COLUMNS, strict=True)])
