"""Document text: assembly from pages, chunks, anchored windows, extraction checks and verdicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators.classify import Scorer, batch_score
from tenderspark.sources.files import written


def document_text(pages: DataFrame, document: str, order: list[str], text: str) -> DataFrame:
    """(document, text, n_pages): pages joined by newlines in order; a document's pages are bounded by its length."""
    rows = F.array_sort(F.collect_list(F.struct(*order, text)))
    return pages.groupBy(document).agg(F.array_join(F.transform(rows, lambda p: F.coalesce(p[text], F.lit(""))), "\n").alias("text"), F.count(F.lit(1)).alias("n_pages"))


def chunk_text(df: DataFrame, key: str, text: str, size: int = 48_000, overlap: int = 2_000) -> DataFrame:
    """(key, chunk, chunk_text): pieces of ``size`` characters that overlap; an empty text has none."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    return df.where(F.length(text) > 0).select(key, text, F.explode(F.sequence(F.lit(0), last)).alias("chunk")).select(key, "chunk", F.substring(F.col(text), F.col("chunk") * step + 1, F.lit(size)).alias("chunk_text"))


def route_strategy(n_items: Column, text_len: Column, window_max: int, table_size: int) -> Column:
    """'whole' if the windows of the items would read more than the document, else 'window'."""
    room = window_max - table_size
    return F.when((F.lit(room) > 0) & (n_items > 0) & (n_items > F.try_divide(text_len, F.lit(room))), "whole").otherwise("window")


def doc_verdict(statuses: DataFrame, document: str, status: str) -> DataFrame:
    """(document, verdict): illegible without items or with none readable, suspect if none is confirmed, else ok."""
    s = F.col(status)
    n = statuses.groupBy(document).agg(F.count_if(s.startswith("confirmed")).alias("_ok"), F.count_if(s != "no_text").alias("_read"))
    return n.select(document, F.when(F.col("_read") == 0, "illegible").when(F.col("_ok") == 0, "suspect").otherwise("ok").alias("verdict"))


def escalated(verdict: Column, n_items: Column, least: int) -> Column:
    """Whether a document goes to the exception route."""
    return verdict.isin("suspect", "illegible") & (n_items >= least)


def better_verdict(old: Column, new: Column) -> Column:
    """The second route's verdict counts if it is ok or the first was illegible."""
    return F.when((new == "ok") | (old == "illegible"), new).otherwise(old)


def validate_extraction(found: Column, qty: Column, price: Column, ref_qty: Column, ref_price: Column) -> Column:
    """struct(status, divergence) of an extracted row against its item; see the ladder in the tests."""
    near_qty = F.coalesce(F.abs(qty - ref_qty) <= F.greatest(F.lit(1.0), 0.01 * ref_qty), F.lit(False))
    diff = F.try_divide(price - ref_price, ref_price)
    near_price = F.coalesce((F.abs(diff) <= 0.01) & (ref_price >= 1000), F.lit(False))
    ratio = F.try_divide(price, ref_price)
    status = (
        F.when(~F.coalesce(found, F.lit(False)), "not_found")
        .when(~(near_qty | near_price), "quantity_differs")
        .when(price.isNull(), "confirmed_no_price")
        .when(F.coalesce(ref_price, F.lit(0.0)) <= 0, "confirmed_no_reference")
        .when(F.abs(diff) <= 0.01, "confirmed")
        .when((ratio < 0.3) | (ratio > 3), "confirmed_price_suspect")
        .otherwise("confirmed_differs")
    )
    gap = F.when(status == "confirmed", F.lit(0.0)).when(status.isin("confirmed_price_suspect", "confirmed_differs"), F.round(diff, 4))
    return F.struct(status.alias("status"), gap.alias("divergence"))


def destination(status: Column, verdict: Column) -> Column:
    return F.when(status.startswith("confirmed"), "keep").when(verdict.isin("suspect", "illegible"), "review").otherwise("discard")


def dedup_chunk_rows(rows: DataFrame, document: str, chunk: str, seq: str, number: str, description: str) -> DataFrame:
    """Rows extracted from chunks without blank descriptions, one per (number, first 80 characters), the first wins."""
    kept = rows.where(F.length(F.trim(F.coalesce(description, F.lit("")))) > 0).withColumn("_head", F.substring(description, 1, 80))
    cols = [c for c in rows.columns if c != document]
    return kept.groupBy(document, F.coalesce(F.col(number).cast("string"), F.lit("")).alias("_n"), "_head").agg(F.min_by(F.struct(*cols), F.struct(chunk, seq)).alias("_r")).select(document, "_r.*")


def merged_intervals(spans: Column) -> Column:
    """Overlapping or touching (a, b) spans of an array joined to one, in order."""
    kind = "array<struct<a:int,b:int>>"
    last = lambda out: F.element_at(out, -1)
    grow = lambda out, s: F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last(out)["a"].alias("a"), F.greatest(last(out)["b"], s["b"]).alias("b"))))
    return F.aggregate(F.array_sort(spans.cast(kind)), F.array().cast(kind), lambda out, s: F.when((F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["b"] >= s["a"]), grow(out, s)).otherwise(F.array_append(out, s)))


MARK = "\n[...]\n"


def _same_length_fold(c: Column) -> Column:
    """Folding character by character, so that positions found in it hold in the original text."""
    one, to, _ = T._folding()
    return F.translate(F.lower(c), one, to)


def anchor_windows(text: Column, description: Column, number: Column, price: Column, cap: int = 9000, radius: int = 3000, price_radius: int = 1500, no_anchor: int | None = None) -> Column:
    """The parts of a document around an item: where the first 40 characters of its description stand (where they don't,
    'item <n>'), and up to two hits of each price spelling, the second after the end of the first. Parts that overlap or
    touch are one; together they hold at most ``cap`` characters, the later ones are cut; a mark stands between them.
    Without an anchor it is the first ``no_anchor`` characters (four times ``radius`` if not given)."""
    none = F.array().cast("array<struct<a:int,b:int>>")
    kept = F.struct(text.alias("text"), F.length(text).alias("size"), description.alias("description"), T.price_variants(price).alias("variants"))
    return _once(kept, lambda d: _once(_spans(d, number, radius, price_radius, none), lambda s: _excerpts(d, merged_intervals(s), cap, 4 * radius if no_anchor is None else no_anchor)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used: Spark repeats an expression wherever it stands in a
    branch or a lambda."""
    return F.transform(F.array(value), use)[0]


def _spans(d: Column, number: Column, radius: int, price_radius: int, none: Column) -> Column:
    """The intervals around the anchors of a document, not joined yet."""
    text, size = d["text"], d["size"]
    span = lambda at, r: F.when(at > 0, F.array(F.struct(F.greatest(at - 1 - r, F.lit(0)).cast("int").alias("a"), F.least(at - 1 + r, size).cast("int").alias("b")))).otherwise(none)

    def anchor(folded: Column) -> Column:
        found = lambda needle: _once(needle, lambda n: F.coalesce(F.when(F.length(n) > 0, F.instr(folded, n)), F.lit(0)))
        by_number = found(F.concat(F.lit("item "), F.trim(number.cast("string"))))
        return _once(found(F.substring(_same_length_fold(F.trim(d["description"])), 1, 40)), lambda by_text: F.when(by_text > 0, by_text).otherwise(by_number))

    def hits(v: Column) -> Column:
        def second(one: Column) -> Column:
            rest = one + F.length(v)
            more = F.when(one > 0, F.instr(F.substring(text, rest, size), v)).otherwise(0)
            return _once(more, lambda m: F.concat(span(one, price_radius), span(F.when(m > 0, rest - 1 + m).otherwise(0), price_radius)))

        return _once(F.coalesce(F.instr(text, v), F.lit(0)), second)

    by_anchor = _once(_once(_same_length_fold(text), anchor), lambda at: span(at, radius))
    return F.concat(by_anchor, F.flatten(F.transform(d["variants"], hits)))


def _excerpts(d: Column, merged: Column, cap: int, no_anchor: int) -> Column:
    text = d["text"]
    start = F.struct(F.lit(0).alias("used"), F.array().cast("array<string>").alias("parts"))
    take = lambda acc, s: F.least(s["b"] - s["a"], F.lit(cap) - acc["used"])
    grown = lambda acc, s: F.struct((acc["used"] + take(acc, s)).alias("used"), F.array_append(acc["parts"], F.substring(text, s["a"] + 1, take(acc, s))).alias("parts"))
    joined = lambda m: F.array_join(F.aggregate(m, start, lambda acc, s: F.when(acc["used"] < cap, grown(acc, s)).otherwise(acc))["parts"], MARK)
    return _once(merged, lambda m: F.when(F.size(m) == 0, F.substring(text, 1, no_anchor)).otherwise(joined(m)))


def match_items_to_table(items: DataFrame, rows: DataFrame, document: str, key: str, item_text: str, row_index: str, row_text: str, scorer: Scorer | None = None) -> DataFrame:
    """(document, key, row_index, common): for each item the extracted row with most common words, ties to the first;
    items without a common word match nothing. Words meet by an equi-join inside the document.

    With a ``scorer`` those pairs are candidates only: it gets their ``item_text`` and ``row_text``, the row of the highest score
    wins, and ``score`` stands in the place of ``common``; pairs that it fails on or gives no score lose."""
    a = items.select(document, key, F.explode(F.array_distinct(T.tokenize_alnum(F.col(item_text)))).alias("w"))
    b = rows.select(document, row_index, F.explode(F.array_distinct(T.tokenize_alnum(F.col(row_text)))).alias("w"))
    n = a.join(b, [document, "w"]).groupBy(document, key, row_index).agg(F.count(F.lit(1)).alias("common"))
    by = "common"
    if scorer is not None:
        pairs = n.join(items.select(document, key, item_text), [document, key]).join(rows.select(document, row_index, row_text), [document, row_index])
        ids = [document, key, row_index]
        pairs = written(pairs.select(*ids, item_text, row_text).withColumn("_pair", F.to_json(F.struct(*ids))), "item-rows")
        judged = batch_score(pairs, "_pair", [item_text, row_text], scorer, "double").where("result is not null")
        n, by = pairs.join(judged, "_pair").select(*ids, F.col("result").alias("score")), "score"
    return n.groupBy(document, key).agg(F.max_by(F.struct(row_index, by), F.struct(F.col(by), -F.col(row_index))).alias("_b")).select(document, key, "_b.*")
