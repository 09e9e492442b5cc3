"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong kinds (``BASE``) are always reported. Weak kinds - a user name, a mail address, a host, a bare random string -
are parts of a credential and mean little alone: they are reported only if an interval join finds complementary parts
within ``SCOPE`` code points of the same text. Identifiers go with secrets; at least one part must be strong, or
identifier, secret and endpoint must all be there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.llm.common import written

SCOPE = 200
# The base patterns of the contract, then the weak parts. Whatever a weak pattern repeats before its decisive
# character is bounded (a mail's local part by 64 characters, its domain by 10 labels of 63), so a long run without that
# character costs no more than its length.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = {"assign": (ASSIGN, 2, 8), "access": (r"AKIA[A-Z0-9]{12,}", 0, 16), "hex": (r"[0-9a-f]{32,}", 0, 32)}
WEAK = {
    "user": r"(?i:user|username|login|client_id|account)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,}",
    "mail": r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,10}",
    "endpoint": r"https?://[^\x00-\x20\"'<>]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "random": r"[A-Za-z0-9+/]{20,}",
}
KINDS = [*BASE, *WEAK]
# Characters that every match of a kind holds; a text without them is not searched for that kind.
NEEDS = {"assign": "[:=]", "access": "AKIA", "user": "[:=]", "mail": "@", "endpoint": "[0-9][.][0-9]|://", "random": "[0-9][A-Za-z+/]|[A-Za-z+/][0-9]"}
_ROLE = {"assign": "secret", "hex": "secret", "random": "secret", "access": "id", "user": "id", "mail": "id", "endpoint": "endpoint"}
SPANS = "array<struct<kind:int,start:int,end:int>>"


def matches(text: Column, kind: str) -> Column:
    """struct(kind, m, g): the leftmost, non-overlapping matches of ``kind`` in ``text`` and the lengths of what lies before
    each and after the last; null arrays where there is none.

    A text without what ``NEEDS`` names, or without a match, is passed over once; in others one pass gives the matches and
    one the gaps."""
    regex = BASE[kind][0] if kind in BASE else WEAK[kind]
    held = text.rlike(NEEDS[kind]) & text.rlike(regex) if kind in NEEDS else text.rlike(regex)
    gaps = F.transform(F.split(text, regex, -1), lambda p: F.length(p))
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.when(held, F.regexp_extract_all(text, F.lit(regex), F.lit(0))).alias("m"), F.when(held, gaps).alias("g"))


def good_match(kind: Column, m: Column) -> Column:
    """Whether the value that decides, taken from the match alone, is long or mixed enough for its kind."""
    out = F.lit(True)
    for k, (regex, group, least) in BASE.items():
        value = F.regexp_extract(m, regex, group) if group else m
        out = F.when(kind == KINDS.index(k), F.length(value) >= least).otherwise(out)
    return F.when(kind == KINDS.index("random"), m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")).otherwise(out)


def in_order(spans: Column) -> Column:
    """Structs of start, kind, end by start, then kind as listed; as structs of kind, start, end."""
    return F.transform(F.array_sort(spans), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def span_text(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by id and text; rows equal in both share their spans."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def found_matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, found) of every row, written: ``found`` has one entry for each kind that the text holds. One narrow pass
    over the texts; what is left of them are the matches."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"), text.alias("text"))
    found = F.filter(F.array(*[matches(F.col("text"), k) for k in KINDS]), lambda x: x["m"].isNotNull())
    return written(given.select("doc_id", "key", found.alias("found")), "secret-matches")


def match_spans(rows: DataFrame) -> DataFrame:
    """(key, kind, start, end) of every match that passes, once for each text: positions are running sums over the matches
    of a text and kind, in code points. Rows equal in id and text give their matches once."""
    one = rows.select("key", F.explode("found").alias("x")).groupBy("key", "x.kind").agg(F.any_value("x.m").alias("m"), F.any_value("x.g").alias("g"))
    each = one.select("key", "kind", "g", F.posexplode("m").alias("at", "m")).withColumn("g", F.get("g", F.col("at")))
    before = Window.partitionBy("key", "kind").orderBy("at")
    placed = each.withColumn("end", F.sum(F.col("g") + F.length("m")).over(before.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return placed.where(good_match(F.col("kind"), F.col("m"))).select("key", "kind", (F.col("end") - F.length("m")).alias("start"), "end")


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(key, kind, start, end) of the weak spans of ``parts`` that others of the same text complete.

    An equi-join on text and scope bin with a distance condition: each weak span meets the parts of which at most
    ``scope`` code points part it, whatever the lengths. A part lies in the bins of its start and of its end, a weak span
    looks into those around both its ends. A bin holds at most ``scope`` starts and ends of each kind, so no text makes
    more pairs than that for each span.
    """
    first, last = (F.floor(F.col(c) / scope).cast("int") for c in ("start", "end"))
    near = parts.select("key", F.explode(F.array_distinct(F.array(first, last))).alias("bin"), F.col("kind").alias("kind2"), F.col("start").alias("start2"), F.col("end").alias("end2"))
    weak = parts.where(F.col("kind") >= len(BASE)).withColumn("bin", F.explode(F.array_distinct(F.array(first - 1, first, last, last + 1))))
    other = (F.col("start") - F.col("end2")).between(0, scope) | (F.col("start2") - F.col("end")).between(0, scope)
    has = lambda role, strong: F.max(F.col("kind2").isin([i for i, k in enumerate(KINDS) if _ROLE[k] == role and (i < len(BASE)) == strong])).alias(f"{role}_{strong}")
    met = weak.join(near, ["key", "bin"]).where(other).groupBy("key", "kind", "start", "end").agg(has("id", True), has("id", False), has("secret", True), has("secret", False), has("endpoint", False))
    role = lambda r: F.col("kind").isin([i for i, k in enumerate(KINDS) if _ROLE[k] == r])
    good = (
        (role("id") & (F.col("secret_true") | F.col("secret_false") & F.col("endpoint_false")))
        | (role("secret") & (F.col("id_true") | F.col("id_false") & F.col("endpoint_false")))
        | (role("endpoint") & (F.col("id_true") & (F.col("secret_true") | F.col("secret_false")) | F.col("id_false") & F.col("secret_true")))
    )
    return met.where(good).select("key", "kind", "start", "end")


def reported(rows: DataFrame, scope: int) -> DataFrame:
    """(key, base, spans) of the texts that have any: arrays by start, then kind as listed."""
    parts = written(match_spans(rows), "secret-parts")
    base = parts.where(F.col("kind") < len(BASE)).withColumn("is_base", F.lit(True))
    both = base.union(linked_parts(parts, scope).withColumn("is_base", F.lit(False)))
    span = F.struct("start", "kind", "end")
    return both.groupBy("key").agg(in_order(F.collect_list(F.when(F.col("is_base"), span))).alias("base"), in_order(F.collect_list(span)).alias("spans"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and spans (arrays of kind, start, end; base is part of spans).

    Null and empty texts have no spans; repeated rows each get theirs; a null id is kept. Only the two named columns
    are read, so others may have any name. Positions are code points, ends exclusive. A text of any length is searched
    whole, in time in proportion to its length.
    """
    rows = found_matches(docs, id_col, text_col)
    none = F.array().cast(SPANS)
    return rows.join(reported(rows, scope), "key", "left").select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span of ``text_col`` replaced by its kind in brackets; overlapping spans become
    one, named by the first. All rows and columns stay; a text without spans, null ones too, is unchanged."""
    marked = reported(found_matches(docs, id_col, text_col), scope).select(F.col("key").alias("_key"), F.col("spans").alias("_spans"))
    joined = docs.select(F.struct("*").alias("_row"), row_key(id_col, text_col).alias("_key"), F.col(text_col).alias("_text")).join(marked, "_key", "left")
    grown = lambda out, s: F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["kind"].alias("kind"), F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end"))))
    merged = F.aggregate("_spans", F.array().cast(SPANS), lambda out, s: F.when((F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["end"] > s["start"]), grown(out, s)).otherwise(F.array_append(out, s)))
    pieces = F.transform(F.col("_merged"), lambda s, i: F.concat(F.substring(F.col("_text"), F.when(i == 0, 0).otherwise(F.try_element_at("_merged", i)["end"]) + 1, s["start"] - F.when(i == 0, 0).otherwise(F.try_element_at("_merged", i)["end"])), F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), F.lit("]")))
    tail = F.substring(F.col("_text"), F.element_at("_merged", -1)["end"] + 1, F.length("_text"))
    new = F.when(F.size("_spans") > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(F.col("_text"))
    with_merged = joined.withColumn("_merged", F.when(F.size("_spans") > 0, merged))
    return with_merged.select(*[new.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
