"""Catalogue curation and search terms: allow-lists, prefilters, derivation, variants, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.functions.fixed import GENERIC_TERMS, VARIANT_GROUPS
from tenderspark.sources.files import written


def type_key(kind: Column, pdm: Column, code: Column) -> Column:
    """A material matches by its PDM, a service by its code."""
    return F.when(kind == "material", pdm).otherwise(code)


def filter_allow_list(catalog: DataFrame, allow: DataFrame) -> DataFrame:
    """Entries whose numeric key is in the active allow-list of their type; keys that are no number match nothing."""
    key = type_key(F.col("kind"), F.col("pdm"), F.col("code")).try_cast("bigint")
    ok = allow.where("active").select(F.col("kind").alias("_k"), F.col("code").try_cast("bigint").alias("_c")).distinct()
    return catalog.join(ok, (F.col("kind") == F.col("_k")) & (key == F.col("_c")), "left_semi")


def filter_groups(catalog: DataFrame, groups: list[str] | None) -> DataFrame:
    return catalog if groups is None else catalog.where(F.col("group_name").isin(groups))


def keyword_prefilter(df: DataFrame, query: str, cols: list[str], key: str, limit: int | None = None) -> DataFrame:
    """Rows with a token of ``query`` in their folded text, those with most tokens first; ``hits`` counts them."""
    tokens = T.tokenize_catalog(F.lit(query))
    body = T.norm_text(F.concat_ws(" ", *cols))
    hits = F.size(F.filter(tokens, lambda t: body.contains(t)))
    out = df.withColumn("hits", hits).where("hits > 0").orderBy(F.desc("hits"), key)
    return out if limit is None else out.limit(limit)


def placed(df: DataFrame, code: str) -> DataFrame:
    """``df`` with ``place`` 1..n by (length of the code, code), all rows; equal codes in an order of their own. Rows are dealt into
    ranges of that order of about equal size, whatever the codes are, and numbered inside; a range starts after the counts of
    those before it, so no task sorts the whole table."""
    ranged = df.withColumn("_n", F.length(code)).repartitionByRange("_n", code, F.xxhash64(*df.columns))
    rows = written(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # of the ranges, a row each
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    inside = rows.withColumn("_in", F.row_number().over(Window.partitionBy("_range").orderBy("_n", code)))
    return inside.join(F.broadcast(starts), "_range").withColumn("place", (F.col("_start") + F.col("_in")).cast("int")).drop("_n", "_range", "_start", "_in")


def derive_catalog(catalog: DataFrame, allow: DataFrame, current: DataFrame) -> DataFrame:
    """(kind, code, category, active): allowed entries are active and keep the category they have; those of
    ``current`` that are no longer allowed are deactivated, never deleted."""
    fresh = filter_allow_list(catalog, allow).select("kind", "code", F.lit(True).alias("_in"))
    joined = fresh.join(current.select("kind", "code", "category"), ["kind", "code"], "full")
    return joined.select("kind", "code", "category", F.coalesce("_in", F.lit(False)).alias("active"))


def prune_inactive(report: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Report rows whose code has not been deactivated."""
    return report.join(catalog.where("not active").select(*keys), keys, "left_anti")


def code_types(catalog: DataFrame) -> DataFrame:
    """(code, kinds, ambiguous): the types that a code occurs in."""
    out = catalog.groupBy("code").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    return out.withColumn("ambiguous", F.size("kinds") > 1)


def list_allow_with_counts(allow: DataFrame, catalog: DataFrame, kind: str | None = None, inactive: bool = True) -> DataFrame:
    """The allow-list with how many catalogue rows each entry matches, 0 where none."""
    key = type_key(F.col("kind"), F.col("pdm"), F.col("code"))
    n = catalog.groupBy("kind", key.alias("code")).agg(F.count(F.lit(1)).alias("n_catalog"))
    rows = allow if kind is None else allow.where(F.col("kind") == kind)
    rows = rows if inactive else rows.where("active")
    return rows.join(n, ["kind", "code"], "left").withColumn("n_catalog", F.coalesce("n_catalog", F.lit(0)))


def generic_terms(spark: SparkSession) -> DataFrame:
    """(term): the stop list."""
    return spark.createDataFrame([(t,) for t in GENERIC_TERMS], "term string")


def variant_groups(spark: SparkSession) -> DataFrame:
    """(group, form): the equivalent forms."""
    return spark.createDataFrame([(f"g{i}", form) for i, forms in enumerate(VARIANT_GROUPS) for form in forms], "group string, form string")


def drop_generic_terms(terms: DataFrame, generic: DataFrame, term: str) -> DataFrame:
    """Terms whose folded form is not in the stop list."""
    stop = generic.select(T.norm_text(F.col("term")).alias("_g")).distinct()
    return terms.join(stop, T.norm_text(F.col(term)) == F.col("_g"), "left_anti")


def expand_variants(terms: DataFrame, groups: DataFrame, key: str, term: str) -> DataFrame:
    """(key, term): with any form of an equivalence group (group, form) come all its forms; others stay themselves."""
    base = terms.select(key, T.norm_term(F.col(term)).alias("term"))
    named = groups.select("group", T.norm_term(F.col("form")).alias("form"))
    found = base.join(named.select("group", T.norm_text(F.col("form")).alias("_n")).distinct(), T.norm_text(F.col("term")) == F.col("_n")).select(key, "group").distinct()
    return base.union(found.join(named, "group").select(key, "form")).distinct()


def expand_terms(terms: DataFrame, groups: DataFrame, generic: DataFrame, key: str, term: str) -> DataFrame:
    """Lower case, generic terms out, variants in, a copy without accents beside each, generic terms out again."""
    wide = expand_variants(drop_generic_terms(terms, generic, term), groups, key, term)
    both = wide.select(key, F.explode(F.array("term", T.norm_text(F.col("term")))).alias("term")).where("term != ''").distinct()
    return drop_generic_terms(both, generic, "term")


def path_key(c: Column) -> Column:
    """Slashes unified, none at the end, lower case."""
    return F.lower(F.regexp_replace(F.translate(c, "\\", "/"), "/+$", ""))


def merge_origins(df: DataFrame, key: str, origins: str, order: list[str]) -> DataFrame:
    """One row per key: the first row's columns, with the union of all rows' pipe-separated origins, sorted."""
    cols = [c for c in df.columns if c not in (key, origins)]
    first = df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    tags = df.select(key, F.explode(T.split_pipe(F.col(origins))).alias("_o")).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("_o")), "|").alias(origins))
    return first.join(tags, key, "left").select(key, "_r.*", origins)
