"""Classification once per distinct text, spread back to items; majority votes; survivors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.sources.files import written
from tenderspark.sources.ship import ship


class Scorer(Protocol):
    """A model as a plug-in: one result per row of the batch, in its order. It is pickled to the workers; what it opens
    there it opens on first use."""

    def __call__(self, batch: pd.DataFrame) -> list: ...


def resolve_prompt(template: str | None, fallback: str, **values: Any) -> str:
    """The template filled with the values; the fallback where there is none or its placeholders do not fit."""
    if template is None:
        return fallback
    try:
        return template.format(**values)
    except (KeyError, IndexError, ValueError):
        return fallback


def distinct_texts(items: DataFrame, text_hash: str, key: str, cols: list[str]) -> DataFrame:
    """(text_hash, cols, n_items): one row per text, that of the smallest key, with how many items have it."""
    agg = items.groupBy(text_hash).agg(F.min_by(F.struct(*cols), F.col(key)).alias("_r"), F.count(F.lit(1)).alias("n_items"))
    return agg.select(text_hash, "_r.*", "n_items")


def pending_texts(items: DataFrame, classified: DataFrame, text_hash: str, key: str, cols: list[str]) -> DataFrame:
    """The distinct texts that are not classified yet."""
    return distinct_texts(items.join(classified.select(text_hash).distinct(), text_hash, "left_anti"), text_hash, key, cols)


def dedup_factor(items: DataFrame, text_hash: str) -> DataFrame:
    """One row: items, distinct texts and their ratio."""
    return items.agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct(text_hash).alias("n_texts")).withColumn("factor", F.try_divide("n_items", "n_texts"))


def batch_score(df: DataFrame, key: str, cols: list[str], fn: Callable[[pd.DataFrame], list], result_type: str = "string") -> DataFrame:
    """(key, result, error): ``fn`` scores Arrow batches of the columns; a batch that fails is scored row by row, so
    that only failing rows carry an error. As many run at once as there are tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            try:
                out, err = list(fn(b[cols])), [None] * len(b)
            except Exception:  # noqa: BLE001  a scorer may raise anything; its rows say what
                out, err = [], []
                for i in range(len(b)):
                    try:
                        out.append(next(iter(fn(b[cols].iloc[i : i + 1]))))
                        err.append(None)
                    except Exception as e:  # noqa: BLE001
                        out.append(None)
                        err.append(f"{type(e).__name__}: {e}"[:500])
            yield pd.DataFrame({key: b[key].to_numpy(), "result": out, "error": err})

    ship(df.sparkSession)
    return df.select(key, *cols).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, result {result_type}, error string")


def keyword_labels(text: Column, rules: dict[str, list[str]]) -> Column:
    """Labels whose keywords occur in the text, in the rules' order: a deterministic scorer without a model."""
    found = [F.when(F.greatest(*[text.contains(w) for w in words], F.lit(False)), F.lit(label)) for label, words in rules.items()]
    return F.array_compact(F.array(*found))


def classify_distinct(items: DataFrame, classified: DataFrame, text_hash: str, key: str, text: str, labels: Callable[[Column], Column]) -> DataFrame:
    """The next version of ``classified`` (text_hash, labels): pending texts are labelled once each and added."""
    fresh = pending_texts(items, classified, text_hash, key, [text])
    return classified.select(text_hash, "labels").unionByName(fresh.select(text_hash, labels(F.col(text)).alias("labels")))


def score_missing(done: DataFrame, rows: DataFrame, keys: list[str], cols: list[str], scorer: Scorer, result: str) -> tuple[DataFrame, DataFrame]:
    """(next version of ``done``, failures): rows whose ``keys`` are not in ``done`` (keys, ``result``) are scored once
    per key and added. Rows that fail are not added, so the next run takes them up again; they come back as (keys, error).

    The scores are written before both results read them, so the scorer is not asked twice. Of several rows with one key that
    with the smallest columns is scored; a null key counts as missing each time."""
    todo = rows.join(done.select(*keys).distinct(), keys, "left_anti").groupBy(*keys).agg(F.min(F.struct(*cols)).alias("_r")).select(F.struct(*keys).alias("_k"), "_r.*")
    scored = written(batch_score(todo, "_k", cols, scorer, done.schema[result].dataType.simpleString()), "scored")
    fresh = scored.where("error is null").select("_k.*", F.col("result").alias(result))
    return done.select(*keys, result).unionByName(fresh), scored.where("error is not null").select("_k.*", "error")


def classify_with(items: DataFrame, classified: DataFrame, text_hash: str, text: str, scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """(next version of ``classified`` (text_hash, labels), failures): a model labels each unseen text once."""
    return score_missing(classified, items, [text_hash], [text], scorer, "labels")


def generate_terms(codes: DataFrame, done: DataFrame, code: str, cols: list[str], scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """(next version of ``done`` (code, terms), failures): a model makes terms for each code that has none yet."""
    return score_missing(done, codes, [code], cols, scorer, "terms")


def embed_missing(cache: DataFrame, items: DataFrame, text_hash: str, text: str, model: str, scorer: Scorer) -> tuple[DataFrame, DataFrame]:
    """(next version of ``cache`` (text_hash, model, vector), failures): each distinct text is embedded once per model; the
    vectors of other models stay."""
    return score_missing(cache, items.withColumn("model", F.lit(model)), [text_hash, "model"], [text], scorer, "vector")


def item_categories(items: DataFrame, classified: DataFrame, text_hash: str, key: str) -> DataFrame:
    """(key, category), distinct: each item takes the labels of its text."""
    return items.select(key, text_hash).join(classified.select(text_hash, F.explode("labels").alias("category")), text_hash).select(key, "category").distinct()


def survivors(items: DataFrame, categories: DataFrame, key: str) -> DataFrame:
    """``items`` with ``survives``: whether the item has a category."""
    return items.join(categories.select(key).distinct().withColumn("_s", F.lit(True)), key, "left").withColumn("survives", F.coalesce("_s", F.lit(False))).drop("_s")


def category_report(categories: DataFrame, key: str) -> DataFrame:
    return categories.groupBy("category").agg(F.countDistinct(key).alias("n_items"))


def survivor_count(marked: DataFrame, document: str) -> DataFrame:
    return marked.groupBy(document).agg(F.count(F.lit(1)).alias("n_items"), F.count_if("survives").alias("n_survivors"))


def majority(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value of each group, ties to the smallest; nulls do not vote."""
    n = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), value)
    return n.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def class_divergence(df: DataFrame, key: str, labels: str) -> DataFrame:
    """Keys with more than one distinct label set, and how many."""
    return df.groupBy(key).agg(F.countDistinct(labels).alias("n_sets")).where("n_sets > 1")


def category_cascade(codes: DataFrame, model: DataFrame, code: str, pdm: str, term_set: str, rule: Column) -> DataFrame:
    """(code, category, source): the model's category, else the majority of the same PDM, else of the same set of
    terms, else the keyword rule, else 'other'."""
    base = codes.select(code, pdm, term_set, rule.alias("_rule")).join(model.select(code, F.col("category").alias("_own")), code, "left")
    known = base.where(F.col("_own").isNotNull())
    by_pdm = majority(known, [pdm], "_own").select(pdm, F.col("_own").alias("_pdm"))
    by_set = majority(known, [term_set], "_own").select(term_set, F.col("_own").alias("_set"))
    out = base.join(by_pdm, pdm, "left").join(by_set, term_set, "left")
    source = F.when(F.col("_own").isNotNull(), "model").when(F.col("_pdm").isNotNull(), "pdm").when(F.col("_set").isNotNull(), "terms").when(F.col("_rule").isNotNull(), "rule").otherwise("other")
    return out.select(code, F.coalesce("_own", "_pdm", "_set", "_rule", F.lit("other")).alias("category"), source.alias("source"))


def aggregate_terms(codes: DataFrame, code: str, terms: str, category: str) -> DataFrame:
    """(term, codes, category): the sorted codes of each term and their majority category; 'other' codes are left out."""
    rows = codes.where(F.col(category) != "other").select(code, category, F.explode(terms).alias("term"))
    return rows.groupBy("term").agg(F.array_sort(F.collect_set(code)).alias("codes")).join(majority(rows, ["term"], category).select("term", category), "term")
