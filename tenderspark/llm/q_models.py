"""Queries that train a model on labelled rows and apply it to whole texts; tested by held-out accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenderspark.llm import language, toxicity
from tenderspark.llm.common import table


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identified(docs, language.learned(docs))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op2_language_id": op2_language_id, "op7_toxicity": op7_toxicity}
SQL: dict[str, str] = {}
