"""Counts taken while a table is made: what failed to parse, what was dropped and why."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tenderspark.sources.files import scratch

_COUNTS = "step string, metric string, n long"


def failed(raw: Column, parsed: Column) -> Column:
    """A value was there and nothing came of it."""
    return (F.trim(raw.cast("string")) != "") & parsed.isNull()


def parsed(df: DataFrame, step: str, columns: dict[str, tuple[Column, Callable[[Column], Column]]], keep: list[str | Column], fails: dict[str, Callable[[Column, Column], Column]] | None = None) -> tuple[DataFrame, Observation]:
    """(``keep`` and the parsed columns, an observation): each column is made from its raw text by its function. The job that
    first reads the table also counts its ``rows`` and, by column, the values for which ``fails(raw, parsed)`` holds (default:
    not blank and parsed to null)."""
    fails = fails or {}
    raw = df.select(*keep, *[r.alias(f"_raw_{c}") for c, (r, _) in columns.items()])
    out = raw.withColumns({c: fn(F.col(f"_raw_{c}")) for c, (_, fn) in columns.items()})
    counts = [F.count_if(fails.get(c, failed)(F.col(f"_raw_{c}"), F.col(c))).alias(c) for c in columns]
    seen = Observation(step)
    return out.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).drop(*[f"_raw_{c}" for c in columns]), seen


def loaded(df: DataFrame, step: str, reasons: dict[str, Column], path: str | None = None) -> tuple[DataFrame, Observation]:
    """(the table of the rows that no reason drops, written under ``path``; an observation): the one job that writes also counts
    the rows ``read``, those dropped by each reason (the first that holds) and those ``written``."""
    first = F.lit(None).cast("string")
    for name, cond in reversed(reasons.items()):
        first = F.when(cond, name).otherwise(first)
    marked = df.withColumn("_reason", first)
    seen = Observation(step)
    counts = [F.count(F.lit(1)).alias("read"), *[F.count_if(F.col("_reason") == r).alias(r) for r in reasons], F.count_if(F.col("_reason").isNull()).alias("written")]
    spark, path = df.sparkSession, path or scratch(df.sparkSession, step)
    marked.observe(seen, *counts).where("_reason is null").drop("_reason").write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen


def counts_table(spark, seen: dict[str, Observation]) -> DataFrame:
    """(step, metric, n) of observations whose jobs have run: one row for each of their few metrics."""
    return spark.createDataFrame([(step, k, int(v)) for step, o in seen.items() for k, v in o.get.items()], _COUNTS)
