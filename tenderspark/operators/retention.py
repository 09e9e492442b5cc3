"""Retention: what may be deleted, and deleting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderspark.streaming.tables import BucketTable

PAGE_DAYS, LOG_DAYS = 180, 90


def expired_documents(documents: DataFrame, document: str, now: Column, days: int = PAGE_DAYS) -> DataFrame:
    """Documents extracted more than ``days`` ago whose pages can be fetched again, as they have an address."""
    old = F.col("extracted_at") < F.date_sub(now, days)
    return documents.where(old & (F.length(F.trim(F.coalesce("url", F.lit("")))) > 0)).select(document).distinct()


def retention(pages: BucketTable, documents: DataFrame, document: str, logs: BucketTable, created: str, now: Column, apply: bool = False, page_days: int = PAGE_DAYS, log_days: int = LOG_DAYS) -> DataFrame:
    """(target, n_rows, n_chars, applied): pages of expired documents and log rows older than ``log_days``. It only counts, unless
    ``apply``: then both tables lose those rows. ``pages`` is keyed by ``document``; of both tables only the buckets that hold such
    rows are rewritten, so a second pass finds and changes nothing. A null time never expires."""
    gone = expired_documents(documents, document, now, page_days)
    old = F.col(created) < F.date_sub(now, log_days)
    n = F.count(F.lit(1)).alias("n_rows")
    dead = pages.read().join(gone, document, "left_semi").agg(n, F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars"))
    late = logs.read().where(old).agg(n, F.lit(0).cast("long").alias("n_chars"))
    counts = [(name, *df.first()) for name, df in (("page", dead), ("log", late))]
    if apply:
        pages.delete_keys(gone)
        logs.delete(old)
    rows = [(name, k, chars, apply and k > 0) for name, k, chars in counts]
    return pages.spark.createDataFrame(rows, "target string, n_rows long, n_chars long, applied boolean")
