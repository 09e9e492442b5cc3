"""Incremental ingest: watermarks, known documents, pending queue, progress and error state, in batch and as streams.

Each operator has a batch form that defines the result. The streams keep the same tables in buckets (``BucketTable``): a
micro-batch rewrites only the buckets of its keys, and a repeated batch changes nothing. Keyed state with timers is in
``streaming.state``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.operators.tables import upsert
from tenderspark.sources.files import FOUND, identified
from tenderspark.streaming.tables import BucketTable


def since_watermark(feed: DataFrame, marks: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Rows at or after their key's watermark or without a time, all of a key without a watermark."""
    marked = feed.join(marks.select(*keys, F.col("watermark").alias("_w")), keys, "left")
    return marked.where(F.col("_w").isNull() | F.col(ts).isNull() | (F.col(ts) >= F.col("_w"))).drop("_w")


def advance_watermark(marks: DataFrame, feed: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """(keys, watermark): forward only, the larger of the old one and the newest row seen."""
    seen = feed.groupBy(*keys).agg(F.max(ts).alias("watermark"))
    return marks.select(*keys, "watermark").unionByName(seen).groupBy(*keys).agg(F.max("watermark").alias("watermark"))


def new_documents(feed: DataFrame, known: DataFrame, document: str, term: str, order: list) -> tuple[DataFrame, DataFrame]:
    """(documents not seen before, one row each; links of every document to its terms)."""
    fresh = feed.join(known.select(document).distinct(), document, "left_anti")
    cols = [c for c in feed.columns if c != document]
    once = fresh.groupBy(document).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(document, "_r.*")
    return once, feed.select(document, term).distinct()


def pending_queue(queue: DataFrame, visits: DataFrame, key: str, ts: str, resolved: str) -> DataFrame:
    """(key, tries, last_seen): keys whose latest visit brought no result, with the visits since the last result."""
    all_rows = queue.select(key, ts, F.lit(False).alias(resolved)).unionByName(visits.select(key, ts, resolved))
    done = all_rows.groupBy(key).agg(F.max(F.when(F.col(resolved), F.col(ts))).alias("_done"))
    open_rows = all_rows.join(done, key).where(F.col("_done").isNull() | (F.col(ts) > F.col("_done")))
    return open_rows.groupBy(key).agg(F.count(F.lit(1)).alias("tries"), F.max(ts).alias("last_seen"))


def progress(counts: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Counters of each search, added up; the same expression serves a stream in update mode."""
    return counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(value).alias("total"))


def late_updates(current: DataFrame, incoming: DataFrame, key: str, order: list, update: list[str]) -> DataFrame:
    """The next version of a table whose rows take only ``update`` columns from later arrivals."""
    return upsert(current, incoming, [key], order, update)


def stale_keys(events: DataFrame, key: str, ts: str, active: Column, now: Column, seconds: int) -> DataFrame:
    """Keys in an active state whose last event is missing or older than the timeout."""
    last = events.groupBy(key).agg(F.max(ts).alias("last_at"), F.max_by(active, F.struct(F.col(ts), active)).alias("_active"))
    return last.where(F.col("_active") & (F.col("last_at").isNull() | (F.col("last_at") < now - F.make_dt_interval(secs=F.lit(float(seconds)))))).select(key, "last_at")


def read_feed(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over landed Parquet files, in folders of any depth."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


class Collection:
    """Collected hits and the watermarks of their searches, kept by a ``foreachBatch`` sink.

    A batch is joined with the watermarks as they were before it, its rows that are not older are written to a folder of its
    own, and the watermarks advance. A watermark keeps its value before the last batch that moved it: the same batch again, even
    after its watermarks were written, sees what it saw the first time and writes the same rows.
    """

    MARKS = "term string, source string, watermark timestamp, before timestamp, at long"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path = spark, path
        self.marks = BucketTable(spark, f"{path}/marks", self.MARKS, ["term", "source"], buckets)

    def sink(self, batch: DataFrame, number: int) -> None:
        keys = ["term", "source"]
        before = F.when(F.col("at") >= number, F.col("before")).otherwise(F.col("watermark"))
        marks = self.marks.read().select(*keys, before.alias("watermark"))
        since_watermark(batch, marks, keys, "updated_at").write.mode("overwrite").parquet(f"{self.path}/hits/batch={number}")
        newest = batch.where("updated_at is not null").groupBy(*keys).agg(F.max("updated_at").alias("newest"))

        def advance(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.join(new, [old[k].eqNullSafe(new[k]) for k in keys], "full")
            moved = F.col("newest").isNotNull()
            return both.select(
                *[F.coalesce(old[k], new[k]).alias(k) for k in keys],
                F.greatest("watermark", "newest").alias("watermark"),
                F.when(moved, F.col("watermark")).otherwise(F.col("before")).alias("before"),
                F.when(moved, F.lit(number)).otherwise(F.col("at")).alias("at"),
            )

        self.marks.merge(newest, number, advance)

    def hits(self) -> DataFrame:
        """All collected hits, with the ``batch`` that brought them; none before the first batch."""
        empty = identified(self.spark.createDataFrame([], FOUND), ("term", "source")).withColumn("batch", F.lit(0))
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/hits")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return empty
        return self.spark.read.schema(empty.schema).parquet(f"{self.path}/hits")


def replaced(keys: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For ``BucketTable``: rows of the batch, one per key, take the place of the table's rows of the same keys."""
    return lambda old, batch: old.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def marks_merged(keys: list[str], ts: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For ``BucketTable``: watermarks after a micro-batch. Batches may come in any order."""
    return lambda old, batch: advance_watermark(old, batch, keys, ts)


def late_merged(key: str, order: list, update: list[str], when: Column | None = None) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For ``BucketTable``: ``upsert`` of late arrivals that changes only ``update``, where ``when`` holds."""
    return lambda old, batch: upsert(old, batch.select(*old.columns), [key], order, update, when)


#: State of a key in ``errors_merged``: the last event that cleared it, errors since then, and its last event.
ERRORS = "clear struct<ts:timestamp,seq:long>, attempts long, first_at timestamp, last_error_at timestamp, message string, last_at timestamp"


def errors_merged(keys: list[str], ts: str, seq: str, failed: Column, message: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """For ``BucketTable`` with columns ``keys`` and ``ERRORS``: errors of each key are counted until another event clears them.

    A batch is reduced to one row per key, with partial aggregation, before it meets the state. Batches come in the order of time;
    what a late row would have cleared in earlier batches stays."""
    at = F.struct(F.col(ts).alias("ts"), F.col(seq).cast("long").alias("seq"))

    def merge(old: DataFrame, batch: DataFrame) -> DataFrame:
        cleared = batch.groupBy(*keys).agg(F.max(F.when(~failed, at)).alias("_clear"), F.max(ts).alias("_last"))
        cleared = cleared.join(old.select(*keys, "clear"), keys, "left").select(*keys, "_last", F.greatest("_clear", "clear").alias("_clear"))
        fresh = batch.where(failed).withColumn("_at", at).join(cleared.select(*keys, "_clear"), keys).where(F.col("_clear").isNull() | (F.col("_at") > F.col("_clear")))
        fresh = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_error"), F.max_by(message, "_at").alias("_message"))
        both = old.join(cleared.join(fresh, keys, "left"), keys, "full")
        touched, stays = F.col("_last").isNotNull(), F.col("_clear").eqNullSafe(F.col("clear")) | F.col("_clear").isNull()
        since = lambda c: F.when(~touched | stays, F.col(c))
        return both.select(
            *keys,
            F.coalesce("_clear", "clear").alias("clear"),
            (F.coalesce(since("attempts"), F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("long").alias("attempts"),
            F.coalesce(since("first_at"), F.col("_first")).alias("first_at"),
            F.coalesce(F.col("_error"), since("last_error_at")).alias("last_error_at"),
            F.coalesce(F.col("_message"), since("message")).alias("message"),
            F.greatest("last_at", "_last").alias("last_at"),
        )

    return merge

