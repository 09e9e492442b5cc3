"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.sources.ship import ship

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. Where it is unset, as in tests, a run in one process
    takes one under the system's temp folder; a cluster must name one."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext._jsc.sc().isLocal():
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{os.path.join(tempfile.gettempdir(), f'spark-{spark.sparkContext.applicationId}')}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and survives lost executors. Spark deletes the
    tables of a session when it ends (``removed_at_end``), as results are read lazily until then."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    removed_at_end(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed_at_end(spark: SparkSession, path: str) -> None:
    """Marks a folder to be deleted by its file system when the driver's process ends."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at ``BATCH_BYTES``, so a run of very long texts can't fill a Python worker; and the workers
    get this package if they don't have it."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


#: What operators keep in a Python worker between the tasks of one query.
KEPT: list[dict] = []


def let_go() -> None:
    """Empties what other operators keep in this worker and gives free memory back to the system."""
    for kept in KEPT:
        kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``rows`` for tasks that keep nothing: Spark uses a worker again for other queries, and what one leaves there would stay
    beside the next one's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        try:
            yield from rows(batches)
        finally:
            let_go()

    return run


def bounded_sample(df: DataFrame, key: str, limit: int, by: str | None = None, seed: int = 7) -> DataFrame:
    """At most ``limit`` rows (of each value of ``by``), those with the smallest hash of ``key``.

    A count over the key column alone sets a hash threshold first, so that only a little more than
    ``limit`` whole rows are ever shuffled, however large the table is. Rows with a null key hash like any other.
    """
    from pyspark.sql import Window

    h = F.xxhash64(F.col(key), F.lit(seed))
    share = (h.bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))).alias("_u")
    near = lambda n: F.lit(1.5 * limit + 50) / n
    if by is None:
        n = max(1, df.select(key).count())
        return df.withColumn("_u", share).where(F.col("_u") <= near(F.lit(n))).orderBy("_u", key).limit(limit).drop("_u")
    n = df.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    kept = df.withColumn("_u", share).join(F.broadcast(n), F.col(by) == F.col("_by")).where(F.col("_u") <= near(F.col("_n")))
    w = Window.partitionBy(by).orderBy("_u", key)
    return kept.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit).drop("_u", "_by", "_n", "_r")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def as_bytes(c: str = "text") -> Column:
    return F.col(c).cast("binary").alias(c)


def arrow_rows(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()


# ---- vectorised word hashes over UTF-8 bytes -------------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, pw: np.ndarray, ipw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``: a polynomial modulo 2**64, then mixed with the length.

    ``pw`` and ``ipw`` hold the powers of an odd base and of its inverse, at least ``len(values)`` of them.
    """
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw[: len(values)], out=c[1:])
    return mix((c[ends] - c[starts]) * ipw[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Powers:
    """Powers of the base and its inverse, grown as needed and kept per worker."""

    def __init__(self) -> None:
        self.pw, self.ipw = powers(_P, 1 << 16), powers(_PINV, 1 << 16)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.pw):
            self.pw, self.ipw = powers(_P, 2 * n), powers(_PINV, 2 * n)
        return self.pw, self.ipw


POWERS = Powers()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and 0x09-0x0D."""
    gap = np.empty(len(raw) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    pw, ipw = POWERS.upto(len(raw) + 1)
    return span_hashes(raw.astype(np.uint64) + np.uint64(1), starts, ends, pw, ipw)
