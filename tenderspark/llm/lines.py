"""Line dedup over levelled sorted runs of line keys.

A run is a table (key, n, last): how many documents hold the line and the largest doc_id among them, bucketed and sorted by
the key's 128-bit hash. A new batch is aggregated, anti-joined with the runs (what they already settle adds nothing) and
becomes a run of its own; runs of equal cover are merged into one of the next level. Merging joins bucket with bucket and
shuffles nothing. A line that a third of all documents hold is one row per task before the shuffle and one row in a run.

Null doc_ids count as one document, smaller than any other. A null or empty text is one empty line. Rows that share a doc_id
are one document. Empty tables give empty results; further columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm.common import as_bytes, bounded_batches, removed_at_end, shared_folder, written

LEAST_CHARS, LEAST_DOCS = 40, 5
BATCHES = 4
_BLANK = b" \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def line_keys(text: bytes | None, least: int) -> list[bytes | None]:
    """For each line of the text the hash of its normal form; None if that has fewer than ``least`` code points."""
    out: list[bytes | None] = []
    for line in (text or b"").translate(_LOWER).split(b"\n"):
        form = line.strip(_BLANK)
        long = len(form) >= least and (form.isascii() or len(form.decode("utf-8", "replace")) >= least)
        out.append(hashlib.blake2b(form, digest_size=16).digest() if long else None)
    return out


def keyed_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(key binary, doc_id): the long lines of every document, each once."""
    bounded_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = {k for k in line_keys(text, least) if k is not None}
                found += own
                rows += [row] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("doc_id").take(pa.array(rows, pa.int64()))], ["key", "doc_id"])

    kept = docs.where(F.length("text") >= least).select("doc_id", as_bytes())
    return kept.mapInArrow(keys, f"key binary, doc_id {id_type.simpleString()}").distinct()


class LineRuns:
    """The runs named ``name``, as tables of the session's catalogue under ``folder``; opened again they are found there.

    A run's name states the batches it covers. A merged run is written before what it covers is dropped, and covered runs
    are not read, so a failure in between loses and repeats nothing; a batch that is covered already is not added again.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, fanout: int = 2, least_docs: int = LEAST_DOCS) -> None:
        self.spark, self.name, self.folder, self.fanout, self.least_docs = spark, name, folder, fanout, least_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def covers(self) -> list[tuple[int, int]]:
        """(first, last) batch of each run that counts, oldest first."""
        found = [tuple(map(int, t.name.rsplit("_", 2)[1:])) for t in self.spark.catalog.listTables(pattern=f"{self.name}_*")]
        return sorted(a for a in found if not any(b != a and b[0] <= a[0] and a[1] <= b[1] for b in found))

    def _table(self, cover: tuple[int, int]) -> str:
        return f"{self.name}_{cover[0]}_{cover[1]}"

    def _write(self, run: DataFrame, cover: tuple[int, int]) -> None:
        path = f"{self.folder}/{self._table(cover)}"
        removed_at_end(self.spark, path)
        run.write.mode("overwrite").bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(self._table(cover))

    def counts(self, covers: list[tuple[int, int]] | None = None) -> DataFrame | None:
        """(key, n, last) over runs, all by default: a full merge join of the runs, two of which need no shuffle."""
        runs = [self.spark.table(self._table(c)) for c in (self.covers() if covers is None else covers)]

        def merged(a: DataFrame, b: DataFrame) -> DataFrame:
            both = a.join(b.select("key", F.col("n").alias("_n"), F.col("last").alias("_last")), "key", "full")
            zero = F.lit(0).cast("long")
            return both.select("key", (F.coalesce("n", zero) + F.coalesce("_n", zero)).alias("n"), F.greatest("last", "_last").alias("last"))

        return reduce(merged, runs) if runs else None

    def add(self, number: int, keyed: DataFrame) -> None:
        """Adds batch ``number``: (key, doc_id), distinct, of documents that no other batch holds."""
        covers = self.covers()
        if any(first <= number <= last for first, last in covers):
            return
        run = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
        if covers:
            settled = self.counts(covers).where(F.col("n") >= self.least_docs).select(F.col("key").alias("_key"), F.col("last").alias("_last"))
            known = (F.col("key") == F.col("_key")) & (F.col("last").isNull() | (F.col("last") <= F.col("_last")))
            run = run.join(settled, known, "left_anti")
        self._write(run, (number, number))
        self._compact()

    def _compact(self) -> None:
        """Merges the newest runs while ``fanout`` of them cover equally many batches."""
        while True:
            newest = self.covers()[-self.fanout :]
            if len(newest) < self.fanout or len({last - first for first, last in newest}) > 1:
                return
            cover = (newest[0][0], newest[-1][1])
            self._write(self.counts(newest), cover)
            for old in newest:
                self._drop(old)

    def _drop(self, cover: tuple[int, int]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(cover)}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{self._table(cover)}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self) -> None:
        for cover in self.covers():
            self._drop(cover)


def repeated(spark: SparkSession, keyed: DataFrame, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """(key, last) of the keys that at least ``least_docs`` documents of ``keyed`` (key, doc_id, batch) hold, from runs built
    batch by batch."""
    runs = LineRuns(spark, f"line_run_{uuid.uuid4().hex[:12]}", shared_folder(spark), least_docs=least_docs)
    for number in range(batches):
        runs.add(number, keyed.where(F.col("batch") == number).select("key", "doc_id"))
    found = written(runs.counts().where(F.col("n") >= least_docs).select("key", "last"), "repeated-lines")
    runs.drop()
    return found


def without_lines(docs: DataFrame, gone: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` without the lines of ``gone`` (doc_id, key), with ``n_lines`` before and ``n_dropped``. A text that loses no
    line stays as it is, but a null one becomes empty."""
    bounded_batches(docs.sparkSession)
    lost = gone.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("key").alias("_gone"))
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("_row")
    packed = docs.select(F.col("doc_id").alias("_doc"), others, as_bytes()).join(lost, F.col("_doc").eqNullSafe(F.col("_id")), "left").select("_row", "text", "_gone")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, keys in zip(batch.column("text").to_pylist(), batch.column("_gone").to_pylist(), strict=True):
                text = text or b""
                own = text.split(b"\n") if keys else []
                lines.append(len(own) or text.count(b"\n") + 1)
                if keys:
                    dead = set(keys)
                    kept = [line for line, key in zip(own, line_keys(text, least), strict=True) if key not in dead]
                    text = b"\n".join(kept)
                texts.append(text)
                dropped.append(len(own) - len(kept) if keys else 0)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.binary()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["_row", "text", "n_lines", "n_dropped"])

    schema = f"_row {packed.schema['_row'].dataType.simpleString()}, text binary, n_lines long, n_dropped long"
    out = packed.mapInArrow(cut, schema)
    own = [F.col("text").cast("string").alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return out.select(*own, "n_lines", "n_dropped")


def drop_repeated_lines(docs: DataFrame, least: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` without the lines of at least ``least`` code points that ``least_docs`` documents or more hold, but for those
    of the largest doc_id that holds them; with ``n_lines`` before and ``n_dropped``. Lines are compared without blanks at
    both ends and with A-Z lower-cased."""
    spark = docs.sparkSession
    keyed = keyed_lines(docs, least).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    folder = f"{shared_folder(spark)}/line-keys-{uuid.uuid4().hex}"
    removed_at_end(spark, folder)
    keyed.write.partitionBy("batch").parquet(folder)
    keyed = spark.read.schema(keyed.schema).parquet(folder)
    heavy = repeated(spark, keyed, least_docs, batches)
    gone = keyed.join(heavy, "key").where(~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "key")
    return without_lines(docs, gone, least)
