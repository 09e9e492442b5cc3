"""Keyed tables in hash buckets, of which a batch rewrites only those that it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class BucketTable:
    """A Parquet table under ``path``, dealt into ``buckets`` folders by a hash of ``keys``.

    ``merge`` reads the buckets of a batch's keys and replaces them by dynamic partition overwrite, so what it reads and
    writes follows the batch as long as there are more buckets than keys in a batch; choose the number so that a bucket
    is one file of some 100 MB. A bucket holds one row beside its data, with the number of the last batch merged into it:
    a batch that comes again, after a failure in its middle too, skips the buckets that have it already. The number of
    buckets belongs to the table and may not change. Rows with a null in their key are left out.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets
        self.columns = spark.createDataFrame([], schema).schema.fieldNames()
        self._schema = spark.createDataFrame([], schema).withColumns({"_batch": F.lit(0).cast("long"), "_bucket": F.lit(0)}).schema

    def _raw(self) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._raw().where("_batch is null").select(*self.columns)

    def merge(self, batch: DataFrame, number: int, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replaces the buckets of the batch's keys by ``apply(their rows, the batch's rows)``; how many it replaced."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        batch = batch.dropna(subset=self.keys).withColumn("_bucket", bucket).persist()
        try:
            touched = [r[0] for r in batch.select("_bucket").distinct().collect()]
            raw = self._raw()
            done = raw.where(F.col("_bucket").isin(touched) & (F.col("_batch") >= number)).select("_bucket").collect()
            todo = sorted({*touched} - {r[0] for r in done})
            if todo:
                old = raw.where(F.col("_bucket").isin(todo) & F.col("_batch").isNull()).select(*self.columns)
                new = apply(old, batch.where(F.col("_bucket").isin(todo)).drop("_bucket")).select(*self.columns)
                new = new.withColumn("_batch", F.lit(None).cast("long")).withColumn("_bucket", bucket)
                marks = self.spark.createDataFrame([(number, b) for b in todo], "_batch long, _bucket int")
                self._replace(new.unionByName(marks, allowMissingColumns=True), len(todo))
            return len(todo)
        finally:
            batch.unpersist()

    def delete(self, gone: Column) -> int:
        """Rewrites the buckets that hold rows where ``gone`` is true without them; how many. Others keep their files."""
        raw = self._raw()
        dead = F.coalesce(gone, F.lit(False)) & F.col("_batch").isNull()
        todo = [r[0] for r in raw.where(dead).select("_bucket").distinct().collect()]
        if todo:
            self._replace(raw.where(F.col("_bucket").isin(todo) & ~dead), len(todo))
        return len(todo)

    def delete_keys(self, gone: DataFrame) -> int:
        """As ``delete``, of all rows with a key of ``gone`` (the table's key columns)."""
        raw = self._raw()
        todo = [r[0] for r in raw.join(gone, self.keys, "left_semi").select("_bucket").distinct().collect()]
        if todo:
            self._replace(raw.where(F.col("_bucket").isin(todo)).join(gone, self.keys, "left_anti").select(*raw.columns), len(todo))
        return len(todo)

    def _replace(self, rows: DataFrame, n: int) -> None:
        """One file per bucket; Spark stages the new folders before it puts them in the place of the old ones."""
        rows.repartition(n, "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)

    def sink(self, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: merges every micro-batch under its number."""

        def merge(batch: DataFrame, number: int) -> None:
            self.merge(batch, number, apply)

        return merge
