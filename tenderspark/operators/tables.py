"""Keyed-table operators: which row wins, upserts, deltas between two versions, and integrity reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a total order (``first_wins``; give a descending order for ``last_wins``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column | str], update: list[str] | None = None, when: Column | None = None) -> DataFrame:
    """The next version of ``current``: the batch is deduplicated on ``keys``, new keys are added, and of known keys
    only the columns of ``update`` change (none: do nothing), and those only where ``when`` holds, a condition on the structs
    ``_old`` and ``_new`` of a row's two versions (null counts as false). Both inputs have the same columns."""
    batch = one_per_key(incoming, keys, order).select(*keys, F.struct(*current.columns).alias("_new"))
    joined = current.select(*keys, F.struct(*current.columns).alias("_old")).join(batch, keys, "full")
    changes = F.col("_new").isNotNull() & (F.lit(True) if when is None else F.coalesce(when, F.lit(False)))

    def pick(c: str) -> Column:
        new = F.col("_old").isNull() | (changes & F.lit(c in (update or [])))
        return F.when(new, F.col("_new")[c]).otherwise(F.col("_old")[c])

    return joined.select(*[F.col(c) if c in keys else pick(c).alias(c) for c in current.columns])


def append_missing(done: DataFrame, todo: DataFrame, keys: list[str]) -> DataFrame:
    """``todo`` without the keys already in ``done``: what a resumed run still has to append."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def snapshot_delta(current: DataFrame, previous: DataFrame | None, keys: list[str], hash_col: str) -> DataFrame:
    """(keys, status): new, removed or changed against the previous snapshot; without one the delta is empty."""
    if previous is None:
        return current.select(*keys, F.lit("new").alias("status")).where(F.lit(False))
    a = current.select(*keys, F.col(hash_col).alias("_a"), F.lit(True).alias("_in_a"))
    b = previous.select(*keys, F.col(hash_col).alias("_b"), F.lit(True).alias("_in_b"))
    status = F.when(F.col("_in_b").isNull(), "new").when(F.col("_in_a").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return a.join(b, keys, "full").select(*keys, status.alias("status")).where("status is not null")


class Snapshot:
    """A stored baseline: versions of a keyed table in numbered folders, of which the newest complete one counts. Taking a new
    one deletes those before the last, so write what a comparison gives before the next one."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _versions(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = folder(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder(self.path)):
            return []
        names = [str(x.getPath().getName()) for x in fs.listStatus(folder(self.path))]
        return sorted(int(n[1:]) for n in names if fs.exists(folder(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame | None:
        """The baseline; None before the first."""
        found = self._versions()
        return self.spark.read.parquet(f"{self.path}/v{found[-1]}") if found else None

    def advance(self, rows: DataFrame) -> DataFrame:
        """``rows`` become the baseline; returns them as stored."""
        found = self._versions()
        number = found[-1] + 1 if found else 0
        rows.write.mode("overwrite").parquet(f"{self.path}/v{number}")
        for old in found[:-1]:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{old}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return self.spark.read.parquet(f"{self.path}/v{number}")

    def delta(self, current: DataFrame, keys: list[str], hash_col: str) -> DataFrame:
        """``snapshot_delta`` against the baseline, which ``current`` becomes."""
        before = self.read()
        return snapshot_delta(self.advance(current.select(*keys, hash_col)), before, keys, hash_col)


def changed_only(current: DataFrame, new: DataFrame, keys: list[str], col: str) -> DataFrame:
    """The rows whose ``col`` is distinct from the current value, nulls compared as values."""
    return new.join(current.select(*keys, F.col(col).alias("_old")), keys).where(~F.col(col).eqNullSafe(F.col("_old"))).drop("_old")


def value_diff(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose values differ between two key/value sets; a missing side is null."""
    both = a.select(key, F.col(value).alias("value_a")).join(b.select(key, F.col(value).alias("value_b")), key, "full")
    return both.where(~F.col("value_a").eqNullSafe(F.col("value_b")))


def orphan_report(checks: Iterable[tuple[str, DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """(check_name, n): for each check the child rows without a parent on the keys; every n is expected to be 0. Rows with a null
    key have no parent."""
    out = None
    for name, child, parent, keys in checks:
        one = child.join(parent.select(*keys).distinct(), keys, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def rule_report(rules: Iterable[tuple[str, DataFrame, Column]]) -> DataFrame:
    """(check_name, n): for each rule the rows that break it; rules of one table are counted in one pass over it."""
    by_table: dict[int, tuple[DataFrame, list[tuple[str, Column]]]] = {}
    for name, df, broken in rules:
        by_table.setdefault(id(df), (df, []))[1].append((name, broken))
    out = None
    for df, checks in by_table.values():
        row = df.agg(*[F.count_if(broken).alias(name) for name, broken in checks])
        pairs = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("n")) for name, _ in checks])
        one = row.select(F.explode(pairs).alias("x")).select("x.*")
        out = one if out is None else out.unionByName(one)
    return out


def count_report(tables: dict[str, tuple[DataFrame, int]], tolerance: float = 0.01) -> DataFrame:
    """(table_name, n, expected, delta, ok): counts against expected values within a relative tolerance."""
    out = None
    for name, (df, expected) in tables.items():
        n = F.count(F.lit(1))
        one = df.agg(n.alias("n")).select(F.lit(name).alias("table_name"), "n", F.lit(expected).cast("long").alias("expected"), (F.col("n") - expected).alias("delta"), (F.abs(F.col("n") - expected) <= tolerance * expected).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def retire_missing(generated: DataFrame, existing: DataFrame, key: str, manual: Column) -> DataFrame:
    """Manual rows stay active; generated ones are replaced: those equal to a manual key are dropped, those no longer
    generated are kept inactive. -> (key, origin, active)"""
    mine = existing.where(manual).select(key, F.lit("manual").alias("origin"), F.lit(True).alias("active"))
    fresh = generated.select(key).distinct().join(mine.select(key), key, "left_anti").select(key, F.lit("generated").alias("origin"), F.lit(True).alias("active"))
    gone = existing.where(~manual).select(key).distinct().join(generated.select(key).distinct(), key, "left_anti").join(mine.select(key), key, "left_anti").select(key, F.lit("generated").alias("origin"), F.lit(False).alias("active"))
    return mine.unionByName(fresh).unionByName(gone)
