"""Quality of decisions: confusion matrix, gate, threshold sweeps, stratified samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, label: str, score: str, accept: float, reject: float, strict_reject: bool = False) -> DataFrame:
    """One row: tp, fp, tn, fn, undecided, n, precision, recall. ``label`` is true, false or null (pending: left out);
    a score between the thresholds, or none, is undecided. Undefined ratios are null."""
    y, s = F.col(label), F.col(score)
    yes, no = F.coalesce(s >= accept, F.lit(False)), F.coalesce(s < reject if strict_reject else s <= reject, F.lit(False))
    n = lambda c, name: F.count_if(c).alias(name)
    out = df.where(y.isNotNull()).agg(n(y & yes, "tp"), n(~y & yes, "fp"), n(~y & no, "tn"), n(y & no, "fn"), n(~yes & ~no, "undecided"), F.count(F.lit(1)).alias("n"))
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(a) + F.col(b))
    return out.withColumn("precision", ratio("tp", "fp")).withColumn("recall", ratio("tp", "fn"))


def regression_gate(matrix: DataFrame, least: float) -> DataFrame:
    """``matrix`` with ``passed``: precision and recall defined and at least ``least``."""
    return matrix.withColumn("passed", F.coalesce((F.col("precision") >= least) & (F.col("recall") >= least), F.lit(False)))


def threshold_sweep(df: DataFrame, label: str, score: str, steps: int) -> DataFrame:
    """(t, precision, recall) for t on 0, 1/(steps-1), ..., 1: of the rows with score >= t. Rows are counted by grid
    cell first, so the grid meets ``steps`` cells and not the table."""
    cell = F.least(F.greatest(F.floor(F.col(score) * (steps - 1) + 1e-9), F.lit(-1)), F.lit(steps - 1)).cast("int")
    cells = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(cell.alias("_cell")).agg(F.count_if(F.col(label)).alias("_p"), F.count(F.lit(1)).alias("_n"))
    grid = df.sparkSession.range(steps).select(F.col("id").cast("int").alias("_t"))
    above = grid.join(F.broadcast(cells), F.col("_cell") >= F.col("_t"), "left").groupBy("_t").agg(F.coalesce(F.sum("_p"), F.lit(0)).alias("_tp"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_acc"))
    total = cells.agg(F.sum("_p").alias("_all"))
    out = above.join(F.broadcast(total), F.lit(True))
    return out.select((F.col("_t") / (steps - 1)).alias("t"), F.try_divide("_tp", "_acc").alias("precision"), F.try_divide("_tp", "_all").alias("recall"), F.col("_acc").alias("n_accepted"))


def chosen_thresholds(df: DataFrame, label: str, score: str, recall: float = 0.99, precision: float = 0.97, reject_steps: int = 101, accept_steps: int = 21) -> DataFrame:
    """One row (reject_at, reject_recall, accept_at, accept_precision): the largest threshold of ``reject_steps`` from 0 to 1 that
    keeps ``recall`` of the positives (a missing score counts as 0), and the smallest of ``accept_steps`` whose accepted rows, at
    least one, have ``precision`` (rows with a score alone). Null where no threshold will do.

    Both grids are read off one aggregation into the cells of the finer one, cumulated from above; the coarser grid must be
    part of it."""
    fine, step = reject_steps - 1, (reject_steps - 1) // (accept_steps - 1)
    known = df.where(F.col(label).isNotNull())
    cell = F.least(F.greatest(F.floor(F.coalesce(F.col(score), F.lit(0.0)) * fine + 1e-9), F.lit(0)), F.lit(fine)).cast("int")
    has = F.col(score).isNotNull()
    cells = known.groupBy(cell.alias("c")).agg(F.count_if(F.col(label)).alias("p"), F.count_if(F.col(label) & has).alias("ps"), F.count_if(has).alias("n"))
    grid = df.sparkSession.range(reject_steps).select(F.col("id").cast("int").alias("c")).join(F.broadcast(cells), "c", "left")
    above = Window.orderBy(F.desc("c"))  # of the grid's rows
    up = lambda c: F.coalesce(F.sum(c).over(above), F.lit(0))
    total = F.sum("p").over(Window.partitionBy())
    curve = grid.select((F.col("c") / fine).alias("t"), (F.col("c") % step == 0).alias("coarse"), F.try_divide(up("p"), total).alias("recall"), F.try_divide(up("ps"), up("n")).alias("precision"))
    low, high = F.col("recall") >= recall, F.col("coarse") & (F.col("precision") >= precision)
    return curve.agg(
        F.max(F.when(low, F.struct("t", "recall"))).alias("r"),
        F.min(F.when(high, F.struct("t", "precision"))).alias("a"),
    ).select(F.col("r.t").alias("reject_at"), F.col("r.recall").alias("reject_recall"), F.col("a.t").alias("accept_at"), F.col("a.precision").alias("accept_precision"))


def stratified_sample(df: DataFrame, score: str, key: str, n: int, bins: int = 5, seed: str = "42") -> DataFrame:
    """Up to n / bins rows of each of ``bins`` equal-width score bins, those with the smallest md5 of key and seed."""
    lim = df.agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    cut = F.when(width > 0, F.least(F.floor((F.col(score) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    binned = df.where(F.col(score).isNotNull()).join(F.broadcast(lim), F.lit(True)).withColumn("bin", cut).drop("_lo", "_hi")
    w = Window.partitionBy("bin").orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))), key)
    return binned.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n // bins).drop("_rn")
