"""Exact quantiles of groups of any size by distributed selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.sources.files import written

HOT_ROWS = 1_000_000
ACCURACY = 10_000


def same_group(a: DataFrame, by: list[str], prefix: str) -> Column:
    """``by`` of ``a`` equals the columns of the same names with ``prefix``; nulls are a group like any other."""
    out = F.lit(True)
    for c in by:
        out = out & a[c].eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def renamed(df: DataFrame, by: list[str], prefix: str, *others: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in by], *others)


def exact_quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], hot_rows: int = HOT_ROWS, accuracy: int = ACCURACY) -> DataFrame:
    """(by, q array<double>): for each of ``shares`` the quantile of the non-null values, by linear interpolation; null for a
    group without one.

    A group of up to ``hot_rows`` rows is one aggregation buffer. A larger one never meets in one task: a sketch brackets the two
    ranks that a quantile lies between, exact counts below and inside the bracket place them, and only the values inside it, about
    4 / ``accuracy`` of the group, are sorted. A bracket that misses its ranks (the sketch's error has a bound, so none should)
    takes in the whole group."""
    rows = written(df.select(*by, F.col(value).cast("double").alias("_v")), "values")
    sizes = rows.groupBy(*by).agg(F.count("_v").alias("_n"))
    hot = written(sizes.where(F.col("_n") > hot_rows), "hot-groups")
    if hot.isEmpty():
        return _buffered(rows, by, shares)
    is_hot = same_group(rows, by, "_h_")
    named = renamed(hot, by, "_h_", "_n")
    cold = _buffered(rows.join(named, is_hot, "left_anti"), by, shares)
    return cold.unionByName(_selected(rows.where("_v is not null").join(named, is_hot).select(*by, "_n", "_v"), by, shares, accuracy))


def _buffered(rows: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    return rows.groupBy(*by).agg(F.percentile("_v", F.array(*map(F.lit, shares))).alias("q"))


def _selected(rows: DataFrame, by: list[str], shares: list[float], accuracy: int) -> DataFrame:
    slack = 2.0 / accuracy
    ends = [min(1.0, max(0.0, s + d)) for s in shares for d in (-slack, slack)]
    sketch = rows.groupBy(*by).agg(F.first("_n").alias("_n"), F.percentile_approx("_v", F.array(*map(F.lit, ends)), accuracy).alias("_e"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    at = lambda s: F.lit(s) * (F.col("_n") - 1)
    cuts = [F.struct(F.lit(i).alias("i"), at(s).alias("at"), F.col("_e")[2 * i].alias("lo"), F.col("_e")[2 * i + 1].alias("hi")) for i, s in enumerate(shares)]
    cuts = written(sketch.select(*by, "_min", "_max", F.explode(F.array(*cuts)).alias("c")).select(*by, "_min", "_max", "c.*"), "brackets")
    cuts = _checked(rows, cuts, by)
    named = renamed(cuts, by, "_c_", "i", "at", "lo", "hi", "below")
    inside = rows.join(named, same_group(rows, by, "_c_")).where(F.col("_v").between(F.col("lo"), F.col("hi")))
    counts = inside.groupBy(*by, "i", "at", "below", "_v").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.col("below") + F.sum("_k").over(Window.partitionBy(*by, "i").orderBy("_v"))  # of the values of one bracket
    low, frac = F.floor("at"), F.col("at") - F.floor("at")
    placed = counts.withColumn("_upto", upto).groupBy(*by, "i", "at").agg(F.min(F.when(F.col("_upto") > low, F.col("_v"))).alias("a"), F.min(F.when(F.col("_upto") > F.ceil("at"), F.col("_v"))).alias("b"))
    value = F.when(frac == 0, F.col("a")).otherwise((1 - frac) * F.col("a") + frac * F.col("b"))
    return placed.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("i", value.alias("x")))).alias("q")).select(*by, F.transform("q", lambda x: x["x"]).alias("q"))


def _checked(rows: DataFrame, cuts: DataFrame, by: list[str]) -> DataFrame:
    """``cuts`` with ``below``, the exact number of values below each bracket; brackets that miss their ranks are widened."""
    named = renamed(cuts, by, "_c_", "i", "lo", "hi")
    met = rows.join(named, same_group(rows, by, "_c_"))
    n = met.groupBy(*by, "i").agg(F.count_if(F.col("_v") < F.col("lo")).alias("below"), F.count_if(F.col("_v") <= F.col("hi")).alias("upto"))
    n = renamed(n, by, "_n_", F.col("i").alias("_i"), "below", "upto")
    both = cuts.join(n, same_group(cuts, by, "_n_") & (cuts["i"] == F.col("_i")))
    good = (F.col("below") <= F.floor("at")) & (F.col("upto") > F.ceil("at"))
    widened = [F.when(good, F.col(c)).otherwise(F.col(other)).alias(c) for c, other in (("lo", "_min"), ("hi", "_max"))]
    return both.select(*by, "i", "at", *widened, F.when(good, F.col("below")).otherwise(F.lit(0)).alias("below"))
