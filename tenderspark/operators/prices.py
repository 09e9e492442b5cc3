"""Price trust and ranking: outlier flags by interquartile range and bands, floors on evidence, cheapest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.operators.quantiles import HOT_ROWS, exact_quantiles, renamed, same_group


def iqr_bounds(df: DataFrame, by: list[str], price: str, factor: float = 3.0, accuracy: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(by, q1, q3, lo, hi): quartiles by linear interpolation over non-null prices, exact for groups of any size
    (``exact_quantiles``); ``accuracy`` takes a sketch instead."""
    if accuracy is None:
        q = exact_quantiles(df, by, price, [0.25, 0.75], hot_rows)
    else:
        q = df.groupBy(*by).agg(F.percentile_approx(price, F.array(F.lit(0.25), F.lit(0.75)), accuracy).alias("q"))
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select(*by, q1.alias("q1"), q3.alias("q3"), (q1 - factor * (q3 - q1)).alias("lo"), (q3 + factor * (q3 - q1)).alias("hi"))


def price_flags(df: DataFrame, by: list[str], price: str, factor: float = 3.0, accuracy: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``price_flag``: null, not positive, or outside the bounds of its group; rows with a null in ``by`` are a
    group like any other. ``accuracy`` and ``hot_rows`` as in ``iqr_bounds``.

    The bounds are aggregated first and joined back, so a group of any size is never held by one task."""
    p = F.col(price)
    bad = p.isNull() | (p <= 0) | (p < F.col("lo")) | (p > F.col("hi"))
    bounds = renamed(iqr_bounds(df, by, price, factor, accuracy, hot_rows), by, "_by_", "lo", "hi")
    flagged = df.join(bounds, same_group(df, by, "_by_")).withColumn("price_flag", F.coalesce(bad, F.lit(True)))
    return flagged.drop("lo", "hi", *[f"_by_{c}" for c in by])


def band_flag(price: Column, low: Column, high: Column) -> Column:
    """Outside [low, high]; a null bound is no limit."""
    return F.coalesce(price < low, F.lit(False)) | F.coalesce(price > high, F.lit(False))


def with_bands(df: DataFrame, bands: DataFrame, category: str, price: str) -> DataFrame:
    """``df`` with ``price_flag`` or-ed with its category's band (category, price_min, price_max); no band, no limit."""
    joined = df.join(bands, category, "left")
    return joined.withColumn("price_flag", F.col("price_flag") | band_flag(F.col(price), F.col("price_min"), F.col("price_max"))).drop("price_min", "price_max")


def enough_items(df: DataFrame, by: list[str], item: str, least: int) -> DataFrame:
    """Rows of the groups with at least ``least`` distinct items."""
    good = df.groupBy(*by).agg(F.countDistinct(item).alias("_n")).where(F.col("_n") >= least).select(*by)
    return df.join(good, by, "left_semi")


def rank_cheapest(df: DataFrame, by: list[str], price: str, key: str, top: int = 0) -> DataFrame:
    """``df`` with ``position`` 1..n by price, ties by key; ``top`` <= 0 keeps all, else the first ``top``."""
    out = df.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy(price, key)))
    return out.where(F.col("position") <= top) if top > 0 else out


def rank_prices(items: DataFrame, by: list[str], price: str, item: str, bands: DataFrame | None = None, category: str | None = None, factor: float = 3.0, least: int = 1, top: int = 0, accuracy: int | None = None) -> DataFrame:
    """Flags, then the unflagged rows of groups with enough items, cheapest first."""
    flagged = price_flags(items, by, price, factor, accuracy)
    if bands is not None:
        flagged = with_bands(flagged, bands, category, price)
    return rank_cheapest(enough_items(flagged.where("not price_flag").drop("price_flag"), by, item, least), by, price, item, top)


def group_report(flagged: DataFrame, by: list[str], item: str, least: int = 1) -> DataFrame:
    """(by, n_valid, n_flagged, closed): distinct items by flag, and whether there are enough valid ones."""
    n = lambda want: F.countDistinct(F.when(F.col("price_flag") == want, F.col(item)))
    return flagged.groupBy(*by).agg(n(False).alias("n_valid"), n(True).alias("n_flagged")).withColumn("closed", F.col("n_valid") >= least)


def pick_winner(df: DataFrame, by: list[str], price: str, rank: str, seq: str) -> DataFrame:
    """One row per group: of those with a valid price (else of all) that with the smallest rank, a missing one 9999."""
    order = F.struct(F.when(F.col(price) > 0, 0).otherwise(1), F.coalesce(F.col(rank), F.lit(9999)), F.col(seq))
    cols = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.min_by(F.struct(*cols), order).alias("_w")).select(*by, "_w.*")


def homologated_price(items: DataFrame, winners: DataFrame, by: list[str], estimate: str) -> DataFrame:
    """``items`` with ``price``, ``supplier`` and ``dated`` of the winner if its price is there and not zero, else the estimate
    alone."""
    w = winners.select(*by, F.col("price").alias("_p"), F.col("supplier").alias("_s"), F.col("dated").alias("_d"))
    good = F.coalesce(F.col("_p") != 0, F.lit(False))
    return items.join(w, by, "left").withColumn("price", F.when(good, F.col("_p")).otherwise(F.col(estimate))).withColumn("supplier", F.when(good, F.col("_s"))).withColumn("dated", F.when(good, F.col("_d"))).drop("_p", "_s", "_d")
