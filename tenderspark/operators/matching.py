"""Blocked matching of catalogue entries to items: BM25 and vector scores, floor, top-K, decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.operators import tiles
from tenderspark.sources.files import written

K1, B = 1.5, 0.75


def term_counts(df: DataFrame, block: str, key: str, tokens: str) -> DataFrame:
    """(block, key, term, tf). An outer explode, as before a plain one the optimiser filters by the tokens' size, and so
    makes them twice."""
    return df.select(block, key, F.explode_outer(tokens).alias("term")).where(F.col("term").isNotNull()).groupBy(block, key, "term").agg(F.count(F.lit(1)).alias("tf"))


def corpus_stats(postings: DataFrame, block: str, key: str, docs: DataFrame) -> DataFrame:
    """(block, n_docs, avg_len): documents without tokens count with length 0."""
    lengths = postings.groupBy(block).agg(F.sum("tf").alias("_len"))
    n = docs.groupBy(block).agg(F.countDistinct(key).alias("n_docs"))
    return n.join(lengths, block, "left").select(block, "n_docs", (F.coalesce("_len", F.lit(0)) / F.col("n_docs")).alias("avg_len"))


def bm25_scores(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, tokens: str, k1: float = K1, b: float = B) -> DataFrame:
    """(block, code, key, bm25) of the pairs that share a term inside a block; repeated query terms count each time.

    The output has a row for each such pair. It is made tile by tile (``operators.tiles``); nothing but its rows grows with the
    number of pairs, and a term that every item has is no key of a join."""
    rows = written(items.select(block, key, F.col(tokens).alias("tokens")), "tokens")
    return tiles.bm25_tiles(written(tiles.block_terms(catalog, rows, block, code, tokens), "asked"), rows, block, code, key, k1, b)


def minmax_in_block(scores: DataFrame, catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, score: str) -> DataFrame:
    """``scores`` with ``norm`` = (x - min) / (max - min) over the whole code x item matrix of the block, where pairs
    without a row score 0; a constant block gives 0. Also the block's ``zero``: what a missing pair's norm is. ``scores`` is
    read twice, so it should be a written table."""
    n = catalog.groupBy(block).agg(F.countDistinct(code).alias("_c")).join(items.groupBy(block).agg(F.countDistinct(key).alias("_i")), block)
    lim = scores.groupBy(block).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"), F.count(F.lit(1)).alias("_n")).join(n, block)
    full, zero = F.col("_n") == F.col("_c") * F.col("_i"), F.lit(0.0)
    low, high = F.when(full, F.col("_lo")).otherwise(F.least("_lo", zero)), F.when(full, F.col("_hi")).otherwise(F.greatest("_hi", zero))
    lim = lim.select(block, low.alias("_lo"), high.alias("_hi"))
    norm = lambda x: F.when(F.col("_hi") > F.col("_lo"), (x - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(zero)
    return scores.join(F.broadcast(lim), block).withColumn("norm", norm(F.col(score))).withColumn("zero", norm(zero)).drop("_lo", "_hi")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null where either is null or has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def unit(a: Column) -> Column:
    """The array divided by its length."""
    n = F.sqrt(F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, v: s + v))
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), n))


def cosine_scores(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, vector: str) -> DataFrame:
    """(block, code, key, cosine) of all pairs inside a block, tile by tile."""
    side = lambda df, c: df.select(block, c, F.col(vector).alias("vector"))
    return tiles.cosine_tiles(side(catalog, code), side(items, key), block, code, key)


def candidate_product(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str) -> DataFrame:
    """(block, code, key) of all pairs inside a block."""
    return tiles.product_tiles(catalog, items, block, code, key)


def top_k(pairs: DataFrame, by: list[str], score: str, key: str, k: int, floor: float) -> DataFrame:
    """Pairs of at least ``floor``, the best ``k`` of each group by score, ties by key."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return pairs.where(F.col(score) >= floor).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def refilter_top_k(pairs: DataFrame, by: list[str], score: str, k: int, floor: float) -> DataFrame:
    """A second cut of a pair table: all ties at the K-th best score stay. Adds ``kept`` and ``cut_by``."""
    rank = F.rank().over(Window.partitionBy(*by).orderBy(F.desc(score)))
    cut = F.when(F.col(score) < floor, "floor").when(rank > k, "top_k")
    return pairs.withColumn("cut_by", cut).withColumn("kept", F.col("cut_by").isNull())


def candidate_pairs(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, tokens: str, k: int, floor: float, vector: str | None = None, k1: float = K1, b: float = B) -> DataFrame:
    """(block, code, key, bm25, cosine, score): score is the larger of the block-normalised BM25 and the cosine; floor
    first, then the best ``k`` per code. A pair without a common term has the BM25 that 0 is normalised to, above the floor even
    where the block's scores are negative; without vectors, or without one of them, the cosine is 0. Scores are compared to
    nine decimals, ties go to the smaller key. (block, code) and (block, key) are unique.

    No row per pair is ever shuffled: see ``operators.tiles``."""
    vectors = [] if vector is None else [F.col(vector).alias("vector")]
    rows = written(items.select(block, key, F.col(tokens).alias("tokens"), *vectors), "tokens")
    asked = written(tiles.block_terms(catalog, rows, block, code, tokens), "asked")
    codes = asked.join(F.broadcast(tiles.bm25_limits(asked, rows, block, code, key, k1, b)), block)
    if vectors:
        codes = codes.join(catalog.select(block, code, *vectors), [block, code])
    return tiles.best_tiles(codes, rows, block, code, key, k, floor, k1, b, True, bool(vectors)).drop("place")


def best_by_cosine(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, vector: str, k: int, floor: float) -> DataFrame:
    """(block, code, key, score, place): the best ``k`` items of each code by cosine, of at least ``floor``; ties by key. Pairs of
    which one has no vector, or one without length, count as 0."""
    side = lambda df, c: df.select(block, c, F.col(vector).alias("vector"))
    found = tiles.best_tiles(side(catalog, code), side(items, key), block, code, key, k, floor, K1, B, False, True)
    return found.select(block, code, key, "score", "place")


def product_size(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, k: int) -> DataFrame:
    """One row: pairs of the blocked product over common blocks, and the most that top-K can leave."""
    n = catalog.groupBy(block).agg(F.countDistinct(code).alias("_c")).join(items.groupBy(block).agg(F.countDistinct(key).alias("_i")), block)
    return n.agg(F.sum(F.col("_c") * F.col("_i")).alias("n_pairs"), F.sum(F.col("_c") * F.least("_i", F.lit(k))).alias("n_top_k"))


def decide(score: Column, accept: float, reject: float) -> Column:
    return F.when(score >= accept, "accept").when(score <= reject, "reject").when(score.isNotNull(), "ambiguous")


def final_decision(decision: Column, verdict: Column) -> Column:
    """Confirmed by accept or a yes; rejected by a no, an undetermined verdict, or a reject without verdict."""
    yes, no = verdict.eqNullSafe(F.lit("yes")), F.coalesce(verdict.isin("no", "undetermined"), F.lit(False))
    return F.when(F.coalesce(decision == "accept", F.lit(False)) | yes, "confirmed").when(no | (F.coalesce(decision == "reject", F.lit(False)) & verdict.isNull()), "rejected").otherwise("pending")


def new_labels(pairs: DataFrame, labels: DataFrame, key: str, length: int = 500) -> DataFrame:
    """Labels to append: decided pairs that have none yet, texts cut to ``length``, with where the decision came from."""
    fresh = pairs.where(F.col("final_decision").isin("confirmed", "rejected")).join(labels.select(key).distinct(), key, "left_anti")
    return fresh.select(key, F.substring("catalog_text", 1, length).alias("catalog_text"), F.substring("item_text", 1, length).alias("item_text"), "final_decision", F.when(F.col("verdict").isNull(), "rerank").otherwise("llm").alias("origin"))
