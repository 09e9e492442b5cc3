"""Scores of the codes of a block against its items, tile by tile.

The items of a block are dealt into tiles of bounded size and the block's codes go to each of them, so what is shuffled is the
items once and the codes once per tile, never a row per pair, and a block of any size is worked by many tasks. In a tile,
cosines are one matrix product. BM25 runs over the tile's postings; where only pairs above a floor count, the terms of a
code are taken by descending highest weight in the tile, and items that hold none of those needed to reach the floor are
never scored. A tile hands on the best pairs of each code.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tenderspark.sources.files import written
from tenderspark.sources.ship import ship

TILE_ITEMS, TILE_CODES = 1024, 4096
PAIR_CODES, MOST_PARTS = 512, 4000  # codes of a tile of which every pair comes out, and into how many partitions such tiles are dealt
NEGATIVE_IDF = 0.25
DIGITS = 9  # scores are compared to so many decimals, as sums differ in their last digits by the order of terms


def dealt(df: DataFrame, block: str, most: int) -> DataFrame:
    """(block, n): into how many tiles of about ``most`` rows each block goes."""
    return df.groupBy(block).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("n"))


def block_terms(catalog: DataFrame, items: DataFrame, block: str, code: str, tokens: str) -> DataFrame:
    """(block, code, terms array<struct<term, n, idf>>, avg_len): the terms of each code that the block's items hold, how
    often the code has them and their idf. A negative idf is replaced by a quarter of the block's mean idf."""
    sized = items.groupBy(block).agg(F.count(F.lit(1)).alias("_docs"), (F.sum(F.greatest(F.size(tokens), F.lit(0))) / F.count(F.lit(1))).alias("avg_len"))
    df = items.select(block, F.explode_outer(F.array_distinct(tokens)).alias("term")).where("term is not null").groupBy(block, "term").agg(F.count(F.lit(1)).alias("_df"))
    sized = F.broadcast(sized)  # a row per block; joins by the block alone would bring all of it to one task
    raw = df.join(sized, block).withColumn("_idf", F.log(F.col("_docs") - F.col("_df") + 0.5) - F.log(F.col("_df") + 0.5))
    raw = written(raw, "term-weights")
    mean = raw.groupBy(block).agg(F.avg("_idf").alias("_mean"))
    asked = catalog.select(block, code, F.explode_outer(tokens).alias("term")).where("term is not null").groupBy(block, code, "term").agg(F.count(F.lit(1)).alias("n"))
    idf = F.when(F.col("_idf") < 0, NEGATIVE_IDF * F.col("_mean")).otherwise(F.col("_idf"))
    held = asked.join(raw, [block, "term"]).join(F.broadcast(mean), block).groupBy(block, code).agg(F.collect_list(F.struct("term", "n", idf.alias("idf"))).alias("terms"))
    return catalog.select(block, code).distinct().join(held, [block, code], "left").join(sized.select(block, "avg_len"), block)


class Tile:
    """The items of a tile by term: rows, weights, and the highest weight of each term."""

    def __init__(self, items: pa.Table, codes: pa.Table, k1: float, b: float) -> None:
        self.n = items.num_rows
        terms = codes.column("terms").combine_chunks()
        self.ends = np.append(0, np.cumsum(np.nan_to_num(pc.list_value_length(terms).to_numpy(zero_copy_only=False)).astype(np.int64)))
        flat = terms.flatten()
        names = pc.unique(flat.field("term")) if len(flat) else pa.array([], pa.string())
        self.term = pc.index_in(flat.field("term"), names).to_numpy(zero_copy_only=False).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
        self.times = flat.field("n").to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)
        idf = np.zeros(len(names))
        idf[self.term] = flat.field("idf").to_numpy(zero_copy_only=False) if len(flat) else 0
        tokens = items.column("tokens").combine_chunks()
        length = np.nan_to_num(pc.list_value_length(tokens).to_numpy(zero_copy_only=False)).astype(np.int64)
        found = pc.index_in(tokens.flatten(), names).to_numpy(zero_copy_only=False) if len(names) else np.full(int(length.sum()), np.nan)
        hit = np.flatnonzero(~np.isnan(found)) if found.dtype.kind == "f" else np.arange(len(found))
        cell, tf = np.unique(found[hit].astype(np.int64) * self.n + np.repeat(np.arange(self.n), length)[hit], return_counts=True)
        owner, self.rows = np.divmod(cell, max(self.n, 1))
        avg = float(codes.column("avg_len")[0].as_py() or 0) if codes.num_rows else 0.0
        share = length[self.rows] / avg if avg else 0.0
        self.weight = idf[owner] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * share))
        self.first = np.searchsorted(owner, np.arange(len(names) + 1))
        self.top = np.array([max(0.0, self.weight[a:z].max(initial=0.0)) for a, z in zip(self.first[:-1], self.first[1:], strict=True)])

    def scores(self, code: int, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """(BM25 of every item, which items may reach ``least``); scores of the others are not complete. Every item may reach
        a floor of 0 or less."""
        term, times = (x[self.ends[code] : self.ends[code + 1]] for x in (self.term, self.times))
        out, may = np.zeros(self.n), np.full(self.n, least <= 0)
        order = np.argsort(-self.top[term] * times)
        rest = np.append(np.cumsum((self.top[term] * times)[order][::-1])[::-1], 0.0)
        for i, j in enumerate(order):
            rows = slice(self.first[term[j]], self.first[term[j] + 1])
            at, gain = self.rows[rows], self.weight[rows] * times[j]
            if rest[i] < least:  # items without any earlier term cannot reach it
                held = may[at]
                at, gain = at[held], gain[held]
            out[at] += gain
            may[at] = True
        return out, may

    def holds(self, code: int) -> np.ndarray:
        """Which items have a term of the code."""
        out = np.zeros(self.n, bool)
        for t in self.term[self.ends[code] : self.ends[code + 1]]:
            out[self.rows[self.first[t] : self.first[t + 1]]] = True
        return out


def unit_rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column of vectors as rows of length one, and which rows have a length; vectors of another size than the first have none."""
    size = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    wide = int(size[size > 0][0]) if (size > 0).any() else 0
    out = np.zeros((len(size), wide))
    good = np.flatnonzero(size == wide) if wide else np.zeros(0, np.int64)
    if len(good):
        out[good] = lists.take(pa.array(good)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(good), wide)
    norm = np.sqrt((out**2).sum(axis=1))
    known = np.isfinite(norm) & (norm > 0)
    out[known] /= norm[known, None]
    out[~known] = 0
    return out, known


def tiled(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, work: Callable[[pa.Table, pa.Table], dict], schema: str, tile_items: int = TILE_ITEMS, tile_codes: int = TILE_CODES) -> DataFrame:
    """``work(items, codes)`` of every tile: the items of a block in tiles, each with the block's codes (in tiles too, if
    they are very many). Blocks without a code or without an item give nothing."""
    ship(catalog.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))
    left, right = placed(catalog, items, block, code, key, grid_of(catalog, items, block, tile_items, tile_codes))
    return worked(left, right, block, work, out, schema)


def grid_of(catalog: DataFrame, items: DataFrame, block: str, tile_items: int, tile_codes: int) -> DataFrame:
    """(block, _ni, _nc): the tiles of items and of codes of each block that has both."""
    return dealt(items, block, tile_items).withColumnRenamed("n", "_ni").join(dealt(catalog, block, tile_codes).withColumnRenamed("n", "_nc"), block)


def placed(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str, grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, codes) with ``_it`` and ``_ct``, the tiles that they go to. The grid has a row per block and is broadcast: a
    shuffle by the block alone would bring all of a block to one task."""
    grid = F.broadcast(grid)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    salt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = items.join(grid, block).withColumn("_it", salt(key, "_ni")).withColumn("_ct", spread("_nc")).drop("_ni", "_nc")
    right = catalog.join(grid, block).withColumn("_ct", salt(code, "_nc")).withColumn("_it", spread("_ni")).drop("_ni", "_nc")
    return left, right


def worked(left: DataFrame, right: DataFrame, block: str, work: Callable[[pa.Table, pa.Table], dict], out: pa.Schema, schema: str) -> DataFrame:

    def one(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.table(work(a, b), schema=out) if a.num_rows and b.num_rows else out.empty_table()

    left = left.select(*[F.col(c).alias(c) for c in left.columns])  # both sides may come from one table
    keys = [block, "_it", "_ct"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(one, schema)


def spread_tiles(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``placed`` in tiles of which all pairs come out, dealt into as many partitions as there are tiles. What a tile reads is
    small and says nothing of what it gives, so the number is named: Spark would join small partitions into few."""
    grid = written(grid_of(catalog, items, block, TILE_ITEMS, PAIR_CODES), "grid")
    n = min(grid.agg(F.sum(F.col("_ni").cast("long") * F.col("_nc"))).first()[0] or 1, MOST_PARTS)
    return tuple(x.repartition(n, block, "_it", "_ct") for x in placed(catalog, items, block, code, key, grid))


def product_tiles(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str) -> DataFrame:
    """(block, code, key): all pairs of a block."""
    left, right = spread_tiles(catalog.select(block, code), items.select(block, key), block, code, key)
    return left.join(right, [block, "_it", "_ct"]).select(block, code, key)


def cosine_tiles(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str) -> DataFrame:
    """(block, code, key, cosine) of all pairs of a block, both sides with ``vector``: a matrix product per tile. The cosine is
    null where a vector is null, holds a null or has no length, or where their sizes differ."""
    ship(catalog.sparkSession)

    def work(a: pa.Table, c: pa.Table) -> dict:
        mine, theirs = (by_size(x.column("vector").combine_chunks()) for x in (c, a))
        found, known = np.zeros((c.num_rows, a.num_rows)), np.zeros((c.num_rows, a.num_rows), bool)
        for size in mine.keys() & theirs.keys():
            (i, x), (j, y) = mine[size], theirs[size]
            found[np.ix_(i, j)], known[np.ix_(i, j)] = x @ y.T, True
        own, at = np.repeat(np.arange(c.num_rows), a.num_rows), np.tile(np.arange(a.num_rows), c.num_rows)
        return picked(a, c, block, code, key, own, at) | {"cosine": pa.array(found.ravel(), mask=~known.ravel())}

    schema = f"{typed(catalog, items, block, code, key)}, cosine double"
    return worked(*spread_tiles(catalog, items, block, code, key), block, work, to_arrow_schema(StructType.fromDDL(schema)), schema)


def by_size(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Size -> (rows, their vectors brought to length one), of the vectors that have a length and no null."""
    size, out = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), {}
    for n in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == n)
        flat = lists.take(pa.array(rows)).flatten()
        whole = ~pc.is_null(flat).to_numpy(zero_copy_only=False).reshape(len(rows), n).any(axis=1)
        v = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), n)
        norm = np.sqrt((v**2).sum(axis=1))
        good = whole & (norm != 0)
        out[int(n)] = rows[good], v[good] / norm[good, None]
    return out


def typed(catalog: DataFrame, items: DataFrame, block: str, code: str, key: str) -> str:
    kind = lambda df, c: f"`{c}` {df.schema[c].dataType.simpleString()}"
    return f"{kind(catalog, block)}, {kind(catalog, code)}, {kind(items, key)}"


def bm25_tiles(asked: DataFrame, items: DataFrame, block: str, code: str, key: str, k1: float, b: float) -> DataFrame:
    """(block, code, key, bm25) of the pairs that share a term; ``asked`` from ``block_terms``, ``items`` with ``tokens``."""

    def work(a: pa.Table, c: pa.Table) -> dict:
        tile = Tile(a, c, k1, b)
        found = [(i, np.flatnonzero(tile.holds(i)), tile.scores(i)[0]) for i in range(c.num_rows)]
        at = np.concatenate([rows for _, rows, _ in found])
        own = np.repeat(np.arange(c.num_rows), [len(rows) for _, rows, _ in found])
        return picked(a, c, block, code, key, own, at) | {"bm25": np.concatenate([x[rows] for _, rows, x in found])}

    return tiled(asked, items, block, code, key, work, f"{typed(asked, items, block, code, key)}, bm25 double")


def bm25_limits(asked: DataFrame, items: DataFrame, block: str, code: str, key: str, k1: float, b: float) -> DataFrame:
    """(block, lo, hi): the least and the greatest BM25 of all pairs of a block, those without a common term (0) too."""

    def work(a: pa.Table, c: pa.Table) -> dict:
        tile = Tile(a, c, k1, b)
        ends = [(x.min(), x.max()) for x in (tile.scores(i)[0] for i in range(c.num_rows))]
        return {block: c.column(block).slice(0, 1), "lo": [min(lo for lo, _ in ends)], "hi": [max(hi for _, hi in ends)]}

    kind = f"`{block}` {asked.schema[block].dataType.simpleString()}, lo double, hi double"
    return tiled(asked, items, block, code, key, work, kind).groupBy(block).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def picked(items: pa.Table, codes: pa.Table, block: str, code: str, key: str, own: np.ndarray, at: np.ndarray) -> dict:
    return {block: codes.column(block).take(pa.array(own)), code: codes.column(code).take(pa.array(own)), key: items.column(key).take(pa.array(at))}


def best_tiles(codes: DataFrame, items: DataFrame, block: str, code: str, key: str, k: int, floor: float, k1: float, b: float, lexical: bool, vectors: bool) -> DataFrame:
    """(block, code, key, bm25, cosine, score): the best ``k`` pairs of each code of at least ``floor``, by the larger of the
    BM25 normed by ``lo`` and ``hi`` and the cosine. ``codes`` has ``terms``, ``avg_len``, ``lo`` and ``hi`` if ``lexical``, and
    ``vector`` as the items have it if ``vectors``; a signal that is not asked for, or of a missing vector, is 0."""

    def normed(raw: np.ndarray, lo: float, hi: float) -> np.ndarray:
        return (raw - lo) / (hi - lo) if hi > lo else np.zeros(len(raw))

    def work(a: pa.Table, c: pa.Table) -> dict:
        a = a.take(pc.sort_indices(a.column(key)))  # ties go to the smaller key
        none = np.zeros(a.num_rows)
        tile = Tile(a, c, k1, b) if lexical else None
        lo, hi = (c.column(x).to_numpy() for x in ("lo", "hi")) if lexical else (None, None)
        cosines = unit_rows(c.column("vector").combine_chunks())[0] @ unit_rows(a.column("vector").combine_chunks())[0].T if vectors else None
        own, at, bm, cos, best = [], [], [], [], []
        for i in range(c.num_rows):
            lex, may = none, np.full(a.num_rows, True)
            if lexical:
                least = floor * (hi[i] - lo[i]) + lo[i] if hi[i] > lo[i] else (np.inf if floor > 0 else 0.0)
                raw, may = tile.scores(i, least - 1e-6 * (1 + abs(least)))
                lex = normed(raw, lo[i], hi[i])
            near = cosines[i] if vectors else none
            score = np.round(np.maximum(np.where(may, lex, -np.inf), near) if lexical else near, DIGITS)
            good = np.flatnonzero(score >= floor)
            good = good[np.lexsort((good, -score[good]))[:k]]
            if not may[good].all():  # chosen for their cosine: their BM25 is not complete yet
                lex = normed(tile.scores(i)[0], lo[i], hi[i])
            own.append(np.full(len(good), i))
            at.append(good)
            bm.append(lex[good])
            cos.append(near[good])
            best.append(score[good])
        return picked(a, c, block, code, key, np.concatenate(own), np.concatenate(at)) | {"bm25": np.concatenate(bm), "cosine": np.concatenate(cos), "score": np.concatenate(best)}

    found = tiled(codes, items, block, code, key, work, f"{typed(codes, items, block, code, key)}, bm25 double, cosine double, score double")
    place = F.row_number().over(Window.partitionBy(block, code).orderBy(F.desc("score"), key))
    return found.withColumn("place", place).where(F.col("place") <= k)
