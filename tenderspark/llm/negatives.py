"""Hard-negative mining by coordinate pruning in buckets of vectors of like length.

The vectors are dealt out by length (and a hash, so that equal lengths spread), and every Arrow batch of them is a bucket:
unit vectors, and for each coordinate their sorted list. An anchor whose running floor cannot be reached at the bucket's
largest length skips the bucket. Otherwise the cosine it needs bounds each of its focus coordinates (its largest); the list
of the narrowest range gives candidates, the other ranges thin them out, inner products of integers verify them. Anchors
whose ranges leave most of a bucket are verified by one matrix product. All vectors are met by all anchors in blocks of a
bounded number of anchors; tasks hand on k rows per anchor.

Rows with a null vec_id, label or vector, or a null or non-finite component take no part; shorter vectors count as filled up
with zeros. Repeated rows stand for themselves; rows with the anchor's vec_id are not other rows. Ties go to the smaller
vec_id. Vectors of zero length score 0 everywhere. Empty tables give no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.llm.common import bounded_batches, removed_at_end, shared_folder, written

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score in hundredths of the positive's
SCALE, LABELS, FLIPPED = 256, 10, 7
ANCHORS, TOGETHER = 8_192, 512  # anchors of a block, and of one matrix product
FOCUS, DENSE = 4, 0.25  # focus coordinates; share of a bucket above which all of it is verified
_SLACK = 1e-9


def prepared(rows: DataFrame) -> DataFrame:
    """(vec_id, label, q array<long>): components times 256, rounded down; every seventh id has the next label."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    label = F.when(F.col("vec_id") % FLIPPED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select("vec_id", label.cast("long").alias("label"), q.alias("q"))


def matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """A list column as a matrix, short rows filled up with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    wide = max(width, int(sizes.max(initial=0)))
    if len(flat) == wide * len(sizes):
        return flat.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), flat.dtype)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def lengths(q: np.ndarray) -> np.ndarray:
    return np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))


def products(q: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point where that is exact."""
    top = lambda x: float(np.abs(x).max(initial=0))
    if top(q) * top(anchors) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return q @ anchors.T


class Top:
    """The k best (score, vec_id) of each of n owners, and the score that a further row must reach."""

    def __init__(self, n: int, k: int, floors: np.ndarray) -> None:
        self.k, self.least, self.floors = k, floors, floors.copy()
        self.owner, self.score, self.vec = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, owner: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        owner, score, vec = np.append(self.owner, owner), np.append(self.score, score), np.append(self.vec, vec)
        order = np.lexsort((vec, -score, owner))
        owner, score, vec = owner[order], score[order], vec[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = place < self.k
        self.owner, self.score, self.vec = owner[keep], score[keep], vec[keep]
        full = place == self.k - 1
        self.floors[owner[full]] = np.maximum(score[full], self.least[owner[full]])


class Bucket:
    """Vectors of like length with their sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray) -> None:
        self.ids, self.labels, self.q = ids, labels, q
        size = lengths(q)
        self.longest, self.shortest = size.max(initial=0), size.min(initial=np.inf)
        self.unit = q / np.where(size > 0, size, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def listed(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows by ascending coordinate ``f``, and its values."""
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """(anchors, rows): the rows of the bucket that may reach an anchor's floor; None stands for all rows."""
        size = lengths(q)
        reach = np.where(floors > 0, size * self.longest, size * self.shortest)
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(reach > 0, floors / reach, np.where(floors > 0, 2.0, -1.0))
        alive = np.flatnonzero(need <= 1 + _SLACK)
        unit = q[alive] / np.where(size[alive] > 0, size[alive], 1)[:, None]
        t = np.clip(need[alive], -1, 1)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
        u = np.take_along_axis(unit, focus, axis=1)
        spread = np.sqrt(np.maximum(0, (1 - t**2) * (1 - u**2)))
        high = np.where(u >= t, 1.0, t * u + spread) + _SLACK
        low = np.where(-u >= t, -1.0, t * u - spread) - _SLACK
        a, z = np.zeros(focus.shape, np.int64), np.full(focus.shape, len(self.ids))
        for f in np.unique(focus) if self.shortest > 0 else ():  # a zero vector has no direction
            at = np.nonzero(focus == f)
            values = self.listed(int(f))[1]
            a[at], z[at] = np.searchsorted(values, low[at], "left"), np.searchsorted(values, high[at], "right")
        width = z - a
        dense = width.min(axis=1, initial=len(self.ids)) > DENSE * len(self.ids)
        for i in np.flatnonzero(~dense):
            first = int(np.argmin(width[i]))
            rows = self.listed(int(focus[i, first]))[0][a[i, first] : z[i, first]]
            for j, f in enumerate(focus[i]):
                if j != first:
                    x = self.unit[rows, f]
                    rows = rows[(x >= low[i, j]) & (x <= high[i, j])]
            if len(rows):
                yield alive[i : i + 1], rows
        whole = alive[dense]
        for at in range(0, len(whole), TOGETHER):
            yield whole[at : at + TOGETHER], None

    def verified(self, q: np.ndarray, floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchors, rows, scores by row and anchor) of all candidates."""
        for anchors, rows in self.candidates(q, floors):
            rows = np.arange(len(self.ids)) if rows is None else rows
            yield anchors, rows, products(self.q[rows], q[anchors])


def bucketed(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("q"), width)


def best_positives(batches: Iterable[pa.RecordBatch], anchors: tuple, k: int) -> Top:
    """The k best other rows of each anchor's own label, of one task."""
    vec, label, q = anchors
    top = Top(len(vec), k, np.full(len(vec), np.iinfo(np.int64).min // 4))
    for batch in batches:
        ids, labels, rows = bucketed(batch, q.shape[1])
        wide = np.pad(q, ((0, 0), (0, rows.shape[1] - q.shape[1])))
        for own in np.intersect1d(labels, label):
            mine, of = np.flatnonzero(label == own), labels == own
            bucket = Bucket(ids[of], labels[of], rows[of])
            for some, at, scores in bucket.verified(wide[mine], top.floors[mine]):
                good = (scores >= top.floors[mine[some]]) & (bucket.ids[at][:, None] != vec[mine[some]])
                r, c = np.nonzero(good)
                top.add(mine[some][c], scores[r, c], bucket.ids[at][r])
    return top


def best_negatives(batches: Iterable[pa.RecordBatch], anchors: tuple, owner: np.ndarray, positive: np.ndarray, k: int) -> Top:
    """For each (anchor, positive score) the k best rows of other labels inside its band, of one task."""
    vec, label, q = anchors
    low, high = -((-LOW * positive) // 100), (HIGH * positive) // 100
    top = Top(len(owner), k, low)
    first, count = np.searchsorted(owner, np.arange(len(vec))), np.bincount(owner, minlength=len(vec))
    open_band = low <= high
    for batch in batches:
        ids, labels, rows = bucketed(batch, q.shape[1])
        bucket, wide = Bucket(ids, labels, rows), np.pad(q, ((0, 0), (0, rows.shape[1] - q.shape[1])))
        floors = np.full(len(vec), np.iinfo(np.int64).max // 4)
        np.minimum.at(floors, owner[open_band], top.floors[open_band])
        for some, at, scores in bucket.verified(wide, floors):
            other = bucket.labels[at][:, None] != label[some]
            for j in range(int(count[some].max(initial=0))):
                pair = np.minimum(first[some] + j, len(owner) - 1)
                good = other & (scores >= top.floors[pair]) & (scores <= high[pair]) & (j < count[some])
                r, c = np.nonzero(good)
                if len(r):
                    top.add(pair[c], scores[r, c], bucket.ids[at][r])
    return top


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor its ``positives`` best
    other rows of the same label, and for each of those the ``negatives`` best rows of another label whose score is 50 to 95
    hundredths of the positive's. ``rows`` as ``prepared`` gives them."""
    spark = rows.sparkSession
    bounded_batches(spark)
    long = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    dealt = rows.withColumn("_length", long).repartitionByRange(F.desc("_length"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("_length"))
    rows = written(dealt.select("vec_id", "label", "q"), "vectors")
    asked = written(rows.where(is_anchor), "anchors")
    n = asked.count()
    folder = f"{shared_folder(spark)}/hard-negatives-{uuid.uuid4().hex}"
    removed_at_end(spark, folder)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], result).write.parquet(folder)
    parts = math.ceil(n / block)
    for i in range(parts):
        some = asked.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)) == i).orderBy("vec_id").toArrow()
        if not some.num_rows:
            continue
        known = spark.sparkContext.broadcast((some.column("vec_id").to_numpy(), some.column("label").to_numpy(), matrix(some.column("q").combine_chunks())))

        def task_positives(batches: Iterable[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            top = best_positives(batches, known.value, positives)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (top.owner, top.score, top.vec)], ["owner", "score", "vec"])

        def ranked(found: DataFrame, k: int) -> DataFrame:
            place = F.row_number().over(Window.partitionBy("owner").orderBy(F.desc("score"), "vec"))
            return found.withColumn("rank", place).where(F.col("rank") <= k)

        pairs = ranked(rows.mapInArrow(task_positives, "owner long, score long, vec long"), positives).orderBy("owner", "rank").toArrow()
        owner, score = pairs.column("owner").to_numpy(), pairs.column("score").to_numpy()
        if not len(owner):
            continue
        bands = spark.sparkContext.broadcast((owner, score))

        def task_negatives(batches: Iterable[pa.RecordBatch], known=known, bands=bands) -> Iterator[pa.RecordBatch]:
            top = best_negatives(batches, known.value, *bands.value, negatives)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (top.owner, top.score, top.vec)], ["owner", "score", "vec"])

        named = pa.table({"owner": np.arange(len(owner)), "anchor_id": known.value[0][owner], "positive_id": pairs.column("vec").to_numpy(), "positive_score": score})
        found = ranked(rows.mapInArrow(task_negatives, "owner long, score long, vec long"), negatives)
        found = found.join(F.broadcast(spark.createDataFrame(named)), "owner")
        found.select("anchor_id", "positive_id", "rank", F.col("vec").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(folder)
    return spark.read.schema(result).parquet(folder)
