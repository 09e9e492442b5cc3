"""Ranked lexical search by presence masks.

One pass turns every document into its length and the counts of the query terms it holds. Blocks of documents are then ranked
inside tasks: bitmaps of the terms give each document a mask of the terms of a query, documents of equal mask form a group,
and a mask's highest possible score is the sum of its terms' best contributions in the block. Groups are evaluated by
descending bound until the k-th best score so far exceeds the next bound. A task hands on k rows per query.

Queries come in blocks of bounded size, one after the other, so the broadcast vocabulary does not grow with their number.
Every row of a table is a document or a query of its own, whatever its id; null ids sort last. Null and empty texts hold no
term: such documents are never found and such queries find nothing. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderspark.llm.common import as_bytes, bounded_batches, written
from tenderspark.llm.decontaminate import words

TOP = 10
BLOCK_TERMS = 200_000  # distinct terms of the queries of one block, each query's counted for itself
BLOCK_DOCS = 16_384
CELLS = 1 << 22  # of a table of documents by terms


def query_blocks(queries: DataFrame, key: str, block_terms: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The queries with their distinct terms, in blocks of about ``block_terms`` terms."""
    bounded_batches(queries.sparkSession)

    def terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(words(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.list_(pa.binary()))], ["id", "terms"])

    asked = queries.select(F.col(key).cast("long").alias("id"), as_bytes()).mapInArrow(terms, "id long, terms array<binary>")
    asked = written(asked.where(F.size("terms") > 0).withColumn("salt", F.xxhash64("id", "terms", F.monotonically_increasing_id())), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, math.ceil(total / block_terms)) if total else 0
    for i in range(n):
        rows = asked.where(F.pmod("salt", F.lit(n)) == i).select("id", "terms").collect()
        yield [(r.id, [bytes(t) for t in r.terms]) for r in rows]


def term_counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms array<int>, tfs array<int>) of the documents with a term: length, and the counts of known terms."""
    bounded_batches(docs.sparkSession)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for b in batches:
            lengths, terms, tfs = [], [], []
            for text in b.column("text").to_pylist():
                own = words(text)
                known = [(number[w], c) for w, c in Counter(own).items() if w in number]
                lengths.append(len(own))
                terms.append([t for t, _ in known])
                tfs.append([c for _, c in known])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(terms, ints), pa.array(tfs, ints)], ["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes())
    return texts.mapInArrow(counted, "doc_id long, n long, terms array<int>, tfs array<int>").where("n > 0")


class Block:
    """The postings of some documents by term: ascending rows of documents and what the term adds to their scores."""

    def __init__(self, ids: np.ndarray, nameless: np.ndarray, owner: np.ndarray, terms: np.ndarray, gains: np.ndarray) -> None:
        self.ids, self.nameless = ids, nameless
        order = np.argsort(terms, kind="stable")
        self.rows, self.gains = owner[order], gains[order]
        names, first = np.unique(terms[order], return_index=True)
        best = np.maximum.reduceat(self.gains, first) if len(first) else first
        ends = np.append(first, len(order))[1:]
        self.of = {int(t): (int(a), int(z), int(m)) for t, a, z, m in zip(names, first, ends, best, strict=True)}

    def masked(self, terms: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, bounds), by descending bound: documents of one presence mask have one bound and follow each other."""
        n = len(self.ids)
        group, bound = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for at in range(0, len(terms), 63):
            part = terms[at : at + 63]
            mask = np.zeros(n, np.int64)
            for bit, (a, z, _) in enumerate(part):
                mask[self.rows[a:z]] |= np.int64(1 << bit)
            masks, of = np.unique(mask, return_inverse=True)
            best = np.array([m for _, _, m in part], np.int64)
            step = max(1, CELLS // len(part))
            gain = np.concatenate([((masks[i : i + step, None] >> np.arange(len(part))) & 1) @ best for i in range(0, len(masks), step)])
            bound += gain[of]
            group = of if at == 0 else np.unique(group * len(masks) + of, return_inverse=True)[1]
        order = np.lexsort((group, -bound))
        order = order[: np.count_nonzero(bound)]
        return order, bound[order]

    def scores(self, docs: np.ndarray, terms: list[tuple[int, int, int]]) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for a, z, _ in terms:
            rows = self.rows[a:z]
            at = np.minimum(np.searchsorted(rows, docs), z - a - 1)
            out += np.where(rows[at] == docs, self.gains[a:z][at], 0)
        return out


class Best:
    """The k best of (score, doc_id) so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.doc, self.nameless = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def floor(self) -> int:
        """What a score must reach to enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, nameless: np.ndarray) -> None:
        score, doc, nameless = np.append(self.score, score), np.append(self.doc, doc), np.append(self.nameless, nameless)
        keep = np.lexsort((doc, nameless, -score))[: self.k]
        keep = keep[score[keep] > 0]
        self.score, self.doc, self.nameless = score[keep], doc[keep], nameless[keep]


def rank_block(block: Block, queries: list[np.ndarray], best: list[Best]) -> None:
    """Brings the best of every query up to date with a block."""
    for terms, top in zip(queries, best, strict=True):
        held = [block.of[t] for t in terms.tolist() if t in block.of]
        if sum(m for _, _, m in held) < top.floor():
            continue
        docs, bound = block.masked(held)
        at, step = 0, top.k
        while at < len(docs) and bound[at] >= top.floor():
            end = int(np.searchsorted(-bound, -bound[min(at + step, len(docs)) - 1], "right"))  # whole masks
            some = docs[at:end]
            top.add(block.scores(some, held), block.ids[some], block.nameless[some])
            at, step = end, 2 * step


def _weights(postings: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term, documents, words of all documents)."""
    n, total = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(size, np.int64)
    for t, df in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weight[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return weight, n, total


def search(docs: DataFrame, queries: DataFrame, key: str = "item_id", k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(``key``, rank, doc_id, score): for each row of ``queries`` (``key``, text) the ``k`` best rows of ``docs`` (doc_id, text).

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))); it adds weight * (10^9 tf div (1000 tf + 8 m)) with
    m = 10 + (90 n N div L). The statistics are those of all documents."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "query long, item long, doc_id long, score long")
    for number, asked in enumerate(query_blocks(queries, key, block_terms)):
        ids: dict[bytes, int] = {}
        coded = [np.array([ids.setdefault(t, len(ids)) for t in terms], np.int32) for _, terms in asked]
        postings = written(term_counts(docs, spark.sparkContext.broadcast(ids)), "term-counts")
        weight, n, total = _weights(postings, len(ids))
        known = spark.sparkContext.broadcast(([item for item, _ in asked], coded, weight))

        def ranked(batches: Iterable[pa.RecordBatch], known=known, n=n, total=total, number=number) -> Iterator[pa.RecordBatch]:
            items, coded, weight = known.value
            best = [Best(k) for _ in coded]
            for b in blocks(batches):
                lengths, terms, tf = b.column("n").to_numpy(), b.column("terms"), b.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
                sizes = terms.combine_chunks().value_lengths().to_numpy()
                term, owner = terms.combine_chunks().flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
                m = 10 + (90 * lengths * n) // total
                doc = b.column("doc_id").combine_chunks()
                gains = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
                rank_block(Block(doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), owner, term, gains), coded, best)
            rows = [(i, j) for i, top in enumerate(best) for j in range(len(top.score))]
            yield pa.RecordBatch.from_pydict({
                "query": pa.array([number * 10_000_000 + i for i, _ in rows], pa.int64()), "item": pa.array([items[i] for i, _ in rows], pa.int64()),
                "doc_id": pa.array([None if best[i].nameless[j] else int(best[i].doc[j]) for i, j in rows], pa.int64()), "score": pa.array([int(best[i].score[j]) for i, j in rows], pa.int64()),
            })

        out = out.unionByName(postings.mapInArrow(ranked, "query long, item long, doc_id long, score long"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return out.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("item").alias(key), "rank", "doc_id", "score")


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches gathered to at least ``BLOCK_DOCS`` rows or 64 MB."""
    some: list[pa.RecordBatch] = []
    for b in batches:
        some.append(b)
        if sum(x.num_rows for x in some) >= BLOCK_DOCS or sum(x.nbytes for x in some) >= 64 << 20:
            yield pa.Table.from_batches(some)
            some = []
    if some:
        yield pa.Table.from_batches(some)
