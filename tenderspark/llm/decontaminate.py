"""Benchmark decontamination with a broadcast set of n-gram hashes of the benchmark.

Items are cut into overlapping pieces and the pieces dealt into blocks of at most about ``BLOCK_WINDOWS`` windows; one block
at a time is gathered and broadcast as arrays, so what the driver and a task hold is bounded whatever the size of the
benchmark or of one item. In a scan only runs of benchmark words are hashed, hits in the hash set are verified word by
word. A benchmark of one block costs one narrow pass. With more, each block is a narrow pass that gives the hits alone,
and the hits join the corpus once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import POWERS, as_bytes, bounded_batches, lean, mix, span_hashes, written

WINDOW = 13
BLOCK_WINDOWS, PIECE_WORDS = 1_000_000, 20_000
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if (b in _WORD or 0x41 <= b <= 0x5A) else 0x20 for b in range(256))


def words(raw: bytes | None) -> list[bytes]:
    """The normalised words of a UTF-8 text: runs of digits, letters and non-ASCII bytes, A-Z lower-cased."""
    return (raw or b"").translate(_FOLD).split()


class WindowSet:
    """The windows of a block of benchmark pieces as arrays: by length, the sorted hashes, and for each the place of its
    words and its item."""

    def __init__(self, pieces: list[tuple[int | None, list[bytes]]], window: int) -> None:
        self.ids: dict[bytes, int] = {}
        self.items = [item for item, _ in pieces]
        coded = [np.fromiter((self.ids.setdefault(w, len(self.ids)) for w in ws), np.int32, len(ws)) for _, ws in pieces]
        self.words = np.concatenate([np.zeros(0, np.int32), *coded])
        self.code = mix(np.arange(1, len(self.ids) + 1, dtype=np.uint64))
        start, found = 0, {}
        for k, c in enumerate(coded):
            n = min(window, len(c))
            if n:
                h = self.hashes(c, n)
                found.setdefault(n, []).append((h, np.arange(start, start + len(h)), np.full(len(h), k)))
            start += len(c)
        self.sets = {}
        for n, parts in found.items():
            h, at, owner = (np.concatenate([p[i] for p in parts]) for i in range(3))
            order = np.lexsort((owner, h))
            once = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])))  # of a gram that an item repeats, one
            self.sets[n] = (h[order][once], at[order][once], owner[order][once])

    def hashes(self, codes: np.ndarray, n: int) -> np.ndarray:
        pw, ipw = POWERS.upto(len(codes) + 1)
        at = np.arange(len(codes) - n + 1)
        return span_hashes(self.code[codes], at, at + n, pw, ipw)

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The (first word, words) of every occurring window, and the items with one."""
        hits: list[tuple[int, int]] = []
        owners: set[int] = set()
        get = self.ids.get
        codes = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        known = np.concatenate(([0], np.cumsum(codes >= 0)))
        for n, (hashes, places, owner) in self.sets.items():
            if len(ws) < n or known[-1] < n:
                continue
            full = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(full):
                continue
            pw, ipw = POWERS.upto(len(ws) + 1)
            h = span_hashes(self.code[np.maximum(codes, 0)], full, full + n, pw, ipw)
            met = np.flatnonzero(hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h)
            seen: dict[tuple[int, bytes], bool] = {}
            for p, x in zip(full[met].tolist(), h[met], strict=True):
                gram = codes[p : p + n].astype(np.int32)
                key = (int(x), gram.tobytes())
                if key not in seen:
                    lo, hi = np.searchsorted(hashes, x), np.searchsorted(hashes, x, side="right")
                    same = (self.words[places[lo:hi, None] + np.arange(n)] == gram).all(axis=1)
                    seen[key] = bool(same.any())
                    owners.update(owner[lo:hi][same].tolist())
                if seen[key]:
                    hits.append((p, n))
        return hits, {self.items[k] for k in owners}


def pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int, size: int = PIECE_WORDS) -> DataFrame:
    """(item, piece, n, words): the words of every item, joined by spaces, in pieces of ``size`` windows at most; two
    neighbours share ``window`` - 1 words, so that each window of the item is in one."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words(t)
                for k, i in enumerate(range(0, max(1, len(ws) - window + 1), size) if ws else ()):
                    part = ws[i : i + size + window - 1]
                    out.append((item, k, len(part), b" ".join(part)))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["item", "piece", "n", "words"])

    return benchmark.select(F.col(item_col).cast("long").alias("item"), as_bytes(text_col)).mapInArrow(lean(rows), "item long, piece int, n long, words binary")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, with_text: bool = False, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items array<long> (sorted, distinct), n_items and
    ``contaminated`` (some word hit, and at least one in twenty of the words).

    A word is hit if it lies in any occurrence of a window of ``window`` item words; a shorter item is one window of
    all its words, one without words has none. Null and empty texts have no words and are clean. Items with a null id
    mark words but are not listed. Repeated documents and items count each on its own; an empty benchmark hits
    nothing. ``with_text`` adds ``cleaned``: the text without the spans of hit words, from the first byte of each to
    the last; ``carry`` adds the whole input row as the struct ``_row``, so columns of both tables may have any name.
    Texts and items of any length are read whole.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = as_bytes(text_col).alias("text")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), text, *([F.struct("*").alias("_row")] if carry else []))
    row = f", _row {given.schema['_row'].dataType.simpleString()}" if carry else ""
    final = "doc_id long, n_words long, n_hit long, items array<long>, contaminated boolean" + ", cleaned string" * with_text + row
    cut = written(pieces(benchmark, item_col, item_text_col, window, min(PIECE_WORDS, block_windows)).distinct(), "benchmark")
    total = cut.agg(F.sum("n")).first()[0] or 0
    n = max(1, -(-total // block_windows))
    dealt = [cut.where(F.pmod(F.xxhash64("item", "piece", "words"), F.lit(n)) == i) for i in range(n)]
    gathered = lambda block: spark.sparkContext.broadcast(WindowSet([(r.item, bytes(r.words).split()) for r in block.select("item", "words").collect()], window))
    if n == 1:
        return given.mapInArrow(lean(_scan(gathered(dealt[0]), with_text)), final).withColumn("n_items", F.size("items").cast("long"))
    named = lambda df: df.withColumn("_th", F.xxhash64("text"))
    found = None
    for block in dealt:
        shared = gathered(block)
        part = written(named(given).select("doc_id", "text", "_th").mapInArrow(lean(_hits(shared)), "doc_id long, _th long, hits array<struct<at:int,n:int>>, items array<long>"), "hits")
        shared.destroy()
        found = part if found is None else found.union(part)
    merged = found.groupBy(F.col("doc_id").alias("_id"), "_th").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    left, right = named(given), merged.withColumnRenamed("_th", "_th2")
    both = left.join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_th2")), "left")
    out = both.select("doc_id", "text", *(["_row"] if carry else []), "hits", "items")
    return out.mapInArrow(lean(_scan(None, with_text)), final).withColumn("n_items", F.size("items").cast("long"))


def _hits(windows):
    """doc_id, text, text hash -> of the texts with a hit: id, text hash, occurring windows, items."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t, th in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                hits, items = windows.value.scan(words(t))
                if hits:
                    out.append((i, th, [{"at": p, "n": n} for p, n in hits], sorted(x for x in items if x is not None)))
            cols = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "_th", "hits", "items"])

    return rows


def _scan(windows, with_text: bool):
    """doc_id, text, maybe the row -> the result: by the windows of the one block, or (None) by the hits of all blocks, which
    are the last two columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, last = [], b.num_columns - (0 if windows else 2)
            known = zip(b.column(last).to_pylist(), b.column(last + 1).to_pylist(), strict=True) if windows is None else None
            for t in b.column(1).to_pylist():
                ws = words(t)
                if windows is None:
                    hits, items = next(known)
                    hits, items = [(h["at"], h["n"]) for h in hits or []], items or []
                else:
                    hits, items = windows.value.scan(ws)
                edge = np.zeros(len(ws) + 1, np.int64)
                for p, n in hits:
                    edge[p] += 1
                    edge[p + n] -= 1
                hit = np.cumsum(edge)[:-1] > 0
                n = int(hit.sum())
                out.append((len(ws), n, sorted(x for x in items if x is not None), 20 * n >= len(ws) and n > 0, *([cleaned(t, hit)] if with_text else [])))
            kinds = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("contaminated", pa.bool_()), *([("cleaned", pa.string())] if with_text else [])]
            cols = list(zip(*out, strict=True)) or [()] * len(kinds)
            carried = [b.column(i) for i in range(2, last)]
            yield pa.record_batch([b.column(0), *[pa.array(c, k) for c, (_, k) in zip(cols, kinds, strict=True)], *carried], names=["doc_id", *[n for n, _ in kinds], *["_row" for _ in carried]])

    return rows


def cleaned(raw: bytes | None, hit: np.ndarray) -> str | None:
    """The text without its runs of hit words; null stays null."""
    if raw is None or not hit.any():
        return None if raw is None else raw.decode("utf-8", "replace")
    flat = np.frombuffer(raw.translate(_FOLD), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flat.astype(np.int8), [0]))))
    starts, ends = edge[0::2], edge[1::2]
    run = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    out, last = [], 0
    for a, b in zip(np.flatnonzero(run == 1).tolist(), np.flatnonzero(run == -1).tolist(), strict=True):
        out.append(raw[last : starts[a]])
        last = ends[b - 1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "replace")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, each judged on its own where it lies."""
    return contamination(docs, benchmark, id_col, text_col, carry=True, **params).where("not contaminated").select("_row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """All rows of ``docs`` with the spans of hit words cut out of ``text_col``."""
    found = contamination(docs, benchmark, id_col, text_col, with_text=True, carry=True, **params)
    return found.select(*[F.col("cleaned").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
