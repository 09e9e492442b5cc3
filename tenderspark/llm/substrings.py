"""Substring dedup: passages that already start in a document with a smaller id are removed.

The suffixes of all texts that start at anchors are split by variable-length prefixes into groups that fit in memory; each
group becomes a suffix tree, and the internal nodes of depth ``window`` or more with leaves of two documents are the
repeats. Overlapping repeats of a document join to maximal ones.

1. Documents with the same words are one text from the start, owned by the smallest id.
2. A window's anchor is its smallest ``GRAM``-word gram, so neighbouring windows share one and equal windows have theirs at
   the same place. The windows of an anchor travel as one segment: their words, once. A segment has at most
   ``window - GRAM + 1`` windows, however repetitive the text, and equal segments of a document are one.
3. The first prefix of a segment is its anchor's gram. A census drops the prefixes of a single document: below them no
   node has leaves of two. What is left is written, and equal segments of different documents become one, with the
   smallest and the largest id.
4. A prefix whose segments hold more than ``GROUP`` bytes is lengthened: its segments are cut into bands of ``width``
   neighbouring windows, which share ``window - width + 1`` words. That is repeated for the next of ``WIDTHS`` and ends at
   one window: there the prefix is all of it, the node is known, and ids are pre-aggregated without a tree.
5. Each other group is one task's work: words are named exactly, suffixes sorted by doubling, and neighbours in that
   order with ``window`` or more words in common lie below one internal node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import POWERS, as_bytes, bounded_batches, span_hashes, word_hashes, word_spans, written

WINDOW, GRAM, GROUP = 50, 8, 4 << 20
WIDTHS = (11, 3, 1)  # windows of a band, when a prefix is lengthened once, twice, ...
FLUSH_BYTES = 4 << 20
TASK_SEGMENTS = 200_000  # digests that a task remembers, so as to give the words of a segment once
RUNS = "array<struct<first:int,last:int,low:long>>"


def _anchors(g: np.ndarray, n: int) -> np.ndarray:
    """For every n neighbours of ``g`` the place of the first smallest one, by doubling."""
    size, low, at = 1, g, np.arange(len(g))
    while size < n:
        step = min(size, n - size)
        later = low[step:] < low[:-step]
        low, at = np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])
        size += step
    return at


class Words:
    """The words of one UTF-8 text, and its segments by anchor."""

    def __init__(self, raw: bytes) -> None:
        self.raw = np.frombuffer(raw, np.uint8)
        self.starts, self.ends = word_spans(self.raw)
        self.n = len(self.starts)

    def segments(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(prefix key, first window, last window) of each segment of a text of ``window`` words or more."""
        gram = min(GRAM, window)
        pw, ipw = POWERS.upto(self.n + 1)
        wh = word_hashes(self.raw, self.starts, self.ends)
        at = np.arange(self.n - gram + 1)
        grams = span_hashes(wh, at, at + gram, pw, ipw)
        anchor = _anchors(grams, window - gram + 1)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.concatenate((first[1:], [len(anchor)])) - 1
        return grams[anchor[first]], first, last


def _signatures(window: int):
    """doc_id, th, text -> doc_id, th, digest of the word sequence, n_words, the distinct prefix keys of its segments."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, counts, keys = [], [], []
            for t in b.column(2):
                raw = t.as_py() or b""
                w = Words(raw)
                counts.append(w.n)
                if w.n < window:
                    digests.append(b""), keys.append([])
                    continue
                digests.append(hashlib.blake2b(b" ".join(raw.split()), digest_size=16).digest())
                keys.append(np.unique(w.segments(window)[0]).view(np.int64))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "th", "digest", "n_words", "keys"])

    return rows, "doc_id long, th long, digest binary, n_words long, keys array<long>"


def _segments(window: int):
    """doc_id, th, text, shared prefix keys -> one row for each distinct segment of a shared prefix in a text: its digest, the
    windows where it starts in the text, its size, and its words (null where the task gave them before)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for b in batches:
            out: list[tuple] = []
            for doc, th, t, shared in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                raw = t or b""
                key, first, last = Words(raw).segments(window)
                key = key.view(np.int64)
                words, found = raw.split(), {}
                for i in np.flatnonzero(np.isin(key, np.array(shared, np.int64))).tolist():
                    line = b" ".join(words[first[i] : last[i] + window])
                    found.setdefault(line, (int(key[i]), []))[1].append(int(first[i]))
                for line, (k, starts) in found.items():
                    sid = hashlib.blake2b(line, digest_size=16).digest()
                    out.append((doc, th, sid, k, starts, len(line), None if sid in given else line))
                    given.add(sid)
            if len(given) > TASK_SEGMENTS:
                given.clear()
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "th", "sid", "key", "starts", "size", "words"])

    return rows, "doc_id long, th long, sid binary, key long, starts array<int>, size long, words binary"


def _bands(window: int, width: int):
    """sid, place, words, lo, hi -> the bands of ``width`` windows of each segment, counted from its anchor: where a band
    starts in the segment, the key of the words that its windows share, and its words (none for one window: the key says
    all of them)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for sid, place, line, lo, hi in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                words = line.split()
                w = Words(line)
                gram = min(GRAM, window)
                pw, ipw = POWERS.upto(w.n + 1)
                at = np.arange(w.n - gram + 1)
                grams = span_hashes(word_hashes(w.raw, w.starts, w.ends), at, at + gram, pw, ipw)
                anchor = int(_anchors(grams[: window - gram + 1], window - gram + 1)[0])  # all windows of a segment have the same
                last = w.n - window
                for a in {*range(anchor - last - (anchor - last) % width, anchor + 1, width)}:  # windows with a <= anchor - start < a + width
                    start, end = max(0, anchor - a - width + 1), min(last, anchor - a)
                    if start <= end:
                        common = words[anchor - a : anchor - a - width + 1 + window]
                        key = hashlib.blake2b(b"%d %d " % (width, a) + b" ".join(common), digest_size=16).hexdigest()
                        out.append((sid, place + start, key, None if width == 1 else b" ".join(words[start : end + window]), lo, hi))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.binary(), pa.int32(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["sid", "place", "key", "words", "lo", "hi"])

    return rows, "sid binary, place int, key string, words binary, lo long, hi long"


def suffix_tree_repeats(lines: list[bytes], lo: np.ndarray, hi: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, last, low) runs of the windows of segments that lie below an internal node of depth ``window`` or
    more with leaves of two documents; ``low`` is the smallest id below it.

    Suffixes are sorted by doubling: names at depth 2d pair two neighbours at depth d, in the order of their words' names,
    and words are named exactly. Where two neighbours in suffix order have fewer than ``window`` words in common, a deep
    node ends."""
    names: dict[bytes, int] = {}
    split = [x.split() for x in lines]
    size = np.array(list(map(len, split)), np.int64)
    name = np.fromiter((names.setdefault(w, len(names)) for ws in split for w in ws), np.int64, int(size.sum()))
    n, depth, levels = len(name), 1, {1: name}
    while depth * 2 <= window:
        prev = levels[depth]
        pair = prev[: n - 2 * depth + 1] * np.int64(prev.max() + 1) + prev[depth : n - depth + 1] if n >= 2 * depth else np.zeros(0, np.int64)
        levels[2 * depth] = np.unique(pair, return_inverse=True)[1]
        depth *= 2
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    seg = np.repeat(np.arange(len(lines)), size)
    place = np.arange(n) - start[seg]
    suffix = np.flatnonzero(place + window <= size[seg])
    if not len(suffix):
        return (np.zeros(0, np.int64),) * 4
    top = levels[depth]
    order = suffix[np.lexsort((top[suffix + window - depth], top[suffix]))]
    a, b = order[:-1], order[1:]
    together = (top[a] == top[b]) & (top[a + window - depth] == top[b + window - depth])  # ``window`` words in common
    edge = np.concatenate(([0], np.flatnonzero(~together) + 1))
    low, high = np.minimum.reduceat(lo[seg[order]], edge), np.maximum.reduceat(hi[seg[order]], edge)
    node = np.repeat(np.arange(len(edge)), np.diff(np.concatenate((edge, [len(order)]))))
    deep = low[node] < high[node]
    s, p, v = seg[order][deep], place[order][deep], low[node][deep]
    back = np.lexsort((p, s))
    s, p, v = s[back], p[back], v[back]
    if not len(s):
        return s, p, p, v
    new = np.flatnonzero(np.concatenate(([True], (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1) | (v[1:] != v[:-1]))))
    return s[new], p[new], p[np.concatenate((new[1:], [len(s)])) - 1], v[new]


def _trees(window: int):
    """sid, place, key, words, lo, hi, sorted by key -> sid, first, last, low: the deep nodes' windows, by segment."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(part: list[tuple]) -> pa.RecordBatch:
            s, a, z, low = suffix_tree_repeats([r[3] for r in part], np.array([r[4] for r in part], np.int64), np.array([r[5] for r in part], np.int64), window)
            place = np.array([r[1] for r in part], np.int64)[s]
            return pa.record_batch([pa.array([part[i][0] for i in s.tolist()], pa.binary()), pa.array((a + place).astype(np.int32)), pa.array((z + place).astype(np.int32)), pa.array(low, pa.int64())], names=["sid", "first", "last", "low"])

        for b in batches:
            fresh = list(zip(*(b.column(i).to_pylist() for i in range(6)), strict=True))
            held += fresh
            size += sum(len(r[3]) for r in fresh)
            if size >= FLUSH_BYTES and held[0][2] != held[-1][2]:
                cut = len(held)
                while held[cut - 1][2] == held[-1][2]:
                    cut -= 1
                yield flush(held[:cut])
                held = held[cut:]
                size = sum(len(r[3]) for r in held)
        if held:
            yield flush(held)

    return rows, "sid binary, first int, last int, low long"


def _removed(window: int, with_text: bool):
    """doc_id, text, starts of segments with the runs of removed windows in them, whether another id owns the text -> the
    result row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, marks, copied in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                words = (t or b"").split()
                gone = np.zeros(len(words) + 1, np.int64)
                if copied:
                    gone[0], gone[-1] = 1, -1
                for m in marks or []:
                    for r in m["runs"]:
                        at = np.array(m["starts"], np.int64)
                        np.add.at(gone, at + r["first"], 1)
                        np.add.at(gone, at + r["last"] + window, -1)
                out_of = np.cumsum(gone)[:-1] > 0
                kept = [w for w, g in zip(words, out_of.tolist(), strict=True) if not g] if out_of.any() else words
                line = b" ".join(kept)
                out.append((len(words), int(out_of.sum()), line.decode("utf-8", "replace") if with_text else hashlib.sha256(line).hexdigest()))
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.record_batch([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept" if with_text else "kept_sha256"])

    return rows, f"doc_id long, n_words long, n_removed long, {'kept' if with_text else 'kept_sha256'} string"


def census_of(segments: DataFrame, group: int) -> DataFrame:
    """``segments`` (key, size, lo, hi) -> the keys of two documents or more, and whether their segments exceed ``group`` bytes."""
    of = segments.groupBy("key").agg(F.sum("size").alias("size"), F.min("lo").alias("a"), F.max("hi").alias("b")).where("a < b")
    return written(of.select("key", (F.col("size") > group).alias("long")), "prefixes")


def grouped(segments: DataFrame, census: DataFrame, group: int, window: int) -> tuple[list[DataFrame], DataFrame | None]:
    """``segments`` (sid, place, key, words, lo, hi) and the census of their keys -> the tables of segments whose groups, by
    key, hold at most ``group`` bytes, one for each length of prefix; and of what is left the windows (sid, place, key,
    lo, hi), keyed by all their words."""
    fitting = []
    for width in (w for w in WIDTHS if w == 1 or w < window - min(GRAM, window) + 1):
        fitting.append(segments.join(census.where("not long").select("key"), "key").select("sid", "place", "key", "words", "lo", "hi"))
        if not census.where("long").limit(1).count():
            return fitting, None
        f, schema = _bands(window, width)
        segments = written(segments.join(census.where("long").select("key"), "key").select("sid", "place", "words", "lo", "hi").mapInArrow(f, schema), "bands")
        if width > 1:
            census = census_of(segments.withColumn("size", F.length("words").cast("long")), group)
    return fitting, segments.select("sid", "place", "key", "lo", "hi")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, group: int = GROUP, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and ``kept`` (the words left, joined by one space), or
    ``kept_sha256`` of it. Removed is each word covered by a window of ``window`` words whose sequence also starts in
    a row with a smaller doc_id; windows are judged on the input. ``group`` bounds the bytes of a group of segments.

    Null, empty and shorter texts keep everything. Repeats within one document or between rows of the same id stay.
    Rows with a null id neither lose words nor own any. Only the two named columns are read, so others may have any
    name; an empty table gives an empty result. Texts of any length are read whole.
    """
    bounded_batches(docs.sparkSession)
    row = ["doc_id", "th"]  # an id and its text's hash name a row; rows equal in both share their marks
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), as_bytes(text_col).alias("text"))
    f, schema = _signatures(window)
    sig = written(given.where("doc_id is not null").mapInArrow(f, schema), "signatures").where(F.col("n_words") >= window)
    owner = sig.groupBy("digest").agg(F.min("doc_id").alias("owner"))
    owned = written(sig.join(owner, "digest").select(*row, (F.col("doc_id") > F.col("owner")).alias("copied"), F.when(F.col("doc_id") == F.col("owner"), F.col("keys")).alias("keys")), "owned")
    places = owned.where("keys is not null").select(*row, F.explode("keys").alias("key"))
    census = places.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("key")
    shared = places.join(census, "key").groupBy(*row).agg(F.collect_set("key").alias("shared"))
    f, schema = _segments(window)
    members = written(given.join(shared, row).select(*row, "text", "shared").mapInArrow(f, schema), "segments")
    one = lambda c: members.groupBy("sid").agg(F.any_value("key").cast("string").alias("key"), F.max(c).alias(c), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    fitting, windows = grouped(one("words").withColumn("place", F.lit(0)), census_of(one("size"), group), group, window)
    f, schema = _trees(window)
    found = [x.repartition("key").sortWithinPartitions("key").mapInArrow(f, schema) for x in fitting]
    if windows is not None:
        node = windows.groupBy("key").agg(F.min("lo").alias("low"), F.max("hi").alias("high")).where("low < high").select("key", "low")
        found.append(windows.join(node, "key").select("sid", F.col("place").alias("first"), F.col("place").alias("last"), "low"))
    repeats = found[0]
    for more in found[1:]:
        repeats = repeats.union(more)
    runs = repeats.groupBy("sid").agg(F.collect_list(F.struct("first", "last", "low")).alias("runs"))
    mine = F.filter("runs", lambda r: r["low"] < F.col("doc_id"))
    marked = members.select(*row, "sid", "starts").join(runs, "sid").select(*row, F.struct("starts", mine.cast(RUNS).alias("runs")).alias("marks")).where(F.size("marks.runs") > 0)
    marks = owned.where("copied").select(*row, "copied").distinct().join(marked.groupBy(*row).agg(F.collect_list("marks").alias("marks")), row, "full")
    f, schema = _removed(window, with_text)
    return given.join(marks, row, "left").select("doc_id", "text", "marks", "copied").mapInArrow(f, schema)
