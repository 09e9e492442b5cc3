"""Near-duplicate documents by SimHash fingerprints and covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are found without false negatives: bit ``i`` of a fingerprint owns the vector
m(i), one of the 2**(radius+1) - 1 non-zero vectors of F2**(radius+1), dealt in turn; table ``v`` keeps the bits with
odd <m(i), v>. Any ``radius`` bits span at most ``radius`` dimensions, so some non-zero v is orthogonal to all of them
and both fingerprints of the pair share table v's key (Pagh 2016).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import as_bytes, bounded_batches, lean, mix, written
from tenderspark.llm.components import connected_components

BITS = 64
WORDS = 5  # of a shingle, where Jaccard similarity counts
BANDS, ROWS = 24, 4
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CELL = 256  # members of a block of a bucket of similar texts
SMALL = 48  # buckets up to this size are compared together, by lags; larger ones one at a time


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2**(radius+1) - 1 bit masks; any two words within ``radius`` bits agree on one of them."""
    top = 1 << (radius + 1)
    owner = [1 + i % (top - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (owner[i] & v).bit_count() % 2) for v in range(1, top)]


def shingle_hashes(raw: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words of a UTF-8 text, A-Z lower-cased; a shorter text is one run."""
    words = (raw or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    norm = b" ".join(words)
    if len(words) <= shingle:
        grams = [norm]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
        starts = np.concatenate(([0], ends[:-1] + 1))
        grams = [norm[s:e] for s, e in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), grams), "<u8", len(grams))


def fingerprint(raw: bytes | None, shingle: int) -> int:
    """The SimHash of the ``shingle``-word shingles of a UTF-8 text, A-Z lower-cased; no word gives zero."""
    h = shingle_hashes(raw, shingle)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 15):
        ones += np.unpackbits(h[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp long) of every row; only the two named columns are read."""
    bounded_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col)).mapInArrow(lean(rows), "doc_id long, fp long")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0..n-1 reaches over the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(up := root[root], root):
            root = up
        if (root[a] == root[b]).all():
            break
    return root


def _grown(fp: np.ndarray, radius: int) -> np.ndarray:
    """Roots within one large bucket. A frontier of linked members is compared with the members not yet reached only,
    so a dense group is left after a few passes and its links are never listed pair by pair."""
    root, left = np.arange(len(fp)), np.arange(len(fp))
    while len(left):
        seed, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            step = max(1, (1 << 22) // len(left))
            part, front = front[:step], front[step:]
            near = (np.bitwise_count(fp[left][:, None] ^ fp[part][None, :]) <= radius).any(axis=1)
            root[left[near]] = seed
            front, left = np.concatenate((front, left[near])), left[~near]
    return root


def _links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of links (member, root) that joins exactly what links within the buckets join; ``key`` is sorted."""
    start = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
    size = np.diff(np.concatenate((start, [len(key)])))
    of = np.repeat(size, size)
    out_a, out_b = [], []
    at = np.flatnonzero((of > 1) & (of <= SMALL))
    if len(at):
        bucket, f = np.repeat(start, size)[at], fp[at]
        pairs = []
        for lag in range(1, int(size[size <= SMALL].max())):
            hit = np.flatnonzero((bucket[lag:] == bucket[:-lag]) & (np.bitwise_count(f[lag:] ^ f[:-lag]) <= radius))
            pairs.append((hit, hit + lag))
        a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        root = _roots(len(at), a, b)
        out_a.append(rep[at]), out_b.append(rep[at][root])
    for s, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
        out_a.append(rep[s : s + n]), out_b.append(rep[s : s + n][_grown(fp[s : s + n], radius)])
    if not out_a:
        return rep[:0], rep[:0]
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    return a[a != b], b[a != b]


def fingerprint_links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """``nodes`` (fp long, rep long; fp unique, rep unique) -> edges (a long, b long) between reps, whose components
    are those of all pairs within ``radius`` bits.

    Each node goes to one bucket of every covering table. A bucket holds distinct fingerprints that agree on about
    half the bits, and a dense group of those within the radius of one another is bounded by C(64, <= radius).
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    rows = nodes.select("fp", "rep", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)])).alias("x")).select("x.t", "x.k", "fp", "rep")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(x: np.ndarray) -> pa.RecordBatch:
            a, b = _links(x[:, :2], x[:, 2].view(np.uint64), x[:, 3], radius)
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[np.ndarray] = []
        count = 0
        for batch in batches:
            held.append(np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]))
            count += batch.num_rows
            if count >= 200_000:
                x = np.concatenate(held)
                cut = len(x) - int(np.argmin((x[::-1, :2] == x[-1, :2]).all(axis=1))) if (x[0, :2] != x[-1, :2]).any() else 0
                if cut:
                    yield flush(x[:cut])
                held, count = [x[cut:]], 0
        if held and sum(map(len, held)):
            yield flush(np.concatenate(held))

    return rows.repartition("t", "k").sortWithinPartitions("t", "k").mapInArrow(lean(found), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """Every row's fingerprint and component: (doc_id, fingerprint string, component_id long).

    ``component_id`` is the smallest doc_id reachable over links of ``radius`` bits or fewer. Null, empty and
    white-space texts have no words: fingerprint zero, linked like any other. Rows with the same doc_id each get a
    row; a null doc_id never names a component, and is null where a component has no other. Equal fingerprints are
    one node from the start, so a group of exact copies costs one row per table. Columns other than the two named
    are not read. An empty table gives an empty result.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    # ids that may be shared by rows of different fingerprints would merge them, so nodes are numbered by fingerprint
    comp = connected_components(fingerprint_links(nodes.select("fp", F.col("fp").alias("rep")), radius))
    of = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    low = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = of.join(low, "component").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_text(text_col: str) -> Column:
    """Names a text; null and empty ones are the same."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, similarity: float | None = None) -> DataFrame:
    """``docs`` with one row for each component, that of the smallest id; all columns kept.

    Components are those of ``near_duplicates``, joined by every pair that ``similar_links`` finds if ``similarity`` is
    given. Rows are told apart by id and text: of rows equal in both one stays, of rows with one id only those of
    the component that has no smaller id. Of the rows with a null id one stays for each component, besides the
    smallest id.
    """
    id_ = F.col(id_col).cast("long")
    rows = written(sketches(docs, id_col, text_col, shingle, similarity is not None), "sketches")
    fps = rows.groupBy("fp").agg(F.min("th").alias("rep"))
    nodes = written(fps, "nodes")
    comp = connected_components(fingerprint_links(nodes.select("fp", F.col("fp").alias("rep")), radius))
    grouped = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", F.coalesce("component", "fp").alias("component"))
    if similarity is not None:
        texts = rows.groupBy("th", "fp").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
        known = written(texts.join(grouped, "fp").select("th", "n", "bands", F.col("component").alias("part")), "parts")
        links = similar_links(known, docs.select(row_text(text_col).alias("th"), as_bytes(text_col)), similarity)
        grown = connected_components(links)
        grouped = grouped.join(grown, grouped.component == grown.node, "left").select("fp", F.coalesce(grown.component, grouped.component).alias("component"))
    counts = rows.groupBy("doc_id", "th", "fp").agg(F.count(F.lit(1)).alias("n")).join(grouped, "fp")
    best = counts.groupBy("component", F.col("doc_id").isNull()).agg(F.min(F.struct("doc_id", "th", "n")).alias("w"))
    best = written(best.select(F.col("w.doc_id").alias("_id"), F.col("w.th").alias("_th"), F.col("w.n").alias("_n")), "kept-rows")
    of = lambda kept: docs.join(kept, id_.eqNullSafe(F.col("_id")) & (row_text(text_col) == F.col("_th")))
    again = of(best.where("_n > 1")).groupBy("_id", "_th").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row"))
    return of(best.where("_n = 1")).select(*docs.columns).union(again.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))


def band_keys(h: np.ndarray) -> np.ndarray:
    """One key for each band of ``ROWS`` MinHash values; sets of similarity j share a given one with chance j**ROWS."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 2048):
        np.minimum(low, (h[i : i + 2048, None] * _FACTORS).min(axis=0), out=low)
    key = np.zeros(BANDS, np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        key = mix(key + column)
    return key


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: bool) -> DataFrame:
    """(doc_id, th, fp, n, bands) of every row: text hash, fingerprint, and of the distinct shingles of ``WORDS`` words
    their number and band keys (none if not asked for, or without words)."""
    bounded_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raws = [t.as_py() for t in b.column(2)]
            fps = np.fromiter((fingerprint(t, shingle) for t in raws), np.uint64, b.num_rows)
            sets = [np.unique(shingle_hashes(t, WORDS)) if bands else np.zeros(0, np.uint64) for t in raws]
            keys = pa.array([band_keys(h).view(np.int64) if len(h) else [] for h in sets], pa.list_(pa.int64()))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps.view(np.int64)), pa.array(list(map(len, sets)), pa.int64()), keys], names=["doc_id", "th", "fp", "n", "bands"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_text(text_col).alias("th"), as_bytes(text_col))
    return given.mapInArrow(lean(rows), "doc_id long, th long, fp long, n long, bands array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(th, h array<long>): the sorted distinct hashes of the shingles of ``WORDS`` words of ``texts`` (th, text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.unique(shingle_hashes(t.as_py(), WORDS)).view(np.int64) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["th", "h"])

    return texts.mapInArrow(lean(rows), "th long, h array<long>")


def alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets have that Jaccard similarity or more."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)) - 1e-9:
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return same >= similarity * (len(x) + len(y) - same) - 1e-9


def arrays(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """The lists of a column as arrays, without copies."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))
    return [flat[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]


def similar_to_heads(stars: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of ``stars`` (a, b, pa, pb; texts are named by th) the (pa, pb) of texts of that similarity."""
    both = stars.join(sets.select(F.col("th").alias("b"), F.col("h").alias("hb")), "b").join(sets.select(F.col("th").alias("a"), F.col("h").alias("ha")), "a")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [alike(x, y, similarity) for x, y in zip(arrays(b.column(2)), arrays(b.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("pa", "pb", "ha", "hb").mapInArrow(lean(found), "a long, b long").distinct()


def bucket_cells(left: DataFrame) -> DataFrame:
    """(t, k, kind, i, j, th, part, now, main, block): the members of mixed buckets, dealt into cells of at most about twice
    ``CELL`` so that any two of a bucket whose parts (``now``) differ meet in one.

    A bucket's largest part is cut into blocks, all others together into others. Blocks of others meet one another and those of the
    largest part; two blocks of that one never meet, so a large group with a few strangers costs one row for each member."""
    size = left.groupBy("t", "k", "now").agg(F.count(F.lit(1)).alias("_c"))
    size = size.groupBy("t", "k").agg(F.max_by("now", F.struct("_c", "now")).alias("_main"), F.max("_c").alias("_m"), F.sum("_c").alias("_all"))
    blocks = lambda n: F.greatest(F.ceil(n / CELL), F.lit(1)).cast("int")
    rows = left.join(size, ["t", "k"]).withColumn("main", F.col("now") == F.col("_main"))
    rows = rows.withColumn("_nm", blocks(F.col("_m"))).withColumn("_no", blocks(F.col("_all") - F.col("_m")))
    own = F.pmod(F.xxhash64("th"), F.when(F.col("main"), F.col("_nm")).otherwise(F.col("_no"))).cast("int")
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    mine = F.transform(upto("_no"), lambda x: cell("main", x, F.col("_own")))
    theirs = F.concat(F.transform(upto("_nm"), lambda x: cell("main", F.col("_own"), x)), F.transform(upto("_no"), lambda x: cell("others", F.least(x, F.col("_own")), F.greatest(x, F.col("_own")))))
    dealt = rows.withColumn("_own", own).withColumn("_cell", F.explode(F.when(F.col("main"), mine).otherwise(theirs)))
    return dealt.select("t", "k", "_cell.*", "th", "part", "now", "main", F.col("_own").alias("block"))


def similar_in_cells(cells: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the parts of texts of a cell that have that similarity; pairs are compared where they meet and only
    until their parts are joined."""

    def found(cell: pa.Table) -> pa.Table:
        hs, part = arrays(cell.column("h")), cell.column("part").to_numpy()
        now, main = cell.column("now").to_numpy(), cell.column("main").to_numpy(zero_copy_only=False)
        among, block = cell.column("kind")[0].as_py() == "others", cell.column("block").to_numpy()
        alone = cell.column("i")[0].as_py() == cell.column("j")[0].as_py()
        group = {x: x for x in now.tolist()}

        def root(x: int) -> int:
            while group[x] != x:
                x = group[x]
            return x

        links = []
        for x in np.flatnonzero(~main).tolist():
            for y in range(x + 1, len(hs)) if among else np.flatnonzero(main).tolist():
                p, q = root(int(now[x])), root(int(now[y]))
                if among and not alone and block[x] == block[y]:
                    continue  # they meet in a cell of their own block
                if p != q and alike(hs[x], hs[y], similarity):
                    group[max(p, q)] = min(p, q)
                    links.append((int(part[x]), int(part[y])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    keys = ["t", "k", "kind", "i", "j"]
    return cells.join(sets, "th").groupBy(*keys).applyInArrow(found, "a long, b long").distinct()


def similar_links(known: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``known`` (th, n, bands, part) and ``texts`` (th, text) -> links (a, b) between parts that hold a pair of texts of
    that Jaccard similarity or more on shingles of ``WORDS`` words.

    Candidates share a band: at 0.8 a pair shares none with chance (1 - 0.8**4)**24 = 3.2e-6. Each is verified on the
    whole shingle sets, which are made once. First every member of a bucket is compared with one, so dense groups become one
    part; members that are still in different parts then meet in cells of bounded size. No pair is written before it is verified,
    and no bucket is cut, however large.
    """
    members = known.select("th", "n", "part", F.posexplode("bands").alias("t", "k"))
    mixed = members.groupBy("t", "k").agg(F.min(F.struct("th", "n", "part")).alias("head"), F.min("part").alias("p"), F.max("part").alias("q")).where("p != q").select("t", "k", "head")
    members = written(members.join(mixed, ["t", "k"]), "bands")
    asked = members.select("th").distinct()
    sets = written(shingle_sets(texts.join(asked, "th", "left_semi").dropDuplicates(["th"])), "shingle-sets")
    fits = F.least("head.n", "n") >= similarity * F.greatest("head.n", "n") - 1e-9
    stars = members.where((F.col("head.part") != F.col("part")) & fits)
    stars = stars.select(F.col("th").alias("a"), F.col("head.th").alias("b"), F.col("part").alias("pa"), F.col("head.part").alias("pb")).distinct()
    first = written(similar_to_heads(stars, sets, similarity), "similar")
    grown = connected_components(first)
    left = members.join(grown, members.part == grown.node, "left").select("t", "k", "th", "part", F.coalesce("component", "part").alias("now"))
    mixed = left.groupBy("t", "k").agg(F.min("now").alias("p"), F.max("now").alias("q")).where("p != q").select("t", "k")
    left = written(left.join(mixed, ["t", "k"]), "bands-left")
    return first.union(similar_in_cells(bucket_cells(left), sets, similarity))
