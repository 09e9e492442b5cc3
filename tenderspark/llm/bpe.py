"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of its last eight bytes has its top bits zero, so that copied passages give the same
chunks wherever they stand. Rows are brought together by their smallest chunk: texts that share chunks - copies, near
copies, texts of one passage - meet in one task, next to one another, and a chunk is encoded once there and kept in a
bounded memory. What is encoded of a chunk is its body, from its first to its last safe boundary; of that, the library is
asked for the pieces between safe boundaries that the worker does not remember. The piece between
two bodies, which holds the words that the cut splits, is repaired: it is encoded together with words of both
neighbours, and the window widens until its outer tokens agree exactly with those of the bodies; a text that never
agrees is encoded whole.

A safe boundary is a single space between two printable ASCII characters, the second a letter or digit. Whether tokens
never reach across it depends on the vocabulary; ``ChunkEncoder`` probes it and refuses one that fails.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import KEPT, as_bytes, bounded_batches

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
CHUNK_BITS = 10  # chunks of about 1 KiB
MEMORY_IDS = 2_000_000  # ids that a worker keeps
WIDEST = 64  # words of each neighbour that a join is tried with
BATCH_TEXT = 4 << 20
SAMPLED, LEAST_SEEN, HOT = 64, 8, 1000  # of hot_keys
WORD_MEMORY, LONG_PIECE = 150_000, 256  # pieces of each of two generations; longer ones are not remembered
_SAFE = re.compile(rb"(?<=[!-~]) (?=[0-9A-Za-z])")
_CUT = re.compile(rb"(?<=[!-~])(?= [0-9A-Za-z])")
PROBES = ["some words, and a few-more of them: 3 x 42 'tis it's we'll END", "a b", "x. y", "éa b é c", "1 2 3", "ab cd  ef\n gh", "#tag (paren) \"q w\" <|endoftext|> z"]


def cuts(raw: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks of ``raw``: where the hash of the eight bytes before is zero in its top ``bits`` bits."""
    if len(raw) < 16:
        return [len(raw)]
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    w2 = b[:-1] | b[1:] << np.uint64(8)
    w4 = w2[:-2] | w2[2:] << np.uint64(16)
    w8 = w4[:-4] | w4[4:] << np.uint64(32)
    at = np.flatnonzero((w8 * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) == 0) + 8
    return [*at[at < len(raw)].tolist(), len(raw)]


def digest(piece: bytes) -> bytes:
    return hashlib.blake2b(piece, digest_size=16).digest()


def meeting_key(raw: bytes, bits: int = CHUNK_BITS) -> int:
    """The smallest chunk's digest as a number: texts with the same chunks have the same, texts that share a part of
    their chunks have the same with that chance."""
    low, start = b"\xff" * 16, 0
    for end in cuts(raw, bits):
        low = min(low, digest(raw[start:end]))
        start = end
    return int.from_bytes(low[:8], "big", signed=True)


class Coded(NamedTuple):
    """Ids, the ids as text, and their decode where decodes of parts can be joined (else empty)."""

    ids: list[int] | np.ndarray
    line: str
    decoded: str


class Memory:
    """What chunk bodies are coded as by digest, the least recently used going first when more than ``most`` ids are kept."""

    def __init__(self, most: int) -> None:
        self.most, self.size, self.kept = most, 0, OrderedDict()

    def find(self, key: bytes) -> Coded | None:
        if (got := self.kept.get(key)) is not None:
            self.kept.move_to_end(key)
        return got

    def keep(self, key: bytes, found: Coded) -> None:
        self.kept[key] = found._replace(ids=found.ids.copy())  # not a view of the whole batch
        self.size += len(found.ids) + 16
        while self.size > self.most and self.kept:
            self.size -= len(self.kept.popitem(last=False)[1].ids) + 16


class ChunkEncoder:
    """Encodes whole UTF-8 texts to ids; ``asked`` and ``encoded`` count the bytes of chunk bodies met and encoded."""

    def __init__(self, path: str, bits: int = CHUNK_BITS) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.bits, self.memory, self.words, self.old = bits, Memory(MEMORY_IDS), {}, {}
        self.spaced = self.tok.decoder is None and "" not in self.tok.get_vocab()  # then a decode is the tokens, joined by spaces
        self.asked = self.encoded = self.widened = self.whole = 0
        self.drops = all(list(chain.from_iterable(self.library(p.encode().split()))) == self.library([p.encode()])[0] for p in PROBES)  # white space
        if not self.safe(path):
            raise ValueError(f"tokens of {path} may reach across a space between words; such a vocabulary can't be encoded in chunks")

    def safe(self, path: str) -> bool:
        """Whether texts cut at safe boundaries give the ids of the whole, on ``PROBES``; and no added token takes in
        white space."""
        for t in json.loads(Path(path).read_text(encoding="utf-8")).get("added_tokens", []):
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]):
                return False
        for probe in PROBES:
            raw = probe.encode()
            at = [0, *(m.start() for m in _SAFE.finditer(raw)), len(raw)]
            parts = self.library([raw[a:b] for a, b in zip(at, at[1:], strict=False)])
            if list(chain.from_iterable(parts)) != self.library([raw])[0]:
                return False
        return True

    def pieced(self, spans: list[bytes]) -> list[Coded]:
        """What spans that start and end at safe boundaries are coded as, from the pieces between those inside. A piece that
        the worker remembers is not asked of the library again: words recur, most of a span is known. Pieces are
        split, named and joined for all spans at once."""
        if not spans:
            return []
        if self.drops:
            cut = pc.ascii_split_whitespace(pa.array([x.decode("utf-8", "replace") for x in spans], pa.large_string()))
            offsets, flat = cut.offsets.to_numpy().astype(np.int64), cut.values
        else:
            parts = [_CUT.split(x) for x in spans]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            flat = pa.array([p.decode("utf-8", "replace") for x in parts for p in x], pa.large_string())
        named = flat.dictionary_encode()
        known = self.known(named.dictionary.to_pylist())
        count = np.fromiter((len(k.ids) for k in known), np.int64, len(known))
        ids = np.fromiter(chain.from_iterable(k.ids for k in known), np.int32, int(count.sum()))
        at = named.indices.to_numpy()
        some = count[at] > 0  # blanks between pieces have no tokens
        offsets, at = np.concatenate([[0], np.cumsum(some)])[offsets], at[some]
        stop = np.cumsum(count[at])
        ids = ids[np.repeat((np.cumsum(count) - count)[at] - stop + count[at], count[at]) + np.arange(stop[-1] if len(stop) else 0)]
        ends = np.concatenate([[0], stop])[offsets]
        joined = lambda texts: pc.binary_join(pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(texts, pa.large_string()).take(pa.array(at))), pa.scalar(" ", pa.large_string())).to_pylist()
        lines, decoded = joined([k.line for k in known]), joined([k.decoded for k in known]) if self.spaced else [""] * len(spans)
        return [Coded(ids[i:j], x, y) for i, j, x, y in zip(ends, ends[1:], lines, decoded, strict=False)]

    def known(self, pieces: list[str]) -> list[Coded]:
        """What different pieces are coded as: remembered, or asked of the library in one call."""
        out = list(map(self.words.get, pieces))
        fresh = [i for i, x in enumerate(out) if x is None]
        ask = [i for i in fresh if pieces[i] not in self.old]
        for i, x in zip(ask, self.coded(self.library_of([pieces[i] for i in ask])), strict=True):
            out[i] = x
        if len(self.words) + len(fresh) > WORD_MEMORY:
            before, self.old, self.words = self.old, self.words, {}
        else:
            before = self.old
        for i in fresh:
            if out[i] is None:
                out[i] = before[pieces[i]]
            if len(pieces[i]) <= LONG_PIECE:
                self.words[pieces[i]] = out[i]
        return out

    def coded(self, found: list[list[int]]) -> list[Coded]:
        """Ids with their text and, where the library joins tokens by spaces, its decode of them."""
        decoded = self.tok.decode_batch(found, skip_special_tokens=False) if self.spaced else [""] * len(found)
        return [Coded(ids, " ".join(map(str, ids)), d) for ids, d in zip(found, decoded, strict=True)]

    def library(self, pieces: list[bytes]) -> list[list[int]]:
        return self.library_of([p.decode("utf-8", "replace") for p in pieces])

    def library_of(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def layout(self, raw: bytes) -> list[tuple[int, int, bytes]]:
        """(start, end, digest) of the bodies of the chunks of a text that have one; the text's ends are safe too."""
        out, start = [], 0
        for end in cuts(raw, self.bits):
            a, z = start, end
            if start:
                m = _SAFE.search(raw, start, end)
                a = m.start() if m else end
            if end < len(raw):
                z = raw.rfind(b" ", start, end - 1)
                while z > a and not _SAFE.match(raw, z):
                    z = raw.rfind(b" ", start, z)
            if z > a:
                out.append((a, z, digest(raw[a:z])))
            start = end
        return out

    def encode_many(self, raws: list[bytes]) -> list[tuple[list[int], str]]:
        """The ids of each text, and the ids as text."""
        return [(list(chain.from_iterable(np.asarray(p.ids).tolist() for p in parts)), " ".join(p.line for p in parts)) for parts in self.parts_of(raws)]

    def rows_of(self, raws: list[bytes]) -> list[tuple[int, str, str]]:
        """Number of ids, the ids as text, and the library's decode of them, special tokens kept, of each text."""
        parts = self.parts_of(raws)
        if self.spaced:
            decoded = [" ".join([p.decoded for p in ps]) for ps in parts]
        else:
            decoded = self.tok.decode_batch([list(chain.from_iterable(np.asarray(p.ids).tolist() for p in ps)) for ps in parts], skip_special_tokens=False)
        return [(sum(len(p.ids) for p in ps), " ".join([p.line for p in ps]), d) for ps, d in zip(parts, decoded, strict=True)]

    def parts_of(self, raws: list[bytes]) -> list[list[Coded]]:
        """The parts of each text in order, those with ids: bodies of chunks and the joins between them."""
        layouts = [self.layout(r) for r in raws]
        bodies: dict[bytes, Coded | None] = {}
        wanted: list[tuple[bytes, bytes]] = []
        for raw, layout in zip(raws, layouts, strict=True):
            for a, b, key in layout:
                self.asked += b - a
                if key not in bodies:
                    bodies[key] = self.memory.find(key)
                    if bodies[key] is None:
                        self.encoded += b - a
                        wanted.append((key, raw[a:b]))
        for (key, _), ids in zip(wanted, self.pieced([p for _, p in wanted]), strict=True):
            bodies[key] = ids
            self.memory.keep(key, ids)
        gaps = []  # (text, its place among the gaps of the text, left body or None, right body or None)
        for i, layout in enumerate(layouts):
            ends = [0, *(x for a, z, _ in layout for x in (a, z)), len(raws[i])]
            gaps += [(i, k, layout[k - 1] if k else None, layout[k] if k < len(layout) else None) for k in range(len(layout) + 1) if ends[2 * k] < ends[2 * k + 1]]
        joined: dict[tuple[int, int], list[int]] = {}
        words = 1
        while gaps and words <= WIDEST:
            whole, ends = [], []
            for i, _, left, right in gaps:
                raw = raws[i]
                a, b = left[1] if left else 0, right[0] if right else len(raw)
                lo, hi = self.words_before(raw, left, words), self.words_after(raw, right, words)
                whole.append(raw[lo:hi])
                ends += [raw[lo:a], raw[b:hi]]
            found, known, again = self.library(whole), self.pieced(ends), []
            for g, (i, k, left, right) in enumerate(gaps):
                before, after = known[2 * g].ids.tolist(), known[2 * g + 1].ids.tolist()
                ids = self.agreed(before, found[g], after, *(bodies[x[2]].ids[at].tolist() if x else None for x, at in ((left, slice(-len(before) or None, None)), (right, slice(len(after))))))
                if ids is None:
                    again.append((i, k, left, right))
                else:
                    joined[i, k] = ids
            gaps, words = again, 2 * words
            self.widened += len(again)
        lost = sorted({g[0] for g in gaps})
        self.whole += len(lost)
        joined = dict(zip(joined, self.coded(list(joined.values())), strict=True))
        out = dict(zip(lost, ([x] for x in self.coded(self.library([raws[i] for i in lost]))), strict=True))
        for i, layout in enumerate(layouts):
            if i not in out:
                places = chain([joined.get((i, 0))], *((bodies[key], joined.get((i, k + 1))) for k, (_, _, key) in enumerate(layout)))
                out[i] = [x for x in places if x is not None]
        return [[x for x in out[i] if len(x.ids)] for i in range(len(raws))]

    @staticmethod
    def words_before(raw: bytes, left: tuple | None, n: int) -> int:
        """Where the last ``n`` words of a body start, at a safe boundary; the body's start if it has no more."""
        if left is None:
            return 0
        at = left[1]
        for _ in range(n):
            at = raw.rfind(b" ", left[0], at)
            while at > left[0] and not _SAFE.match(raw, at):
                at = raw.rfind(b" ", left[0], at)
            if at <= left[0]:
                return left[0]
        return at

    @staticmethod
    def words_after(raw: bytes, right: tuple | None, n: int) -> int:
        if right is None:
            return len(raw)
        at = right[0]
        for _ in range(n):
            m = _SAFE.search(raw, at + 1, right[1] + 2)
            if m is None or m.start() >= right[1]:
                return right[1]
            at = m.start()
        return at

    @staticmethod
    def agreed(before: list[int], window: list[int], after: list[int], left: list[int] | None, right: list[int] | None) -> list[int] | None:
        """The ids between the neighbours' words in ``window``, if its outer ids are those of the words alone and those
        that the bodies hold; else None."""
        a, z = len(before), len(window) - len(after)
        if a > z or window[:a] != before or window[z:] != after:
            return None
        if left is not None and left[len(left) - a :] != before or right is not None and right[: len(after)] != after:
            return None
        return window[a:z]


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}
KEPT.append(_ENCODERS)


def encoder(path: str, bits: int = CHUNK_BITS) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file, kept between tasks until another operator's task frees it."""
    if (path, bits) not in _ENCODERS:
        _ENCODERS[path, bits] = ChunkEncoder(path, bits)
    return _ENCODERS[path, bits]


def hot_keys(given: DataFrame, bits: int = CHUNK_BITS) -> dict[int, int]:
    """The meeting keys of many rows of ``given`` (doc_id, text), and over how many tasks each is dealt so that none has much
    more than an even share. About one row in ``SAMPLED`` is looked at; what is found decides where texts go, never what they
    give. A hot key has ``LEAST_SEEN`` of these rows or more; the ``HOT`` largest are dealt."""
    sample = given.sample(1 / SAMPLED, seed=7).hint("rebalance")  # small: a few tasks look at it
    looked = sample.mapInArrow(_keyed(bits, {}), "doc_id long, text binary, _meet long, _shares int").rollup("_meet").agg(F.count(F.lit(1)).alias("n"))
    many = {r["_meet"]: r["n"] for r in looked.where(f"n >= {LEAST_SEEN}").orderBy(F.desc("n"), "_meet").limit(HOT + 1).collect()}
    seen, tasks = many.pop(None, 0), int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the row of no key counts all
    return {key: shares for key, n in many.items() if (shares := -(-n * tasks // seen)) > 1}


def _keyed(bits: int, shares: dict[int, int]):
    """Adds the meeting key and the number of tasks that it is dealt over as the last columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [meeting_key(t.as_py() or b"", bits) for t in b.column(1)]
            yield pa.record_batch([*b.columns, pa.array(keys, pa.int64()), pa.array([shares.get(k, 1) for k in keys], pa.int32())], names=[*b.schema.names, "_meet", "_shares"])

    return rows


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, carry: bool = False, bits: int = CHUNK_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (decimal, joined by spaces) and decoded (the library's decode of
    those ids, special tokens kept). ``digests`` gives ids_sha256 and decoded_sha256 instead; ``carry`` adds the whole
    input row as the struct ``_row``, so columns may have any name.

    ``vocabulary`` is the path of a tokenizers file on every executor; one whose tokens reach across spaces between
    words raises an error. Null and empty texts have no tokens. Repeated rows each get a row, a null id is kept. Texts
    move once, to where texts with the same smallest chunk are; a hot key (``hot_keys``) is dealt over several tasks by id, each
    of which encodes its chunks once. Texts of any length are encoded whole.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the memories hold many small objects and no cycles; going over them took a third of the time
        try:
            yield from encoded(batches)
        finally:
            gc.enable()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, bits)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column(1)]
            out, s = [], 0
            while s < len(texts):
                e, size = s + 1, len(texts[s])
                while e < len(texts) and size + len(texts[e]) <= BATCH_TEXT:
                    size += len(texts[e])
                    e += 1
                out += [(n, sha(line), sha(decoded)) if digests else (n, line, decoded) for n, line, decoded in enc.rows_of(texts[s:e])]
                s = e
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            carried = [b.column(i) for i in range(2, b.num_columns) if b.schema.names[i] == "_row"]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
            yield pa.record_batch([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), *carried], names=["doc_id", *names, *["_row" for _ in carried]])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"), *([F.struct("*").alias("_row")] if carry else []))
    row = f", _row {given.schema['_row'].dataType.simpleString()}" if carry else ""
    names = "ids_sha256 string, decoded_sha256 string" if digests else "ids string, decoded string"
    shares = hot_keys(given.select("doc_id", "text"), bits)
    met = given.mapInArrow(_keyed(bits, shares), f"doc_id long, text binary{row}, _meet long, _shares int")
    share = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.col("_shares"))
    met = met.withColumn("_share", share).drop("_shares").repartition("_meet", "_share").drop("_share").sortWithinPartitions("_meet")
    return met.mapInArrow(rows, f"doc_id long, n_tokens long, {names}{row}")
