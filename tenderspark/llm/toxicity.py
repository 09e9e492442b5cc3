"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as a hashed word vector beside the mean of the hashed vectors of its character trigrams. Overlapping
windows of ``T`` words cover every word of a text: one starts every ``STRIDE`` words, the last one ends with the text. A
document's score is its highest window's. A smaller ``stride`` costs in proportion and only adds windows. Labels mark
documents, so training first takes every window of a toxic document as toxic and then, as a multiple-instance model,
only its highest scoring ones.

Learning is bounded by rows, not by the size of a text: at most ``SAMPLE_PER_LABEL`` labelled rows of each label, one text
for an id, and of a text at most ``PIECES`` pieces of ``PIECE_WORDS`` words, dealt by a hash (a text of up to
``PIECES * PIECE_WORDS`` words is learned whole). Scoring reads every word of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import as_bytes, bounded_batches, bounded_sample, word_hashes, word_spans

T, STRIDE = 32, 16
H, E, A = 8, 8, 8
WORD_ROWS, CHAR_ROWS = 1 << 16, 1 << 12
SAMPLE_PER_LABEL, WINDOWS_PER_EPOCH = 700, 10_000
PIECES, PIECE_WORDS, WORD_BYTES = 8, 256, 256  # of a learned text; longer words are left out of the pieces
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else (b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20) for b in range(256))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Corpus:
    """The words of some texts: rows of the word table, and the character trigram rows of each distinct word."""

    def __init__(self, texts: list[bytes]) -> None:
        joined = b"\n".join(t.translate(_FOLD) for t in texts) + b"\n"
        raw = np.frombuffer(joined, np.uint8)
        starts, ends = word_spans(raw)
        borders = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        h = word_hashes(raw, starts, ends)
        self.first = np.searchsorted(starts, borders)  # of each text, and the end
        _, sample, self.word = np.unique(h, return_index=True, return_inverse=True)
        self.row = (h[sample] % np.uint64(WORD_ROWS)).astype(np.int64)
        s, e = starts[sample], ends[sample]
        n = e - s  # trigrams of a word with its bounding spaces: as many as bytes
        self.tri_of = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s, n)
        code = raw.astype(np.uint32)
        code[code == 10] = 32
        before = np.where(at == 0, 32, code[at - 1])
        tri = before << np.uint32(16) | code[at] << np.uint32(8) | code[np.minimum(at + 1, len(code) - 1)]
        self.tri = ((tri.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
        self.n_tri = np.maximum(n, 1)

    def windows(self, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, number of words) of every window; a text without words has none."""
        text, first, size = [], [], []
        for i, (a, b) in enumerate(zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)):
            if b > a:
                at = list(range(a, max(a, b - T) + 1, stride))
                if at[-1] + T < b:
                    at.append(b - T)
                text += [i] * len(at)
                first += at
                size += [min(T, b - a)] * len(at)
        return np.array(text, np.int64), np.array(first, np.int64), np.array(size, np.int64)


class Network:
    """Parameters by name; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, seed: int = 11) -> None:
        g = np.random.default_rng(seed)
        f = lambda *shape, s: (g.standard_normal(shape) * s).astype(np.float32)
        self.p = {"words": f(WORD_ROWS, E, s=0.05), "chars": f(CHAR_ROWS, E, s=0.05), "attend": f(2 * H, A, s=0.3), "ask": f(A, s=0.3), "out": f(2 * H, s=0.3), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": f(2 * E, 3 * H, s=0.3), f"h{d}": f(H, 3 * H, s=0.3), f"c{d}": np.zeros(3 * H, np.float32)}
        self.shift, self.own = 0.0, np.ones(WORD_ROWS, bool)

    def learn_words(self, c: Corpus, text_of: np.ndarray, least: int = 3) -> None:
        """Only words of ``least`` texts or more get a vector of their own; rarer ones are known by their characters,
        as the words never seen will be."""
        pairs = np.unique(np.column_stack([c.row[c.word], text_of]), axis=0)
        self.own = np.bincount(pairs[:, 0], minlength=WORD_ROWS) >= least
        self.p["words"][~self.own] = 0

    def inputs(self, c: Corpus) -> np.ndarray:
        """The input vector of each distinct word."""
        chars = np.zeros((len(c.row), E), np.float32)
        if len(c.tri):
            chars = np.add.reduceat(self.p["chars"][c.tri], np.cumsum(c.n_tri) - c.n_tri, axis=0) / c.n_tri[:, None].astype(np.float32)
        return np.hstack([self.p["words"][c.row], chars])

    def forward(self, x: np.ndarray, idx: np.ndarray, live: np.ndarray | None, keep: bool = False):
        """Logits of windows. ``x``: inputs by word, ``idx`` (T, n): words by place, ``live`` (T, n): 0 past the end."""
        n, p, hs, store = idx.shape[1], self.p, {}, {}
        for d in "fb":
            proj = (x @ p[f"x{d}"] + p[f"c{d}"])[idx]
            h, out, kept = np.zeros((n, H), np.float32), np.empty((len(idx), n, H), np.float32), [None] * len(idx)
            for t in range(len(idx)) if d == "f" else range(len(idx) - 1, -1, -1):
                gh = h @ p[f"h{d}"]
                zr = sigmoid(proj[t, :, : 2 * H] + gh[:, : 2 * H])
                z, r = zr[:, :H], zr[:, H:]
                new = np.tanh(proj[t, :, 2 * H :] + r * gh[:, 2 * H :])
                nxt = new + z * (h - new)
                if live is not None:
                    nxt = np.where(live[t][:, None] > 0, nxt, h)
                if keep:
                    kept[t] = (h, gh, z, r, new)
                out[t] = h = nxt
            hs[d], store[d] = out, kept
        both = np.concatenate([hs["f"], hs["b"]], axis=2)
        u = np.tanh(both @ p["attend"])
        s = u @ p["ask"]
        if live is not None:
            s = np.where(live > 0, s, -1e9)
        a = np.exp(s - s.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[:, :, None] * both).sum(axis=0)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, (both, u, a, pooled, store)) if keep else logit

    def gradients(self, c: Corpus, idx: np.ndarray, live: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, float]:
        """Gradients of the weighted logistic loss of windows, and the loss."""
        p, x = self.p, self.inputs(c)
        logit, (both, u, a, pooled, store) = self.forward(x, idx, live, keep=True)
        prob = sigmoid(logit)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "chars")}
        dl = (prob - y) * weight
        g["out"], g["bias"] = pooled.T @ dl, dl.sum(keepdims=True)
        dpool = dl[:, None] * p["out"]
        da = (both * dpool).sum(axis=2)
        dboth = a[:, :, None] * dpool
        ds = a * (da - (a * da).sum(axis=0))
        g["ask"] = np.einsum("tn,tna->a", ds, u)
        du = ds[:, :, None] * p["ask"] * (1 - u * u)
        g["attend"] = np.einsum("tnh,tna->ha", both, du)
        dboth = dboth + du @ p["attend"].T
        dx = np.zeros_like(x)
        for d in "fb":
            dout = dboth[:, :, :H] if d == "f" else dboth[:, :, H:]
            dh = np.zeros((idx.shape[1], H), np.float32)
            dproj = np.zeros((len(idx), idx.shape[1], 3 * H), np.float32)
            for t in range(len(idx) - 1, -1, -1) if d == "f" else range(len(idx)):
                h, gh, z, r, new = store[d][t]
                full = dh + dout[t]
                on = live[t][:, None]
                dn = full * on
                dnew = dn * (1 - z) * (1 - new * new)
                dz = dn * (h - new) * z * (1 - z)
                dr = dnew * gh[:, 2 * H :] * r * (1 - r)
                dgh = np.concatenate([dz, dr, dnew * r], axis=1)
                dproj[t] = np.concatenate([dz, dr, dnew], axis=1)
                g[f"h{d}"] += h.T @ dgh
                dh = full * (1 - on) + dn * z + dgh @ p[f"h{d}"].T
            g[f"c{d}"] = dproj.sum(axis=(0, 1))
            by_word = np.zeros((len(x), 3 * H), np.float32)
            np.add.at(by_word, idx.ravel(), dproj.reshape(-1, 3 * H))
            g[f"x{d}"] = x.T @ by_word
            dx += by_word @ p[f"x{d}"].T
        used = np.flatnonzero(np.abs(dx).sum(axis=1))
        own = used[self.own[c.row[used]]]
        g["words"] = (c.row[own], dx[own, :E])
        mine = np.isin(c.tri_of, used)
        g["chars"] = (c.tri[mine], (dx[:, E:] / c.n_tri[:, None].astype(np.float32))[c.tri_of[mine]])
        loss = -(weight * np.log(np.maximum(np.where(y > 0.5, prob, 1 - prob), 1e-9))).sum()
        return g, float(loss)

    def full_logits(self, proj: dict[str, np.ndarray], idx: np.ndarray) -> np.ndarray:
        """What ``forward`` gives for windows without padding, for scoring: one row per unit, so that every step works
        on contiguous memory in place. ``proj``: by direction the (3H, words) projections, gates halved."""
        n, p = idx.shape[1], self.p
        both = np.empty((T, 2 * H, n), np.float32)
        g, gh, tmp = np.empty((3 * H, n), np.float32), np.empty((3 * H, n), np.float32), np.empty((H, n), np.float32)
        for d in "fb":
            wh = p[f"h{d}"].T.copy()
            wh[: 2 * H] *= 0.5
            h, lo = np.zeros((H, n), np.float32), 0 if d == "f" else H
            for t in range(T) if d == "f" else range(T - 1, -1, -1):
                np.take(proj[d], idx[t], axis=1, out=g, mode="clip")
                np.matmul(wh, h, out=gh)
                zr, new = g[: 2 * H], g[2 * H :]
                zr += gh[: 2 * H]
                np.tanh(zr, out=zr)
                zr += 1
                zr *= 0.5
                np.multiply(zr[H:], gh[2 * H :], out=tmp)
                new += tmp
                np.tanh(new, out=new)
                out = both[t, lo : lo + H]
                np.subtract(h, new, out=out)
                out *= zr[:H]
                out += new
                h = out
        u = np.tanh(np.matmul(p["attend"].T, both))
        s = np.tensordot(p["ask"], u, axes=(0, 1))
        a = np.exp(s - s.max(axis=0))
        a /= a.sum(axis=0)
        both *= a[:, None, :]
        return p["out"] @ both.sum(axis=0) + p["bias"][0]

    def score_windows(self, c: Corpus, first: np.ndarray, size: np.ndarray, part: int = 1024) -> np.ndarray:
        """Logits of windows."""
        x, out = self.inputs(c), np.empty(len(first), np.float32)
        proj = {d: (x @ self.p[f"x{d}"] + self.p[f"c{d}"]).T.copy() for d in "fb"}
        for d in "fb":
            proj[d][: 2 * H] *= 0.5
        full, short = np.flatnonzero(size == T), np.flatnonzero(size < T)
        for s in range(0, len(full), part):
            w = full[s : s + part]
            out[w] = self.full_logits(proj, c.word[first[w][None, :] + np.arange(T)[:, None]])
        for s in range(0, len(short), part):
            w = short[s : s + part]
            out[w] = self.forward(x, *placed(c, first[w], size[w]))
        return out

    def score_texts(self, texts: list[bytes], stride: int = STRIDE) -> np.ndarray:
        """The probability of each text: of its highest window; of the bias alone where it has no words."""
        c = Corpus(texts)
        text, first, size = c.windows(stride)
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, text, self.score_windows(c, first, size))
        best = np.where(np.isinf(best), self.p["bias"][0] - 2.0, best)
        return sigmoid(best - self.shift)


def placed(c: Corpus, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (T, n) of windows and which places are live."""
    at = np.arange(T)[:, None]
    live = at < size[None, :]
    return c.word[np.where(live, first[None, :] + at, 0)], live.astype(np.float32)


class Optimiser:
    """Adam for the small parameters, Adagrad for the rows of the tables."""

    def __init__(self, net: Network, rate: float = 0.02) -> None:
        self.net, self.rate, self.n = net, rate, 0
        self.m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}

    def step(self, g: dict) -> None:
        self.n += 1
        for k, d in g.items():
            m, v = self.m[k]
            if isinstance(d, tuple):
                rows, back = np.unique(d[0], return_inverse=True)
                total = np.zeros((len(rows), E), np.float32)
                np.add.at(total, back, d[1])
                v[rows] += total * total
                self.net.p[k][rows] -= 5 * self.rate * total / (np.sqrt(v[rows]) + 1e-4)
            else:
                d = np.clip(d, -1, 1)
                m += 0.1 * (d - m)
                v += 0.01 * (d * d - v)
                self.net.p[k] -= self.rate * (m / (1 - 0.9**self.n)) / (np.sqrt(v / (1 - 0.99**self.n)) + 1e-6)


def trained(texts: list[list[bytes]], toxic: np.ndarray, epochs: int = 6, batch: int = 256, rate: float = 0.02, seed: int = 5, per_epoch: int = WINDOWS_PER_EPOCH) -> Network:
    """A network from labelled texts, each a list of pieces; with labels of one kind only, its bias says that kind.

    Every fourth text is kept from the fit; on those the best epoch's parameters are chosen and the cut is placed that a
    score of one half stands for. An epoch fits at most ``per_epoch`` windows, half of each label."""
    net = Network()
    if not len(texts) or toxic.min() == toxic.max():
        net.p["out"][:] = 0
        net.p["bias"][0] = 3.0 if len(texts) and toxic.max() == 1 else -3.0
        return net
    rng, opt, c = np.random.default_rng(seed), Optimiser(net), Corpus([p for t in texts for p in t])
    of = np.repeat(np.arange(len(texts)), list(map(len, texts)))
    piece, first, size = c.windows()
    text = of[piece]
    y = toxic[text].astype(np.float32)
    net.learn_words(c, np.repeat(of, np.diff(c.first)))
    tried = np.zeros(len(texts), bool)
    for kind in (0, 1):
        tried[np.flatnonzero(toxic == kind)[3::4]] = True
    fit, best = ~tried[text], None
    for epoch in range(epochs):
        use = np.flatnonzero(fit)
        if epoch >= 2:  # of a toxic text the windows that score highest, of the others all
            s, top = net.score_windows(c, first, size), np.full(len(texts), -np.inf)
            np.maximum.at(top, text, s)
            use = np.flatnonzero(fit & ((y < 0.5) | (s >= top[text] - 0.5)))
        pos, neg = use[y[use] > 0.5], use[y[use] < 0.5]
        half = per_epoch // 2
        hard = neg if epoch < 2 else neg[np.argsort(-s[neg], kind="stable")][: max(half, len(neg) // 4)]
        pos, neg = (rng.choice(i, min(len(i), half), replace=False) for i in (pos, hard))
        share = {1: 0.5 / max(1, len(pos)), 0: 0.5 / max(1, len(neg))}
        order = rng.permutation(np.concatenate([pos, neg]))
        for i in range(0, len(order), batch):
            w = order[i : i + batch]
            idx, live = placed(c, first[w], size[w])
            weight = np.where(y[w] > 0.5, share[1], share[0]).astype(np.float32)
            words, back = np.unique(idx, return_inverse=True)
            g, _ = net.gradients(_part(c, words), back.reshape(idx.shape), live, y[w], weight / weight.sum())
            opt.rate = rate * (1 - (epoch + i / len(order)) / epochs)
            opt.step(g)
        if epoch >= 2 or epoch == epochs - 1:
            raw = np.full(len(texts), -np.inf)
            np.maximum.at(raw, text, net.score_windows(c, first, size))
            found, cut = best_shift(raw[tried], toxic[tried])
            if best is None or found >= best[0]:
                best = (found, cut, {k: v.copy() for k, v in net.p.items()})
    _, net.shift, net.p = best
    return net


def _part(c: Corpus, words: np.ndarray) -> Corpus:
    """The corpus cut down to some of its distinct words, renumbered."""
    out = Corpus.__new__(Corpus)
    new = np.full(len(c.row), -1)
    new[words] = np.arange(len(words))
    mine = new[c.tri_of] >= 0
    out.row, out.n_tri, out.tri, out.tri_of = c.row[words], c.n_tri[words], c.tri[mine], new[c.tri_of[mine]]
    return out


def best_shift(raw: np.ndarray, toxic: np.ndarray, slack: float = 0.03) -> tuple[float, float]:
    """The highest F0.5 on the sample (a false alarm counts for more than a miss, as labels err), and the middle of the
    widest gap between two neighbours in score whose F0.5 is within ``slack`` of it."""
    if not len(raw):
        return 0.0, 0.0
    order = np.argsort(-raw, kind="stable")
    s, t = raw[order], np.cumsum(toxic[order])
    f = 1.25 * t / (np.arange(1, len(s) + 1) + 0.25 * toxic.sum())
    nxt = np.concatenate((s[1:], [s[-1] - 2]))
    ok = np.flatnonzero(np.isfinite(s) & np.isfinite(nxt) & (f >= f.max() - slack))
    if not len(ok):
        return 0.0, 0.0
    k = ok[np.argmax(s[ok] - nxt[ok])]
    return float(f.max()), float((s[k] + nxt[k]) / 2)


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text is divisible by 5; labels of such rows are never learned. A null id: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def pieces(raw: bytes, seed: int, most: int = PIECES, size: int = PIECE_WORDS) -> list[bytes]:
    """At most ``most`` pieces of ``size`` words of a text, all of it where it has no more, else those that a hash deals."""
    words = [w for w in raw.split() if len(w) <= WORD_BYTES]
    n = -(-len(words) // size)
    at = range(n) if n <= most else sorted(np.random.default_rng(seed & 0xFFFFFFFF).choice(n, most, replace=False).tolist())
    return [b" ".join(words[i * size : (i + 1) * size]) for i in at]


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_label: int = SAMPLE_PER_LABEL, most: int = PIECES) -> Network:
    """A network from at most ``per_label`` labelled rows of each label, those with the smallest hash of the id, and of
    each at most ``most`` pieces. Held-out rows and rows without id, text or label are left out; an id labelled twice takes
    its largest label, one with several texts the text that sorts first (by an aggregation with map-side combine, so
    an id on a third of the rows stays one row). What reaches the driver is at most 2 * ``per_label`` * ``most`` pieces of
    ``PIECE_WORDS`` words of ``WORD_BYTES`` bytes, whatever the sizes of texts and tables."""
    bounded_batches(docs.sparkSession)
    given = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = bounded_sample(given.where(~held_out()), "doc_id", per_label, by="toxic").withColumnRenamed("doc_id", "_id")
    texts = docs.select(F.col(id_col).alias("doc_id"), as_bytes(text_col).alias("text")).where(F.col("text").isNotNull())
    one = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([pieces(t.as_py(), i.as_py(), most) for i, t in zip(b.column(0), b.column(2), strict=True)], pa.list_(pa.binary()))], names=["doc_id", "toxic", "pieces"])

    rows = sorted(one.mapInArrow(cut, "doc_id long, toxic int, pieces array<binary>").collect(), key=lambda r: r.doc_id)
    return trained([[bytes(p) for p in r.pieces] for r in rows], np.array([r.toxic for r in rows], np.int64))


def scored(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", stride: int = STRIDE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1) and predicted, from the whole text alone.

    Null and empty texts have no window and get the score of a text that says nothing. Repeated rows each get a row; a
    null id is kept. Only id and text are read, so other columns may have any name.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, scores = [t or b"" for t in b.column(2).to_pylist()], []
            part: list[bytes] = []
            size = 0
            for t in texts:
                part.append(t)
                size += len(t)
                if size > 1 << 20:
                    scores.append(shared.value.score_texts(part, stride))
                    part, size = [], 0
            if part:
                scores.append(shared.value.score_texts(part, stride))
            s = np.concatenate(scores).astype(np.float64) if scores else np.zeros(0)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), as_bytes(text_col).alias("text"))
    return given.mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int")
