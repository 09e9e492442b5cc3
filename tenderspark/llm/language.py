"""Language identification in two levels: family first, then one-versus-one linear SVMs within the family.

Features are hashed counts of the 1-, 2- and 3-grams of the letters' UTF-8 bytes, damped by log1p and of unit length.
The machines (squared hinge, L2) are trained in numpy on a bounded sample of labelled rows.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderspark.llm.common import bounded_batches, bounded_sample

DIM = 4096
SAMPLE_PER_LANGUAGE = 300
MAX_LANGUAGES = 60  # that are learned, the most frequent; bounds the machines of one language against another
# Closely related languages; a learned language that is in none is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
}
_MAYBE = re.compile(r"[^\W\d_]")
_ONLY_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether some character is a letter; numbers such as superscripts and fractions are none."""
    return any(m[0].isalpha() for m in _MAYBE.finditer(text))


def features(texts: list[str]) -> np.ndarray:
    """A row of unit length for each text, drawn from all of it."""
    out = np.zeros((len(texts), DIM), np.float32)
    for row, t in enumerate(texts):
        raw = re.sub(rb"\x20+", b" ", b" " + t.lower().encode("utf-8", "replace").translate(_ONLY_LETTERS) + b" ")
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        grams = [b, two + np.uint32(1 << 25), three + np.uint32(1 << 26)]
        counts = sum(np.bincount((g * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM) for g in grams)
        out[row] = np.log1p(counts)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised squared-hinge machine for y in {-1, 1}, by accelerated gradients."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    rate = 1.0 / (penalty + 4.0)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - rate * (penalty * v - 2 * x.T @ (share * y * slack))
        w, v = new, new + (k / (k + 3)) * (new - w)
    return w[:-1], float(w[-1])


@dataclass
class Model:
    """``levels``: for the families and for each family's languages, the class names and the pairs' columns."""

    weights: np.ndarray
    bias: np.ndarray
    families: list[str]
    members: dict[str, list[str]]
    pairs: dict[str, list[tuple[int, int, int]]]

    def vote(self, margins: np.ndarray, level: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The class with most one-versus-one wins (ties: larger summed margin, then first) and its weakest win as a
        probability."""
        wins, total = np.zeros((len(margins), n)), np.zeros((len(margins), n))
        for a, b, col in self.pairs[level]:
            m = margins[:, col]
            wins[:, a] += m > 0
            wins[:, b] += m <= 0
            total[:, a] += m
            total[:, b] -= m
        best = np.argmax(wins + np.tanh(total / 1e3) / 4, axis=1)
        least = np.full(len(margins), np.inf)
        for a, b, col in self.pairs[level]:
            m = margins[:, col]
            least = np.where(best == a, np.minimum(least, m), np.where(best == b, np.minimum(least, -m), least))
        return best, np.where(np.isinf(least), 1.0, 1 / (1 + np.exp(-3 * np.where(np.isinf(least), 0, least))))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return ["und"] * len(texts), np.zeros(len(texts))
        margins = features(texts) @ self.weights + self.bias
        family, score = self.vote(margins, "", len(self.families))
        names = np.empty(len(texts), object)
        for i, f in enumerate(self.families):
            at = np.flatnonzero(family == i)
            if len(at):
                best, p = self.vote(margins[at], f, len(self.members[f]))
                names[at] = [self.members[f][k] for k in best]
                score[at] *= p
        return names.tolist(), score


def fitted(x: np.ndarray, lang: list[str], families: dict[str, tuple[str, ...]] = FAMILIES) -> Model:
    """Machines between families, and between the languages of each."""
    of = {code: name for name, codes in families.items() for code in codes}
    family = np.array([of.get(c, f"={c}") for c in lang], object)
    names = sorted(set(family))
    members = {f: sorted({c for c, g in zip(lang, family, strict=True) if g == f}) for f in names}
    langs, cols, pairs = np.array(lang, object), [], {}
    for level, classes, labels in [("", names, family), *[(f, members[f], langs) for f in names]]:
        pairs[level] = []
        for a, b in itertools.combinations(range(len(classes)), 2):
            at = np.flatnonzero((labels == classes[a]) | (labels == classes[b]))
            pairs[level].append((a, b, len(cols)))
            cols.append(linear_svm(x[at], np.where(labels[at] == classes[a], 1.0, -1.0).astype(np.float32)))
    weights = np.stack([w for w, _ in cols], axis=1) if cols else np.zeros((DIM, 1), np.float32)
    return Model(weights.astype(np.float32), np.array([b for _, b in cols] or [0.0], np.float32), names, members, pairs)


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 1 modulo 3; such rows are never learned from. A null id: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from at most ``per_language`` rows of each language, those with the smallest hash of the id; held-out
    rows and rows without id, text or language are left out, and so are all but the ``MAX_LANGUAGES`` most frequent values."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("doc_id is not null and text is not null and lang is not null")
    bounded_batches(docs.sparkSession)
    given = given.where(~held_out())
    common = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).select("lang")
    sample = bounded_sample(given.join(F.broadcast(common), "lang", "left_semi"), "doc_id", per_language, by="lang")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([r.tobytes() for r in features(b.column(1).to_pylist())], pa.binary())], names=["lang", "x"])

    found = sample.orderBy("doc_id").select("lang", "text").mapInArrow(rows, "lang string, x binary").collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in found]) if found else np.zeros((0, DIM), np.float32)
    return fitted(x, [r.lang for r in found])


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred and score (0 to 1), from the whole text alone.

    A null text or one without a letter is ``und`` with score 0, and so is every text if nothing could be learned.
    Repeated rows each get a row; a null id is kept. Only id and text are read, so other columns may have any name; a text of
    any length is read whole.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            lettered = [i for i, t in enumerate(texts) if t and has_letter(t)]
            for s in range(0, len(lettered), 256):
                part = lettered[s : s + 256]
                found, p = shared.value.predict([texts[i] for i in part])
                for i, n, v in zip(part, found, p.tolist(), strict=True):
                    names[i], scores[i] = n, v
            yield pa.record_batch([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return given.mapInArrow(rows, "doc_id long, held_out boolean, lang_pred string, score double")
