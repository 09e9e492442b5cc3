"""Links of similar texts against all pairs, and what their cells hold."""

import itertools
import random

import numpy as np
import pytest
from conftest_llm import make_docs
from pyspark.sql import functions as F

from tenderspark.llm import simhash
from tenderspark.llm.components import connected_components


def jaccard(x, y):
    x, y = (set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in (x, y))
    return len(x & y) / max(1, len(x | y))


def family(rng, n, words, change):
    """Texts of which each differs from the one before in some words: neighbours are alike, the ends are not."""
    text = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        out.append(" ".join(text))
        for _ in range(change):
            text[rng.randrange(words)] = f"w{rng.randint(0, 5000)}"
    return out


def rows():
    rng = random.Random(8)
    texts = [t for i in range(12) for t in family(rng, 9, rng.choice([60, 150, 400]), rng.choice([1, 2, 5]))]
    star = [f"w{i}" for i in range(300)]
    texts += [" ".join(star[: 300 - 2 * i] + [f"z{i}x{j}" for j in range(2 * i)]) for i in range(25)]
    texts += [" ".join(f"u{rng.randint(0, 10**6)}" for _ in range(80)) for _ in range(30)]
    return list(enumerate(texts))


@pytest.mark.parametrize("cell", [256, 3])
def test_components_are_those_of_all_similar_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    texts = rows()
    group = {i: i for i, _ in texts}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for (i, x), (j, y) in itertools.combinations(texts, 2):
        near = (simhash.fingerprint(x.encode(), 4) ^ simhash.fingerprint(y.encode(), 4)).bit_count() <= 4
        if near or jaccard(x, y) >= 0.8:
            group[max(root(i), root(j))] = min(root(i), root(j))
    kept = simhash.keep_one(make_docs(spark, [(i, t, "en") for i, t in texts]), similarity=0.8)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({root(i) for i in group})
    assert 20 < len({root(i) for i in group}) < len(texts) - 60


@pytest.mark.parametrize("cell", [256, 4])
def test_members_of_different_parts_meet_in_a_cell(spark, monkeypatch, cell):
    """One bucket of a large part and strangers, one of strangers alone, one of two parts of like size."""
    monkeypatch.setattr(simhash, "CELL", cell)
    parts = {1: [0] * 50 + [1, 2, 3], 2: list(range(12)), 3: [0] * 9 + [1] * 8}
    members = [(t, 7, 1000 * t + i, 1000 * t + i, now) for t, nows in parts.items() for i, now in enumerate(nows)]
    left = spark.createDataFrame(members, "t int, k long, th long, part long, now long")
    cells = {}
    for r in simhash.bucket_cells(left).collect():
        cells.setdefault((r.t, r.k, r.kind, r.i, r.j), []).append(r)
    met = set()
    for (_, _, kind, i, j), held in cells.items():
        assert len(held) <= 4 * cell
        for x, y in itertools.permutations(held, 2):
            if kind == "main" and x.main == y.main or kind == "others" and (x.main or (i != j and x.block == y.block)):
                continue
            met.add((x.th, y.th))
    want = {(a[2], b[2]) for a, b in itertools.permutations(members, 2) if a[0] == b[0] and a[4] != b[4]}
    assert want <= met
    if cell == 256:
        assert sum(map(len, cells.values())) == 53 + 3 + 12 + 11 + 17 + 8  # strangers meet the large part and one another


def test_parts_of_similar_texts_are_linked_once(spark):
    base = np.arange(100, dtype=np.int64)
    sets = spark.createDataFrame([(i, (base + i).tolist()) for i in range(6)] + [(9, (base + 900).tolist())], "th long, h array<long>")
    cells = spark.createDataFrame([(1, 1, "others", 0, 0, th, th, th, False, 0) for th in (0, 1, 2, 3, 4, 5, 9)], "t int, k long, kind string, i int, j int, th long, part long, now long, main boolean, block int")
    links = simhash.similar_in_cells(cells, sets, 0.8)
    assert links.count() == 5
    assert {r.component for r in connected_components(links).collect()} == {0}
    assert simhash.similar_in_cells(cells.where(F.lit(False)), sets, 0.8).count() == 0
