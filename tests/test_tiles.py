"""Matching by tiles against plain versions: negative blocks, pruning, hot blocks, ties, missing tokens and vectors."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tenderspark.operators import matching as M
from tenderspark.operators import tiles


def brute(cats, items, k, floor, vectors):
    by = defaultdict(lambda: ([], []))
    for row in cats:
        by[row[0]][0].append(row)
    for row in items:
        by[row[0]][1].append(row)
    out = []
    for block, (cs, its) in by.items():
        if not cs or not its:
            continue
        docs = [Counter(i[2] or []) for i in its]
        n, avg = len(its), sum(sum(d.values()) for d in docs) / len(its)
        df = Counter(t for d in docs for t in d)
        idf = {t: math.log(n - x + 0.5) - math.log(x + 0.5) for t, x in df.items()}
        mean = sum(idf.values()) / len(idf) if idf else 0
        idf = {t: 0.25 * mean if x < 0 else x for t, x in idf.items()}
        raw = [[sum(q * idf[t] * d[t] * 2.5 / (d[t] + 1.5 * (0.25 + 0.75 * sum(d.values()) / avg)) for t, q in Counter(c[2] or []).items() if t in d) for d in docs] for c in cs]
        lo, hi = min(map(min, raw)), max(map(max, raw))
        for c, row in zip(cs, raw, strict=True):
            found = []
            for i, x in zip(its, row, strict=True):
                bm = (x - lo) / (hi - lo) if hi > lo else 0.0
                cos = 0.0
                if vectors and c[3] is not None and i[3] is not None and any(c[3]) and any(i[3]):
                    cos = sum(p * q for p, q in zip(c[3], i[3], strict=True)) / math.sqrt(sum(p * p for p in c[3]) * sum(q * q for q in i[3]))
                score = round(max(bm, cos), 9)
                if score >= floor:
                    found.append((-score, i[1], bm, cos))
            out += [(block, c[1], i, round(bm, 6), round(cos, 6), round(-s, 6)) for s, i, bm, cos in sorted(found)[:k]]
    return sorted(out)


def rows(seed, n, common):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    cats, items = [], []
    for block, share in (("hot", 0.7), ("other", 0.25), ("lone", 0.05)):
        cats += [(block, f"c{i}", rng.sample(words, 3) + (["common"] if common else []), [rng.gauss(0, 1) for _ in range(4)]) for i in range(4)]
        items += [(block, f"i{i:04d}", rng.choices(words, k=rng.randint(1, 12)) + ["common"] * common, [rng.gauss(0, 1) for _ in range(4)]) for i in range(int(n * share))]
    cats += [("hot", "none", None, [0.0] * 4), ("hot", "twice", ["w1", "w1", "w2"], None), ("empty", "c0", ["w1"], [1.0] * 4)]
    items += [("hot", "null", None, [1.0, 0.0, 0.0, 0.0]), ("hot", "bare", [], None), ("hot", "same1", ["w1"], None), ("hot", "same0", ["w1"], None), ("nocodes", "x", ["w1"], None)]
    return cats, items


SCHEMA = "block string, {} string, tokens array<string>, v array<double>"


@pytest.mark.parametrize(("common", "floor", "k", "vectors"), [(0, 0.3, 5, True), (1, 0.3, 5, True), (0, 0.2, 1000, False), (0, 0.0, 3, True), (1, 0.6, 7, False)])
def test_candidate_pairs(spark, monkeypatch, common, floor, k, vectors):
    monkeypatch.setattr(tiles.tiled, "__defaults__", (16, 3))  # many tiles of items and of codes
    cats, items = rows(3, 150, common)
    a, b = spark.createDataFrame(cats, SCHEMA.format("code")), spark.createDataFrame(items, SCHEMA.format("item"))
    got = M.candidate_pairs(a, b, "block", "code", "item", "tokens", k, floor, "v" if vectors else None).collect()
    assert sorted((r.block, r.code, r["item"], round(r.bm25, 6), round(r.cosine, 6), round(r.score, 6)) for r in got) == brute(cats, items, k, floor, vectors)


def test_a_block_of_negative_scores_keeps_pairs_without_a_common_term(spark):
    cats = [("b", "c", ["common"], None)]
    items = [("b", f"i{i}", ["common"], None) for i in range(9)] + [("b", "j1", ["rare"], None), ("b", "j0", ["odd"], None)]
    a, b = spark.createDataFrame(cats, SCHEMA.format("code")), spark.createDataFrame(items, SCHEMA.format("item"))
    got = M.candidate_pairs(a, b, "block", "code", "item", "tokens", 5, 0.9).collect()
    assert sorted((r["item"], r.bm25) for r in got) == [(f"i{i}", 1.0) for i in range(5)] or {r["item"] for r in got} == {"j0", "j1"}
    assert sorted((r.block, r.code, r["item"], round(r.bm25, 6), round(r.cosine, 6), round(r.score, 6)) for r in got) == brute(cats, items, 5, 0.9, False)


def test_best_by_cosine(spark):
    cats, items = rows(5, 200, 0)
    a, b = spark.createDataFrame(cats, SCHEMA.format("code")), spark.createDataFrame(items, SCHEMA.format("item"))
    got = M.best_by_cosine(a, b, "block", "code", "item", "v", 4, 0.1).collect()
    every = [(r.block, r.code, r["item"], r.cosine) for r in M.cosine_scores(a, b, "block", "code", "item", "v").collect()]
    want = defaultdict(list)
    for block, code, item, x in every:
        if x is not None and round(x, 9) >= 0.1:
            want[block, code].append((-round(x, 9), item))
    assert sorted((r.block, r.code, r["item"], r.place) for r in got) == sorted((*key, item, i + 1) for key, found in want.items() for i, (_, item) in enumerate(sorted(found)[:4]))


def test_items_that_cannot_reach_the_floor_are_not_scored():
    n = 500
    items = pa.table({"tokens": [["common"] * (1 + i % 2) + (["rare"] if i % 50 == 0 else []) for i in range(n)]})
    codes = pa.table({"terms": [[{"term": "common", "n": 1, "idf": 0.1}, {"term": "rare", "n": 1, "idf": 5.0}]], "avg_len": [1.5]})
    tile = tiles.Tile(items, codes, 1.5, 0.75)
    full, every = tile.scores(0)
    part, may = tile.scores(0, 1.0)
    assert every.all() and may.sum() == 10 and np.allclose(part[may], full[may]) and (full[~may] < 1.0).all()
    assert (part[~may] == 0).all()


def test_what_is_shuffled_does_not_follow_the_pairs(spark):
    """Rows that reach the tiles: each item once, each code once per tile."""
    cats = [("b", f"c{i}", ["w1"], None) for i in range(50)]
    items = [("b", f"i{i}", ["w1", f"w{i % 7}"], None) for i in range(3000)]
    a, b = spark.createDataFrame(cats, SCHEMA.format("code")), spark.createDataFrame(items, SCHEMA.format("item"))
    seen = spark.sparkContext.accumulator(0)
    groups = spark.sparkContext.accumulator(0)

    def work(x, c):
        seen.add(x.num_rows + c.num_rows)
        groups.add(1)
        return {"n": [x.num_rows]}

    assert sum(r.n for r in tiles.tiled(a, b, "block", "code", "item", work, "n long", 256).collect()) == 3000
    assert groups.value == 12 and seen.value == 3000 + 12 * 50 < 50 * 3000 / 40
