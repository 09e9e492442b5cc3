"""Line dedup, ranked search and hard negatives against plain versions, with the odd rows in the tables."""

import math
import random
import re
import uuid
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import make_docs
from pyspark.sql import functions as F

from tenderspark.llm import lines, negatives, search

BLANK = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def line_rows():
    rng = random.Random(5)
    common = [f"Subscribe to our Newsletter number {i} for more of the same élan" for i in range(6)]
    rows = []
    for i in range(40):
        own = [rng.choice(common) if rng.random() < 0.5 else f"a line that document {i} alone has, number {j}, and no other" for j in range(rng.randint(0, 6))]
        rows.append((i * 2, "\n".join(rng.choice(["", "  ", "\t"]) + rng.choice([x, x, lower(x)]) for x in own), "en"))
    wide = "é" * 40
    rows += [(100 + i, f"{wide}\nshort\n{wide}\x0c", "fr") for i in range(5)]
    rows += [(200, None, None), (201, "", "en"), (None, common[0], "en"), (None, common[1] + "\n" + wide, "en"), (7, common[2], "en"), (7, common[2] + "\n\n", "en")]
    rows += [(300, (common[3] + "\n") * 20_000 + "x" * 2_000_000, "en")]
    return rows


def brute_lines(rows, least, least_docs):
    key = lambda x: lower(x.strip(BLANK))
    held = defaultdict(set)
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                held[key(x)].add(i)
    last = {k: max(i for i in ids if i is not None) for k, ids in held.items() if len(ids) >= least_docs}
    out = []
    for i, t, _ in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if key(x) not in last or last[key(x)] == i]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup(spark, batches):
    docs = make_docs(spark, line_rows())
    got = lines.drop_repeated_lines(docs, batches=batches)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    found = sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()], key=repr)
    assert found == brute_lines(line_rows(), 40, 5)
    assert sum(r[2] for r in found) > 20
    assert got.where("_row = 1 and fp = 7 and key = 'k'").count() == len(found)


def test_line_dedup_of_an_empty_table(spark):
    assert lines.drop_repeated_lines(make_docs(spark, line_rows()).limit(0)).count() == 0


def test_runs_are_levelled_and_batches_are_added_once(spark, tmp_path):
    name = f"runs_{uuid.uuid4().hex[:8]}"
    keyed = spark.range(4000).select(F.md5((F.col("id") % 300).cast("string")).cast("binary").alias("key"), F.col("id").alias("doc_id"))
    covers = []
    for n in range(7):
        runs = lines.LineRuns(spark, name, f"file://{tmp_path}")  # opened anew each time
        batch = keyed.where(F.col("doc_id") % 7 == n)
        runs.add(n, batch)
        runs.add(n, batch)
        covers.append(runs.covers())
    assert covers == [[(0, 0)], [(0, 1)], [(0, 1), (2, 2)], [(0, 3)], [(0, 3), (4, 4)], [(0, 3), (4, 5)], [(0, 3), (4, 5), (6, 6)]]
    exact = {bytes(r.key): r.last for r in keyed.groupBy("key").agg(F.max("doc_id").alias("last")).collect()}
    got = {bytes(r.key): (r.n, r.last) for r in runs.counts().collect()}
    assert {k: v[1] for k, v in got.items()} == exact and all(5 <= n <= 14 for n, _ in got.values())
    joined = runs.counts([(0, 3), (4, 5)])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    runs.drop()
    assert runs.covers() == []


def test_what_runs_settle_adds_nothing(spark, tmp_path):
    runs = lines.LineRuns(spark, f"runs_{uuid.uuid4().hex[:8]}", f"file://{tmp_path}", fanout=9)
    one = lambda ids: spark.createDataFrame([(b"k", i) for i in ids], "key binary, doc_id long")
    runs.add(0, one([10, 11, 12, 13, 14]))
    runs.add(1, one([1, 2, 3]))
    runs.add(2, one([20, None]))
    assert [spark.table(f"{runs.name}_{i}_{i}").count() for i in range(3)] == [1, 0, 1]
    assert [tuple(r) for r in runs.counts().collect()] == [(b"k", 7, 20)]
    runs.drop()


def brute_search(rows, items, k):
    docs = [(i, Counter(WORD.findall(lower(t or "")))) for i, t, _ in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(WORD.findall(lower(text or ""))) if t in c)
            if s > 0:
                scored.append((-s, i is None, i, s))
        out += [(item, r + 1, x[2], x[3]) for r, x in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block_terms", "block_docs"), [(200_000, 16_384), (15, 16_384), (200_000, 7)])
def test_search(spark, corpus, monkeypatch, block_terms, block_docs):
    rng = random.Random(1)
    extra = [(1000 + i, " ".join(rng.choice(["alpha", "beta", "gamma", f"w{rng.randint(0, 90)}"]) for _ in range(rng.randint(1, 40))), "en") for i in range(300)]
    rows = [*corpus, *extra, (5000, "alpha " * 200_000, "en")]
    long = " ".join(f"w{i}" for i in range(150))  # more terms than one word of a mask holds
    items = [(1, "The red bolt: ALPHA, alpha"), (2, "beta gamma w3 w4 w5 été"), (3, long), (4, None), (5, "?!"), (None, "gamma"), (6, "nowhere-to-be-found"), (2, "steel's")]
    monkeypatch.setattr(search, "BLOCK_DOCS", block_docs)
    bench = spark.createDataFrame([(*x, 1, "z") for x in items], "item_id long, text string, rank int, id string")
    got = search.search(make_docs(spark, rows), bench, block_terms=block_terms)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_search(rows, items, 10)


def test_groups_that_cannot_win_are_not_evaluated(monkeypatch):
    n = 5000
    owner = np.concatenate([np.arange(n), np.arange(20)])
    terms = np.concatenate([np.zeros(n, np.int32), np.ones(20, np.int32)])
    block = search.Block(np.arange(n), np.zeros(n, bool), owner, terms, np.concatenate([np.full(n, 3), np.full(20, 100)]))
    seen = []
    real = block.scores
    monkeypatch.setattr(block, "scores", lambda docs, held: seen.append(len(docs)) or real(docs, held))
    best = search.Best(10)
    search.rank_block(block, [np.array([0, 1])], [best])
    assert best.doc.tolist() == list(range(10)) and best.score.tolist() == [103] * 10
    assert seen == [20]


def test_search_of_empty_tables(spark, corpus):
    bench = spark.createDataFrame([(1, "red bolt")], "item_id long, text string")
    docs = make_docs(spark, corpus)
    assert search.search(docs.limit(0), bench).count() == 0
    assert search.search(docs, bench.limit(0)).count() == 0


def brute_negatives(rows, every):
    out = []
    ok = [(v, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * np.float64(np.float32(x))) for x in e]) for v, e, label in rows if v is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for a, la, qa in ok:
        if a % every:
            continue
        others = [(dot(qa, q), v, label) for v, label, q in ok if v != a]
        order = sorted(others, key=lambda x: (-x[0], x[1]))
        for ps, p, _ in [x for x in order if x[2] == la][:5]:
            good = [x for x in order if x[2] != la and 50 * ps <= 100 * x[0] <= 95 * ps][:3]
            out += [(a, p, r + 1, x[1], ps, x[0]) for r, x in enumerate(good)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 3])
def test_hard_negatives(spark, block):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * rng.uniform(0.1, 2) + rng.normal(size=8) * 0.3).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    rows += [(500 + i, rows[20][1], 1) for i in range(60)]  # copies
    rows += [(600, [0.0] * 8, 2), (601, None, 1), (602, [0.5] * 8, None), (603, [float("nan")] + [0.1] * 7, 1), (604, [float("inf")] + [0.1] * 7, 1), (605, [None] + [0.1] * 7, 1)]
    rows += [(None, [0.3] * 8, 1), (606, [0.9, 0.8], 3), (607, [], 1), (610, [-0.4] * 8, 2)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, rank int, owner long")
    got = negatives.hard_negatives(negatives.prepared(df), F.col("vec_id") % 10 == 0, block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, 10)
    assert negatives.hard_negatives(negatives.prepared(df.limit(0)), F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("scale", [1, 1 << 24])
def test_pruning_keeps_every_row_that_reaches_the_floor(scale):
    rng = np.random.default_rng(4)
    q = rng.normal(size=(900, 6))
    q = (q / np.linalg.norm(q, axis=1, keepdims=True) * rng.uniform(80, 90, size=(900, 1))).astype(np.int64) * scale
    q[:5] = 0
    anchors = q[5:60]
    exact = np.array([[int(sum(int(x) * int(y) for x, y in zip(r, a, strict=True))) for a in anchors] for r in q], dtype=object)
    sparse = 0
    for part in (np.arange(5, 900), np.arange(900)):
        bucket = negatives.Bucket(part, np.zeros(len(part), int), q[part])
        for quantile in (0.0, 0.5, 0.9, 0.999, 1.0):
            floors = np.array([int(sorted(exact[:, j])[int(quantile * 899)]) for j in range(len(anchors))])
            met = set()
            for some, rows, scores in bucket.verified(anchors, floors):
                sparse += len(some) == 1 and len(rows) < len(part)
                r, c = np.nonzero(scores >= floors[some])
                assert all(int(scores[i, j]) == exact[part[rows[i]], some[j]] for i, j in zip(r, c, strict=True))
                met |= set(zip(part[rows[r]].tolist(), some[c].tolist(), strict=True))
            assert met == {(int(i), j) for i in part for j in range(len(anchors)) if exact[i, j] >= floors[j]}
    assert sparse > 50
