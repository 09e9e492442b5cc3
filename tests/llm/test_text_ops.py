"""Contamination, substring dedup, SimHash, quality and BPE against plain versions, with the odd rows in the table."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import pytest
from conftest_llm import make_docs
from pyspark.sql import functions as F

from tenderspark.llm import bpe, decontaminate, quality, simhash, substrings
from tenderspark.llm.components import connected_components
from tenderspark.llm.q_text import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def brute_contamination(rows, items, n):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for i, t, _ in rows:
        ws = word.findall(lower(t or ""))
        hit, found = set(), set()
        for item, it in items:
            iw = word.findall(lower(it or ""))
            k = min(n, len(iw))
            for p in range(len(iw) - k + 1 if k else 0):
                for q in range(len(ws) - k + 1):
                    if ws[q : q + k] == iw[p : p + k]:
                        hit |= set(range(q, q + k))
                        if item is not None:
                            found.add(item)
        out.append((i, len(ws), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1_000_000, 12])
def test_contamination(spark, corpus, block):
    items = [(1, "The red BOLT, été de x9"), (10, "ring a b"), (9, None), (8, "..."), (None, "Über ring"), (2, " ".join(corpus[9][1].split()[:9]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(spark, corpus)
    got = decontaminate.contamination(docs, bench, window=5, block_windows=block).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got], key=repr) == brute_contamination(corpus, items, 5)
    kept = decontaminate.drop_contaminated(docs, bench, window=5)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.contaminated for r in got)


def test_spans_are_cut_and_empty_tables_work(spark, corpus):
    docs = make_docs(spark, [(1, "Keep this, red bolt ring! And this.", "en"), (2, None, "en")])
    bench = spark.createDataFrame([(1, "RED bolt ring")], "item_id long, text string")
    assert {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()} == {1: "Keep this, ! And this.", 2: None}
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def brute_repeats(rows, n):
    texts = [(i, WORD.findall(t or "")) for i, t, _ in rows]
    first = {}
    for i, ws in texts:
        if i is not None:
            for p in range(len(ws) - n + 1):
                g = tuple(ws[p : p + n])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, ws in texts:
        gone = set()
        for p in range(len(ws) - n + 1) if i is not None else ():
            if first[tuple(ws[p : p + n])] < i:
                gone |= set(range(p, p + n))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "group"), [(10, 1 << 20), (10, 200), (5, 100), (33, 1 << 20), (33, 600), (50, 2000)])
def test_substring_dedup(spark, corpus, window, group):
    got = substrings.remove_repeats(make_docs(spark, corpus), window=window, group=group).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=repr) == brute_repeats(corpus, window)


def test_substring_dedup_same_id_other_text(spark):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    rows = [(1, a, "en"), (2, b + " " + a, "en"), (2, a + " " + b, "en"), (2, b, "en"), (3, b, "en")]
    got = substrings.remove_repeats(make_docs(spark, rows), window=10).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=repr) == brute_repeats(rows, 10)
    assert substrings.remove_repeats(make_docs(spark, rows).limit(0)).count() == 0


def test_substring_dedup_of_repetitive_near_copies(spark):
    """Long texts that repeat one line, in many near copies: few segments, and no group above its bound."""
    rng = random.Random(12)
    line = "the same nine words of one line over again".split()
    rows = []
    for i in range(60):
        words = line * 220
        for _ in range(3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en"))
    docs, group = make_docs(spark, rows), 20_000
    got = substrings.remove_repeats(docs, group=group).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=repr) == brute_repeats(rows, 50)
    rows_of, schema = substrings._segments(50)
    given = docs.selectExpr("doc_id", "xxhash64(text) as th", "cast(text as binary) as text")
    keys = {i: sorted(set(substrings.Words(t.encode()).segments(50)[0].view("int64").tolist())) for i, t, _ in rows}
    shared = spark.createDataFrame(list(keys.items()), "doc_id long, shared array<long>")
    members = given.join(shared, "doc_id").select("doc_id", "th", "text", "shared").mapInArrow(rows_of, schema)
    distinct = members.groupBy("sid").agg(F.any_value("key").cast("string").alias("key"), F.max("words").alias("words"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).withColumn("place", F.lit(0))
    assert distinct.count() < 60 * 3 * 60
    census = substrings.census_of(distinct.withColumn("size", F.length("words").cast("long")), group)
    assert census.where("long").count() > 0
    fitting, windows = substrings.grouped(distinct, census, group, 50)
    assert len(fitting) > 1
    for table in fitting:
        assert (table.groupBy("key").agg(F.sum(F.length("words")).alias("n")).agg(F.max("n")).first()[0] or 0) <= group


def test_suffix_tree_nodes():
    import numpy as np

    lines = [b"a b c d e f", b"x b c d e y", b"a b c d e f"]
    seg, first, last, low = substrings.suffix_tree_repeats(lines, np.array([5, 3, 7]), np.array([5, 3, 7]), 4)
    assert sorted(zip(seg.tolist(), first.tolist(), last.tolist(), low.tolist(), strict=True)) == [(0, 0, 0, 5), (0, 1, 1, 3), (0, 2, 2, 5), (1, 1, 1, 3), (2, 0, 0, 5), (2, 1, 1, 3), (2, 2, 2, 5)]


def brute_fingerprint(t, k):
    import xxhash

    ws = WORD.findall(lower(t or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[p : p + k]) for p in range(len(ws) - k + 1)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    root = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(nodes, 2):
            if linked(a, b) and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def test_covering_masks_cover_every_small_difference():
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    rng = random.Random(0)
    for _ in range(3000):
        bits = rng.sample(range(64), 4)
        assert any(all(not m >> b & 1 for b in bits) for m in masks)


def test_fingerprints_and_components(spark, corpus):
    got = simhash.near_duplicates(make_docs(spark, corpus)).collect()
    assert len(got) == len(corpus)
    fps = [brute_fingerprint(t, 4) for _, t, _ in corpus]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((i or -1, f"{f:016x}") for (i, _, _), f in zip(corpus, fps, strict=True))
    root = brute_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for (i, _, _), f in zip(corpus, fps, strict=True):
        if i is not None:
            low[root[f]] = min(low.get(root[f], i), i)
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == sorted((i or -1, low[root[f]]) for (i, _, _), f in zip(corpus, fps, strict=True))


def test_links_in_dense_and_large_buckets(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(60)} | {0, 15, 255, (1 << 64) - 1}
    nodes = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in nodes]
    links = simhash.fingerprint_links(spark.createDataFrame([(s, s) for s in signed], "fp long, rep long")).collect()
    root = {s: s for s in signed}

    def up(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        root[max(up(r.a), up(r.b))] = min(up(r.a), up(r.b))
    want = {s: s for s in signed}

    def up2(x):
        while want[x] != x:
            x = want[x]
        return x

    for a, b in itertools.combinations(range(len(nodes)), 2):
        if (nodes[a] ^ nodes[b]).bit_count() <= 4:
            x, y = up2(signed[a]), up2(signed[b])
            want[max(x, y)] = min(x, y)
    assert [up(s) for s in signed] == [up2(s) for s in signed]


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (20, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 7: 7, 8: 7, 9: 7} | {100 + i: 100 for i in range(41)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark, corpus):
    docs = make_docs(spark, corpus)
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in found if i is None or i == c}


def brute_measures(t):
    t = t or ""
    ws = WORD.findall(t)
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(grams)
    rep = {p + k for p, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), sum(x in lines[:k] for k, x in enumerate(lines)), len(rep)


def test_quality_measures(corpus):
    for _, t, _ in [*corpus, (0, "a b c a b c #x\n\na b c", ""), (0, "x\nx\n x\n", "")]:
        assert quality.measures(None if t is None else t.encode())[:6] == brute_measures(t)


def test_binomial_tail():
    assert quality.binomial_tail(9_900_000, 10**9, 0.01) < 1e-9 and quality.binomial_tail(10_100_000, 10**9, 0.01) > 1 - 1e-9
    for n, k, p in [(10, 3, 0.2), (50, 0, 0.04), (7, 7, 0.3), (0, 0, 0.5), (400, 30, 0.04), (400, 2, 0.04)]:
        want = 1.0 if n == 0 else sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_tail(k, n, p) - want) < 1e-9


def test_quality_cutoffs_keep_their_promise(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(2400):
        bad = i % 6 == 0
        mark = "#%" if bad else ("#" if rng.random() < 0.001 else "")
        rows.append((i, " ".join(f"w{rng.randint(0, 10**6)}{mark}" for _ in range(60)), "en"))
        labels.append((i, 0 if bad else 1))
    rows += [(5000, "few words", "en"), (5001, None, None), (5002, " ".join(["a b c"] * 40), "xx")]
    docs = make_docs(spark, rows)
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (1, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_verdicts(docs, lab).collect()}
    assert not got[5000].kept and not got[5001].kept and got[5002].base_failed
    good = [got[i].kept for i, q in labels if q == 1]
    assert sum(not k for k in good) <= quality.RISK * len(good)
    assert not any(got[i].kept for i, q in labels if q == 0)
    kept = quality.keep_good(docs, lab)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    none = quality.quality_verdicts(docs, lab.limit(0)).where("size(failed_rules) > 0").count()
    assert none == 0 and quality.quality_verdicts(docs.limit(0), lab).count() == 0


@pytest.mark.parametrize("bits", [2, 5, 10])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_agrees_with_the_library(bits, name, corpus):
    """The second vocabulary keeps spaces, as the start of the word that follows."""
    import public_tokenizers

    enc = bpe.ChunkEncoder(public_tokenizers.path(name), bits)
    odd = ["it's we'll <|endoftext|> x<|startoftext|>y", "İstanbul ΟΔΟΣ ﬁ é", "x" * 6000, "a" * 3000 + " " + "é" * 3000, "   ", "中文字" * 700, " wide space", "é ́x", "one two three four five " * 4000, "a " * 500, "x  y   z\n\n q 1 2\t3 " * 300]
    texts = [t or "" for _, t, _ in corpus] + odd
    for part in (texts, texts[::-1]):  # the second time from memory
        got = enc.encode_many([t.encode() for t in part])
        assert got == [(ids, " ".join(map(str, ids))) for ids in (enc.tok.encode(t, add_special_tokens=False).ids for t in part)]
    assert enc.encoded < enc.asked


def test_bpe_refuses_vocabularies_that_reach_across_spaces(tmp_path):
    import json

    base = json.loads(open(vocabulary(), encoding="utf-8").read())
    base["added_tokens"][0]["lstrip"] = True
    (tmp_path / "v.json").write_text(json.dumps(base))
    with pytest.raises(ValueError, match="reach across"):
        bpe.ChunkEncoder(str(tmp_path / "v.json"))
    base["added_tokens"][0]["lstrip"] = False
    base["pre_tokenizer"] = {"type": "Split", "pattern": {"String": "|"}, "behavior": "Isolated", "invert": False}
    base["normalizer"], base["model"]["end_of_word_suffix"] = None, None
    base["model"]["merges"], base["model"]["vocab"] = [[",", " "], [", ", "a"]], {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz., ")} | {", ": 40, ", a": 41}
    base["added_tokens"] = []
    (tmp_path / "w.json").write_text(json.dumps(base))
    with pytest.raises(ValueError, match="reach across"):
        bpe.ChunkEncoder(str(tmp_path / "w.json"))


def test_bpe_widens_joins_step_by_step():
    a = lambda *x: [*x]
    agreed = bpe.ChunkEncoder.agreed
    assert agreed(a(5), a(5, 1, 2, 7), a(7), a(4, 5), a(7, 8)) == [1, 2]
    assert agreed(a(5), a(9, 1, 2, 7), a(7), a(4, 5), a(7, 8)) is None and agreed(a(5), a(5, 1, 7), a(7), a(4, 6), a(7)) is None
    assert agreed(a(), a(1, 7), a(7), None, a(7, 8)) == [1]


def test_bpe_table(spark, corpus):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary())
    got = bpe.encode_documents(make_docs(spark, corpus), vocabulary(), digests=True, carry=True).collect()
    want = []
    for i, t, _ in corpus:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    assert sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got], key=repr) == sorted(want, key=repr)
    assert got[0]["_row"]["key"] == "k"
    assert bpe.encode_documents(make_docs(spark, corpus).limit(0), vocabulary()).count() == 0


def test_copies_take_one_component(spark):
    rows = [(i, "one two three four five six seven", "en") for i in range(9, 400)] + [(5, None, "en"), (6, "", "en")]
    got = simhash.near_duplicates(make_docs(spark, rows)).groupBy("component_id").agg(F.count("*").alias("n")).collect()
    assert {(r.component_id, r.n) for r in got} == {(9, 391), (5, 2)}


def test_keep_one_tells_rows_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, "en"), (1, a, "en"), (2, a, "en"), (2, b, "en"), (None, c, "en"), (None, c, "en"), (3, " ".join(f"d{i}" for i in range(60)), None)]
    got = simhash.keep_one(make_docs(spark, rows)).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted({(i, t) for i, t, _ in rows} - {(2, a)}, key=repr)


def test_keep_one_finds_all_pairs_of_similarity(spark):
    rng = random.Random(6)
    rows = []
    for base in range(0, 120, 4):
        words = [f"w{rng.randint(0, 9999)}" for _ in range(200)]
        for k in range(4):
            changed = [*words]
            at = rng.randint(0, 150)
            changed[at : at + 9 * k] = [f"x{rng.randint(0, 9999)}" for _ in range(9 * k)]
            rows.append((base + k + 1, " ".join(changed), "en"))
    sets = [{tuple(t.split()[p : p + 5]) for p in range(len(t.split()) - 4)} for _, t, _ in rows]
    fps = [brute_fingerprint(t, 4) for _, t, _ in rows]
    near = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4 or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    root = brute_components(range(len(rows)), near)
    got = simhash.keep_one(make_docs(spark, rows), similarity=0.8)
    assert {r.doc_id for r in got.collect()} == {rows[i][0] for i in set(root.values())}
    assert simhash.keep_one(make_docs(spark, rows)).count() > len(set(root.values()))
