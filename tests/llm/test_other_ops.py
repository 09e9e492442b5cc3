"""Secrets, licences, archives, language and toxicity on small tables; the pipeline against its stages' plain versions."""

import base64
import hashlib
import os
import random
import re

import numpy as np
import pytest
from conftest_llm import make_docs

import corpus_pipeline
from tenderspark.llm import language, licenses, secrets, toxicity, warc

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def brute_base(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


HEX = "0123456789abcdef" * 2
SECRETS = [
    (1, 'x token = "abcdefgh12" y', "en"), (2, "Über PASSWORD: short secret=token: abcdefghij", "en"), (3, f"é AKIA{'Z9' * 8} and {HEX}", "en"), (4, None, "en"), (5, "", None),
    (6, f"api_key={HEX}{HEX}", "en"), (7, "\n".join(f"passwd='{i:09d}x' é AKIA{'A' * 12}" for i in range(1500)), "en"), (8, "mail me a.b@c.example.com password=supersecret1", "en"),
    (9, "mail me a.b@c.example.com " + "z " * 300 + " password=supersecret1", "en"), (10, "login: someone https://h.example.com/x aB3" + "xY9" * 10, "en"), (11, "aB3" + "xY9" * 10, "en"), (1, 'x token = "abcdefgh12" y', "en"), (None, "secret=12345678", "en"),
]


def test_base_spans_and_links(spark):
    docs = make_docs(spark, SECRETS)
    got = secrets.secret_spans(docs).collect()
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1]))
    base = sorted(((r.doc_id, [(s.start, s.kind, s.end) for s in r.base]) for r in got), key=key)
    assert base == sorted(((i, brute_base(t)) for i, t, _ in SECRETS), key=key)
    more = {r.doc_id: [secrets.KINDS[s.kind] for s in r.spans if s.kind >= 3] for r in got}
    assert more[8] == ["mail"] and more[9] == [] and more[11] == []
    assert sorted(more[10]) == ["endpoint", "random", "user"] or sorted(more[10]) == ["random", "user"]
    assert secrets.secret_spans(docs.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["a", "a.", "aB1", "password: "])
def test_secrets_of_very_long_runs(spark, piece):
    n = 5_000_000 // len(piece)
    text = "x@" + piece * n + " token=abcdefgh12"
    docs = spark.range(1).selectExpr("id as doc_id", f"concat('x@', repeat('{piece}', {n}), ' token=abcdefgh12') as text")
    got = secrets.secret_spans(docs).first()
    assert [(s.start, s.kind, s.end) for s in got.base] == brute_base(text)


def test_a_cluster_must_name_the_shared_folder(spark, monkeypatch):
    from tenderspark.llm import common

    class Context:
        _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"isLocal": staticmethod(lambda: False)}))})
        getConf = staticmethod(dict)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(type("Session", (), {"sparkContext": Context}))
    assert common.shared_folder(spark)


def test_redaction(spark):
    docs = make_docs(spark, [(1, 'é token = "abcdefgh12" y', "en"), (2, None, "en"), (3, "clean", "en"), (4, f"token={HEX} z", "en")])
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: 'é [assign]" y', 2: None, 3: "clean", 4: "[assign] z"}


def test_licences(spark):
    mit = licenses.TEXTS["MIT"]
    changed = "Copyright (c) 2021 Someone\nAll rights reserved.\n" + mit.replace("sublicense", "sublicence").upper().replace(",", " ;").replace(" ", "\n * ")
    header = "/*\n * " + licenses.TEXTS["Apache-2.0"].replace("\n", "\n * ").replace(" compliance with", "\n * compliance with") + "\n */\n\ncode()"
    rows = [(1, mit, "en"), (2, changed, "en"), (3, mit + "\n\nand more", "en"), (4, None, "en"), (5, "", "en"), (6, "text\nLicenced under the Apache Licence, version 2.0\nmore", "en"), (1, mit, "en"), (7, "MIT License\n\nCopyright 2020 A B\n\n" + mit, None), (8, header, "en"), (9, mit + " and more", "en"), (10, ("x " * 400 + "\n") * 3000 + "Licensed under CC BY 4.0.", "en"), (None, mit, "en")]
    rows += [(20 + i, t, "en") for i, t in enumerate(licenses.TEXTS.values())]
    got = {}
    for r in licenses.license_matches(make_docs(spark, rows), licenses.known_licenses(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.whole_license, tuple(r.line_licenses), r.n_lines_matched, r.n_blocks_matched))
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == [("MIT", ("MIT",), 3, 0)] * 2 and got[None] == got[1][:1] and got[2][0][0] == "MIT" and got[3] == [(None, ("MIT",), 3, 0)]
    assert got[4] == got[5] == [(None, (), 0, 0)] and got[6] == [(None, ("Apache-2.0",), 1, 0)] and got[7][0][0] == "MIT"
    assert got[8] == [(None, ("Apache-2.0",), 1, 1)] and got[9] == [(None, ("MIT",), 2, 0)] and got[10] == [(None, ("CC-BY-4.0",), 1, 0)]
    assert [got[20 + i][0][0] for i in range(len(licenses.TEXTS))] == list(licenses.TEXTS)
    assert licenses.license_matches(make_docs(spark, rows).limit(0), licenses.known_licenses(spark)).count() == 0


def test_long_licence_texts_have_the_fixed_digests(spark):
    files = {k: f"/usr/share/common-licenses/{n}" for k, n in [("GPL-3.0", "GPL-3"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0")]}
    rows = [(i, open(f).read().upper(), k) for i, (k, f) in enumerate(files.items()) if os.path.exists(f)]
    got = licenses.license_matches(make_docs(spark, rows), licenses.known_licenses(spark)).collect()
    assert {r.doc_id: r.whole_license for r in got} == {i: k for i, _, k in rows}


@pytest.mark.parametrize(("least", "size"), [(0, 1 << 20), (10, 500)])
def test_archives(spark, least, size):
    rows = [(i, f"http://x/{i}", random.Random(i % 7).choice(["<p>", ""]) * 3 + "é" * (i % 7)) for i in range(40)] + [(100, None, None), (101, "u\nv", None), (None, "n", "lost"), (7, "again", "é"), (7, "again", "é"), (102, "big", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    path = warc.archive_folder(spark)
    warc.write_archives(pages, path, revisit_min_bytes=least, archive_bytes=size)
    got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        revisit = i is not None and len(raw) >= least and i < max(same)
        want.append((i or -1 if i is None else i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", max(same) if revisit else None))
    assert [(a if a else 0, *b) for a, *b in got] == sorted((0 if a == 0 else a, *b) for a, *b in want) or sorted(map(str, got)) == sorted(str((a or -1, *b)) for a, *b in want)
    warc.write_archives(pages.limit(0), path + "-none")
    assert warc.read_archives(spark, path + "-none").count() == 0


def test_archives_hash_a_payload_once_per_pass(spark):
    """Three passes over the payloads are planned, each with one SHA-1; the joins' null checks add none."""
    pages = spark.createDataFrame([(1, "u", "<p>"), (2, "u", None)], "page_id long, url string, html string")
    plan = warc.planned(pages, "page_id", "url", "html", 0, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha1(") == 3 and plan.count("Join") == 2


WORDS = {"en": "the and that with from this have which".split(), "de": "und der die nicht eine werden über schon".split(), "fr": "les des une est dans pour être déjà".split(), "es": "los las una por para está según niño".split()}


def test_language(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(4, 40))), lang) for i in range(400) for lang in [list(WORDS)[i % 4]]]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !!", "en"), (1004, "²½ ①", "en"), (1005, "und nicht " * 300_000, "de"), (1003, "the that", None), (None, "und nicht", "de")]
    docs = make_docs(spark, rows)
    model = language.learned(docs, per_language=40)
    assert set(model.members) == {"germanic", "romance"}
    got = {r.doc_id: r for r in language.identified(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows[:400] if got[i].held_out]) > 0.97
    assert {got[i].lang_pred for i in (1000, 1001, 1002, 1004)} == {"und"} and got[1003].lang_pred == "en" and got[None].lang_pred == got[1005].lang_pred == "de"
    nothing = language.learned(docs.limit(0))
    assert {r.lang_pred for r in language.identified(docs, nothing).collect()} == {"und"}


def test_network_gradients():
    rng = np.random.default_rng(0)
    c = toxicity.Corpus([b"you stupid clown go away now", b"a nice day to all of you my friends"])
    text, first, size = c.windows()
    idx, live = toxicity.placed(c, first, size)
    net = toxicity.Network()
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    y, w = np.array([1.0, 0.0]), np.array([0.6, 0.4])
    g, loss = net.gradients(c, idx, live, y, w)

    def loss_at():
        prob = toxicity.sigmoid(net.forward(net.inputs(c).astype(np.float64), idx, live))
        return -(w * np.log(np.where(y > 0.5, prob, 1 - prob))).sum()

    for k in ("hf", "hb", "xf", "xb", "cf", "attend", "ask", "out", "bias"):
        at = tuple(rng.integers(0, s) for s in net.p[k].shape)
        keep, eps = net.p[k][at], 1e-4
        net.p[k][at] = keep + eps
        up = loss_at()
        net.p[k][at] = keep - eps
        down = loss_at()
        net.p[k][at] = keep
        assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-3, k


def test_scoring_is_the_network_over_all_windows():
    """``full_logits`` against ``forward``, and a document's score against a plain loop over its windows."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["moron", "a", "fine", "day", "été", "x" * 40]) for _ in range(n)).encode() for n in (1, 31, 32, 33, 48, 200)] + [b"", b"so " * 90]
    net = toxicity.Network()
    c = toxicity.Corpus(texts)
    for stride in (toxicity.STRIDE, 1):
        _, first, size = c.windows(stride)
        by_hand = np.concatenate([net.forward(net.inputs(c), *toxicity.placed(c, first[i : i + 1], size[i : i + 1])) for i in range(len(first))])
        assert np.abs(net.score_windows(c, first, size) - by_hand).max() < 1e-4
        want = []
        for t in texts:
            ws, logits = t.split(), []
            for p in sorted({*range(0, max(0, len(ws) - toxicity.T) + 1, stride), max(0, len(ws) - toxicity.T)}) if ws else ():
                one = toxicity.Corpus([b" ".join(ws[p : p + toxicity.T])])
                logits.append(net.score_windows(one, *one.windows()[1:])[0])
            want.append(max(logits) if logits else net.p["bias"][0] - 2.0)
        assert np.abs(net.score_texts(texts, stride) - toxicity.sigmoid(np.array(want))).max() < 1e-4


def test_toxicity_learns_bounded_pieces(spark):
    assert toxicity.pieces(b"a b c d e", 1, most=9, size=2) == [b"a b", b"c d", b"e"]
    cut = toxicity.pieces(" ".join(f"w{i}" for i in range(1000)).encode(), 1, most=3, size=10)
    assert len(cut) == 3 and all(len(p.split()) == 10 for p in cut) and toxicity.pieces(b"x" * 10_000 + b" y", 1) == [b"y"]
    rows = [(7, f"same id {i}", "en") for i in range(300)] + [(8, "you moron " * 60, "en"), (9, None, "en")]
    lab = spark.createDataFrame([(7, 0), (8, 1), (9, 1), (8, 1)], "doc_id long, toxic int")
    net = toxicity.learned(make_docs(spark, rows), lab)
    assert toxicity.scored(make_docs(spark, rows), net).count() == len(rows)


def test_toxicity(spark):
    rng = random.Random(4)
    plain, bad = [f"word{i}" for i in range(300)], ["moron", "scum", "idiot"]
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None, "en"), (901, "", "en"), (902, "so " * 5000, "en"), (None, "you moron scum idiot " * 3, "en")]
    docs = make_docs(spark, rows)
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.learned(docs, lab)).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([got[i].predicted == t for i, t in labels if got[i].held_out]) > 0.95
    assert got[900].score == got[901].score < 0.5 and got[None].predicted == 1
    none = toxicity.learned(docs, lab.limit(0))
    assert toxicity.scored(docs, none).where("predicted = 1").count() == 0 and toxicity.scored(docs.limit(0), none).count() == 0


def test_pipeline_against_plain_stages(spark, tmp_path, corpus):
    import itertools

    from test_text_ops import brute_components, brute_contamination, brute_fingerprint, brute_measures
    from tokenizers import Tokenizer

    from tenderspark.llm.q_text import vocabulary

    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(30, 90))) + (f" token={HEX}" if i % 9 == 0 else ""), "en") for i in range(1, 60)]
    rows += [(100 + i, t, lang) for i, t, lang in rows[:7]] + [(i + 1000 if i else None, t, lang) for i, t, lang in corpus]
    items = [(1, " ".join(rows[20][1].split()[:20])), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("doc_id", "text", "lang", "'s' source", "length(text) n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [r for r in rows if (m := brute_measures(r[1]))[0] >= 50 and 100 * m[5] <= 50 * m[0]]
    fps = [brute_fingerprint(t, 4) for _, t, _ in kept]
    root = brute_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for (i, _, _), f in zip(kept, fps, strict=True):
        if i is not None:
            low[root[f]] = min(low.get(root[f], i), i)
    kept = [r for r, f in zip(kept, fps, strict=True) if r[0] is None or r[0] == low.get(root[f])]
    bad = {x[0] for x in brute_contamination(kept, items, 13) if x[4]}
    kept = [r for r in kept if r[0] not in bad]
    tok = Tokenizer.from_file(vocabulary())
    want = {}
    for i, t, _ in kept:
        ids = tok.encode(t.replace(f"token={HEX}", "[assign]"), add_special_tokens=False).ids
        want[i] = (len(ids), " ".join(map(str, ids)))
    got = {r.doc_id: (r.n_tokens, r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want and bad and len(want) > 20
    assert len(list(itertools.chain(corpus_pipeline.STAGES))) == 5


def test_parts_are_linked_by_the_gap_between_them(spark):
    key = "aB3" + "xY9" * 100
    rows = [(1, f"access {'AKIA' + 'A' * 300} x\n{key}", "en"), (2, f"{key}\nAKIA{'B' * 16}", "en"), (3, f"{key}{' ' * 201}AKIA{'B' * 16}", "en"), (4, f"{key}{' ' * 200}AKIA{'B' * 16}", "en"), (5, f"https://h.example.com/{'p' * 500}\nuser=somebody password=supersecret1", "en")]
    got = {r.doc_id: [secrets.KINDS[s.kind] for s in r.spans if s.kind >= 3] for r in secrets.secret_spans(make_docs(spark, rows)).collect()}
    assert "random" in got[1] and "random" in got[2] and got[3] == [] and got[4] == ["random"] and {"endpoint", "user"} <= set(got[5])
