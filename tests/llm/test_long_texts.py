"""Texts of megabytes, odd tables through the pipeline, and the votes of the language machines, against plain versions."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import make_docs
from test_round3_ops import brute_lines, brute_search
from test_text_ops import brute_contamination, brute_fingerprint, brute_measures
from tokenizers import Tokenizer

import corpus_pipeline
from tenderspark.llm import bpe, decontaminate, language, lines, quality, search, simhash, substrings, warc
from tenderspark.llm.q_text import vocabulary

ITEM = " ".join(f"q{i}" for i in range(20))


def long_rows():
    """Two texts of some megabytes that share a passage, one of them one line, and a short one."""
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    first = " ".join(rng.choice(["steel", "Bolt", "été", "ring"]) + str(rng.randint(0, 9999)) for _ in range(250_000))
    second = "\n".join(" ".join(f"v{rng.randint(0, 99999)}" for _ in range(9)) for _ in range(30_000))
    return [(3, f"{first} {passage} {ITEM}", "en"), (8, f"{second}\n{passage}\n", "fr"), (9, "a short text", None)]


@pytest.fixture(scope="module")
def rows():
    out = long_rows()
    assert min(len(t) for _, t, _ in out[:2]) > 1_500_000
    return out


def test_contamination_of_long_texts(spark, rows):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    got = decontaminate.contamination(make_docs(spark, rows), bench).collect()
    ws = {i: len(decontaminate.words(t.encode())) for i, t, _ in rows}
    assert {(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got} == {(3, ws[3], 20, False), (8, ws[8], 0, False), (9, 3, 0, False)}
    short = [(1, rows[0][1][-400:], None)]
    got = decontaminate.contamination(make_docs(spark, short), bench).first()
    assert (got.doc_id, got.n_words, got.n_hit, list(got["items"]), got.contaminated) == brute_contamination(short, [(1, ITEM)], 13)[0]


def test_repeats_of_long_texts(spark, rows):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.remove_repeats(make_docs(spark, rows), with_text=False).collect()}
    assert got == {3: (250_080, 0), 8: (270_060, 60), 9: (3, 0)}


def test_tokens_of_long_texts(spark, rows):
    tok = Tokenizer.from_file(vocabulary())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.encode_documents(make_docs(spark, rows), vocabulary(), digests=True).collect()}
    for i, t, _ in rows:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_fingerprints_and_measures_of_long_texts(spark, rows):
    got = {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(make_docs(spark, rows)).collect()}
    assert got == {i: brute_fingerprint(t, 4) for i, t, _ in rows}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.quality_verdicts(make_docs(spark, rows), labels).collect()}
    want = {i: brute_measures(t) for i, t, _ in rows}
    assert all(got[i][0] == want[i][0] and got[i][-1] == want[i][5] for i in got)


def test_lines_and_search_of_long_texts(spark, rows):
    more = rows + [(20 + i, f"{rows[1][1].splitlines()[7]}\nown line {i}", "en") for i in range(5)]
    got = lines.drop_repeated_lines(make_docs(spark, more)).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=repr) == brute_lines(more, 40, 5)
    bench = [(1, ITEM), (2, "a short steel12 v77")]
    found = search.search(make_docs(spark, more), spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_search(more, bench, 10)


def test_archives_are_read_in_slices(monkeypatch):
    """Records of all sizes, read by slices that end anywhere in them; an archive that is cut is refused."""
    import zstandard

    rng = random.Random(3)
    bodies = [bytes(rng.randbytes(n)) for n in (0, 1, 70, 5000, 200_000)]
    head = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {}"
    frames = [zstandard.ZstdCompressor().compress(head.format(len(b)).encode() + b"\r\n\r\n" + b) for b in bodies]
    for size in (1, 7, 1000, 1 << 20):
        monkeypatch.setattr(warc, "SLICE", size)
        assert [body for _, body in warc.parsed(b"".join(frames))] == bodies
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parsed(b"".join(frames)[:-3]))


def tables(spark, path, rows, extra=""):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.selectExpr("doc_id", "text", "lang", "'s' source", "length(text) n_chars", *([extra] if extra else [])).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_of_an_empty_table(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_keeps_one_of_near_copies_whatever_other_columns_are_called(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(120)) for _ in range(8)]
    near = texts[0].split()
    near[60] = "changed"  # five of 116 shingles: similar by shingles, not by fingerprint
    assert (brute_fingerprint(texts[0], 4) ^ brute_fingerprint(" ".join(near), 4)).bit_count() > 4
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(50, " ".join(near), "en"), (51, texts[3], "en"), (52, None, None), (53, f"{ITEM} {texts[4][:200]}", "en")]
    tables(spark, tmp_path, rows, "named_struct('th', 1, 'text', 'x') as _row")
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == list(range(8))


def test_votes_of_the_language_machines():
    """Wins, ties and the score of families and of languages, one text at a time."""
    rng = np.random.default_rng(5)
    families = ["a", "b", "=x"]
    members = {"a": ["a1", "a2", "a3"], "b": ["b1", "b2"], "=x": ["x"]}
    cols, pairs = [], {}
    for level, n in [("", 3), ("a", 3), ("b", 2), ("=x", 1)]:
        pairs[level] = [(i, j, len(cols) + k) for k, (i, j) in enumerate((i, j) for i in range(n) for j in range(i + 1, n))]
        cols += [rng.normal(size=language.DIM) for _ in pairs[level]]
    model = language.Model(np.stack(cols, axis=1).astype(np.float32), rng.normal(size=len(cols)).astype(np.float32) * 0.1, families, members, pairs)
    texts = [" ".join(rng.choice(["aba", "bolt", "été", "zz", "xyzzy"], size=rng.integers(1, 9))) for _ in range(60)]
    margins = language.features(texts) @ model.weights + model.bias

    def voted(row, level, n):
        wins, total = Counter(), Counter()
        for i, j, c in pairs[level]:
            wins[i if row[c] > 0 else j] += 1
            total[i] += row[c]
            total[j] -= row[c]
        best = max(range(n), key=lambda k: (wins[k], total[k], -k))
        own = [row[c] if i == best else -row[c] for i, j, c in pairs[level] if best in (i, j)]
        return best, 1 / (1 + math.exp(-3 * min(own))) if own else 1.0

    names, scores = model.predict(texts)
    seen = set()
    for row, name, score in zip(margins, names, scores, strict=True):
        f, p = voted(row, "", 3)
        k, q = voted(row, families[f], len(members[families[f]]))
        assert name == members[families[f]][k] and abs(score - p * q) < 1e-5
        seen.add(name)
    assert len(seen) >= 3
    assert language.fitted(np.zeros((0, language.DIM), np.float32), []).predict(["x"])[0] == ["und"]
