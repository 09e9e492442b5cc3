"""The expected values of small hand-made inputs: prices, text, extraction, matching, quality, catalogue, ingest."""

import math

import pytest
from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators import catalog as K
from tenderspark.operators import classify as C
from tenderspark.operators import documents as D
from tenderspark.operators import matching as M
from tenderspark.operators import prices as P
from tenderspark.operators import quality as Q
from tenderspark.operators import runs as R
from tenderspark.operators import tables as B
from tenderspark.streaming import ingest as I


def one(spark, expr, *values, schema=None):
    cols = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], schema or ", ".join(f"{c} string" for c in cols))
    return df.select(expr(*[F.col(c) for c in cols]).alias("x")).first().x


@pytest.mark.parametrize(("prices", "factor", "flagged"), [
    ([100, 102, 98, 101, 99, 103], 3, []), ([100, 102, 98, 101, 99, 100000], 3, [5]), ([100, 102, 98, 101, 99, 0.01], 3, [5]), ([100, 102, None, 101], 3, [2]),
    ([100, 102, 0, -5, 101], 3, [2, 3]), ([100, 102, 98, 101, 99, 400], 1, [5]), ([100, 102, 98, 101, 99, 400], 500, []), ([50] * 10, 3, []),
])
def test_price_flags(spark, prices, factor, flagged):
    df = spark.createDataFrame([(i, "A", None if p is None else float(p)) for i, p in enumerate(prices)], "i int, code string, price double")
    assert sorted(r.i for r in P.price_flags(df, ["code"], "price", factor).where("price_flag").collect()) == flagged


def test_bounds_are_per_code(spark):
    rows = [("A", float(p)) for p in (10, 11, 9, 10.5, 9.5)] + [("B", float(p)) for p in (1000, 1100, 900, 1050, 950)]
    assert P.price_flags(spark.createDataFrame(rows, "code string, price double"), ["code"], "price").where("price_flag").count() == 0


def test_sketched_bounds_are_near(spark):
    df = spark.range(10_001).select(F.lit("A").alias("code"), F.col("id").cast("double").alias("price"))
    exact, near = (P.iqr_bounds(df, ["code"], "price", 3.0, a).first() for a in (None, 10_000))
    assert (exact.q1, exact.q3) == (2500.0, 7500.0) and abs(near.q1 - 2500) <= 2 and abs(near.q3 - 7500) <= 2


def test_ranking_drops_thin_codes_and_caps(spark):
    rows = [("A", f"i{k}", "x", float(10 + k)) for k in range(6)] + [("B", "j", "x", 5.0), ("A", "big", "x", 1e6), ("A", "low", "x", 9.0)]
    bands = spark.createDataFrame([("x", 10.0, None)], "category string, price_min double, price_max double")
    out = P.rank_prices(spark.createDataFrame(rows, "code string, item string, category string, price double"), ["code"], "price", "item", bands, "category", 3.0, 2, 3)
    assert [(r.code, r["item"], r.position) for r in out.orderBy("position").collect()] == [("A", "i0", 1), ("A", "i1", 2), ("A", "i2", 3)]


@pytest.mark.parametrize(("text", "value"), [("107.222,00", 107222.0), ("1234.56", 1234.56), ("500", 500.0), ("1.234.567,89", 1234567.89), (None, None), (" ", None), ("abc", None)])
def test_numbers(spark, text, value):
    assert one(spark, T.parse_number_br, text) == value


def test_text_forms(spark):
    assert one(spark, T.norm_text, "  PISTOLA   9MM  ") == "pistola 9mm"
    assert one(spark, T.norm_text, "MUNIÇÃO") == "municao"
    assert one(spark, T.norm_text, "colete\nbalístico") == "colete balistico"
    assert one(spark, T.norm_text, None) == one(spark, T.norm_text, "  ") == ""
    assert one(spark, T.norm_term, "  Colete BALÍSTICO ") == "colete balístico"
    h = lambda d, u: one(spark, T.text_hash, d, u)
    assert h("Munição", "UN") == h("municao", "un") != h("municao", "cx") and h("x", None) == h("x", " ") and len(h("a", "b")) == 40
    assert h("a|b", "c") == h("a", "b|c")
    assert one(spark, T.tokenize_catalog, "Cabo de 9 mm") == ["cabo", "9mm"] and one(spark, T.tokenize_catalog, "de a") == ["de"]
    assert one(spark, T.parse_date, "31/02/2026") is None and str(one(spark, T.parse_date, "2026-01-10T00:00")) == "2026-01-10"
    assert one(spark, lambda c: T.format_money_br(c), 1.999, schema="c0 double") == "2,00"
    assert one(spark, lambda c: T.price_variants(c), 578538.24, schema="c0 double") == ["578538,24", "578.538,24"]
    assert one(spark, lambda c: T.price_variants(c), -10.0, schema="c0 double") == []
    assert str(one(spark, T.parse_timestamp, "2026-01-10T10:11:12.123456789")) == "2026-01-10 10:11:12.123456"


def test_control_numbers(spark):
    p = one(spark, T.parse_control_number, "01664910000131-2-000068/2026")
    assert (p.cnpj, p.seq, p.year, p.act_seq) == ("01664910000131", 68, 2026, None)
    assert one(spark, T.parse_control_number, "00000368000150-1-000009/2026-000001").act_seq == 1
    assert one(spark, T.parse_control_number, "x") is None and one(spark, lambda c: T.document_url(c, F.lit("contract"), "b"), "x") == ""
    url = lambda c, k: one(spark, lambda c, k: T.document_url(c, k, "b"), c, k)
    assert url("00000368000150-1-000009/2026-000001", "act") == "b/atas/00000368000150/2026/9/1"
    assert url("00000368000150-1-000009/2026", "act") == "b/editais/00000368000150/2026/9"


@pytest.mark.parametrize(("found", "qty", "price", "rq", "rp", "status", "gap"), [
    (False, None, None, 1, 1, "not_found", None), (True, 10, 250.5, 10, 250.5, "confirmed", 0.0), (True, 10, 300, 10, 250, "confirmed_differs", 0.2), (True, 5, 10000, 5, 250, "confirmed_price_suspect", 39.0),
    (True, None, 1500, 1, 1500, "confirmed", 0.0), (True, 999, 1, 5, 500, "quantity_differs", None), (True, 10, None, 10, 100, "confirmed_no_price", None), (True, 10, 50, 10, 0, "confirmed_no_reference", None), (True, 3, 107222, 3, 107222, "confirmed", 0.0),
])
def test_extraction_ladder(spark, found, qty, price, rq, rp, status, gap):
    f = lambda x: None if x is None else float(x)
    r = one(spark, D.validate_extraction, found, f(qty), f(price), f(rq), f(rp), schema="c0 boolean, c1 double, c2 double, c3 double, c4 double")
    assert (r.status, r.divergence) == (status, gap)


def window(spark, text, desc, n, price, *args):
    df = spark.createDataFrame([(text, desc, n, price)], "t string, d string, n int, p double")
    return df.select(D.anchor_windows(F.col("t"), F.col("d"), F.col("n"), F.col("p"), *args).alias("w")).first().w


def test_anchor_windows(spark):
    """Expected excerpts by position: the text, not the code, says what is due."""
    phrase = "PISTOLA 9MM CALIBRE ESPECIAL"
    assert window(spark, "x" * 5000 + phrase + "y" * 5000, phrase, 1, None, 9000, 200) == "x" * 200 + phrase + "y" * (200 - len(phrase))
    found = window(spark, "a" * 3000 + "valor unitario: 1.500,00 reais" + "b" * 3000, "algo que não está no texto", None, 1500.0, 9000, 3000, 200)
    assert found == "a" * 184 + "valor unitario: 1.500,00 reais" + "b" * (200 - 14)
    assert window(spark, "z" * 20000, "não existe", None, None) == "z" * 12000
    cut = window(spark, "PISTOLA" + "x" * 50000 + "1.500,00" * 3, "PISTOLA", None, 1500.0, 1000)
    assert cut == "PISTOLA" + "x" * 993
    # a description that is not in the text falls back to the number; one that is null too
    numbered = "-" * 50 + "item 7" + "+" * 50
    assert window(spark, numbered, "nothing like it", 7, None, 9000, 10) == window(spark, numbered, None, 7, None, 9000, 10) == "-" * 10 + "item 7" + "+" * 4
    # the cap counts the excerpts and not the marks between them
    two = "cadeira" + "." * 100 + "12,50" + "." * 100 + "12,50" + "." * 10
    assert window(spark, two, "cadeira", 1, 12.5, 25, 10, 5) == "cadeira..." + D.MARK + ".....12,50" + D.MARK + "....."
    # the second hit of a price is looked for after the end of the first
    assert window(spark, "1,11,11,11" + "." * 50, None, None, 1.11, 900, 10, 4).startswith("1,11,11,11"[:9])
    assert window(spark, None, "a", 1, None) is None and window(spark, "", "a", 1, 2.0) == ""


def test_report_expressions(spark):
    row = lambda kind, *cols: spark.createDataFrame([kind], ", ".join(f"c{i} string" for i in range(len(kind)))).select(*cols).first()
    c = [F.col(f"c{i}") for i in range(3)]
    noun = lambda d, n: row((d, n), T.head_noun(c[0], c[1]))[0]
    assert [noun("Parafuso , aço", "X"), noun("Parafuso", "Fixador"), noun("Parafuso", None), noun(None, "Fixador"), noun(None, None), noun("Parafuso", " ")] == ["Parafuso", "Fixador", "Parafuso", "Fixador", "", "Parafuso"]
    dated = lambda x: row((x, ""), T.format_date_br(c[0]))[0]
    assert [dated("2024-02-09T10:00:00"), dated(None), dated("soon")] == ["09/02/2024", "", "soon"]
    ends = lambda k: str(row((k, "2025-05-01", "2024-02-29"), T.validity_end(c[0], c[1].cast("date"), c[2].cast("date")))[0])
    assert [ends("Contract"), ends("act"), ends(None)] == ["2025-02-28", "2025-05-01", "2025-05-01"]
    control = lambda x: row((x, ""), T.parse_control_number(c[0]))[0]
    got = control("  00394460000141-12-000345/2024-000007 ")
    assert (got.cnpj, got.kind, got.seq, got.year, got.act_seq) == ("00394460000141", "12", 345, 2024, 7) and control("394460-1-1/2024") is None
    values = row((" 2420.0000 ", "n/a", " "), T.quantity_text(F.trim(c[0])), T.quantity_text(c[1]), T.quantity_text(F.lit(None)), T.parse_text(c[2]), T.parse_text(c[0]), T.page_density(c[0]), T.page_density(F.lit(None).cast("string")))
    assert list(values) == ["2420.0", "n/a", "", None, "2420.0000", 9, 0]


def test_null_groups_and_missing_vectors(spark):
    prices = spark.createDataFrame([(None, 1.0), (None, 1.0), (None, 900.0), ("a", 2.0), ("a", None)], "code string, price double")
    assert sorted((str(r.code), r.price, r.price_flag) for r in P.price_flags(prices, ["code"], "price", 0.1).where("price is not null").collect()) == [("None", 1.0, False), ("None", 1.0, False), ("None", 900.0, True), ("a", 2.0, False)]
    assert P.price_flags(prices, ["code"], "price").count() == 5
    cat = spark.createDataFrame([("b", "C1", ["colete", "balistico"], [1.0, 0.0])], "block string, code string, tokens array<string>, v array<double>")
    items = spark.createDataFrame([("b", "i1", ["colete", "balistico"], None), ("b", "i2", ["mesa"], [1.0, 0.0]), ("b", "i3", ["mesa"], [0.0, 1.0]), ("other", "i4", ["colete"], [1.0, 0.0])], "block string, item string, tokens array<string>, v array<double>")
    got = {r.item: (r.bm25, r.cosine) for r in M.candidate_pairs(cat, items, "block", "code", "item", "tokens", 5, 0.5, "v").collect()}
    assert set(got) == {"i1", "i2"} and got["i1"][1] == 0.0 and abs(got["i2"][1] - 1.0) < 1e-9


def test_places_of_all_rows(spark):
    codes = [str(i) for i in range(1200)] + ["007", "abc"]
    got = K.placed(spark.createDataFrame([(x,) for x in codes], "code string"), "code").collect()
    assert [r.code for r in sorted(got, key=lambda r: r.place)] == sorted(codes, key=lambda x: (len(x), x)) and {r.place for r in got} == set(range(1, len(codes) + 1))


def test_documents(spark):
    pages = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, None)], "d int, p int, t string")
    assert {(r.d, r.text, r.n_pages) for r in D.document_text(pages, "d", ["p"], "t").collect()} == {(1, "a\nb", 2), (2, "", 1)}
    chunks = D.chunk_text(spark.createDataFrame([(1, "x" * 25), (2, ""), (3, "y" * 10)], "k int, t string"), "k", "t", 10, 2).orderBy("k", "chunk").collect()
    assert [(c.k, c.chunk, len(c.chunk_text)) for c in chunks] == [(1, 0, 10), (1, 1, 10), (1, 2, 9), (3, 0, 10)]
    st = spark.createDataFrame([(1, "no_text"), (2, "not_found"), (3, "confirmed"), (3, "no_text")], "d int, s string")
    assert {r.d: r.verdict for r in D.doc_verdict(st, "d", "s").collect()} == {1: "illegible", 2: "suspect", 3: "ok"}


ITEMS = ["colete balistico nivel III-A", "colete a prova de balas nivel 3", "capacete balistico", "cadeira de escritorio giratoria", "papel sulfite A4", "caneta esferografica azul"]


def matching(spark, category="protecao"):
    cat = spark.createDataFrame([("C1", "colete balistico", category)], "code string, text string, block string")
    items = spark.createDataFrame([(f"i{i}", t, "protecao") for i, t in enumerate(ITEMS)], "item string, text string, block string")
    tok = lambda d: d.withColumn("tokens", T.tokenize_alnum(F.col("text")))
    return tok(cat), tok(items)


def test_bm25_and_candidates(spark):
    cat, items = matching(spark)
    norm = M.minmax_in_block(M.bm25_scores(cat, items, "block", "code", "item", "tokens"), cat, items, "block", "code", "item", "bm25")
    assert {r["item"]: round(r.norm, 4) for r in norm.collect()} == {"i0": 1.0, "i1": 0.4159, "i2": 0.7177}
    assert {r["item"] for r in M.candidate_pairs(cat, items, "block", "code", "item", "tokens", 10, 0.3).collect()} == {"i0", "i1", "i2"}
    two = [M.candidate_pairs(cat, items, "block", "code", "item", "tokens", 2, 0.0).orderBy(F.desc("score")).collect() for _ in range(2)]
    assert [r["item"] for r in two[0]] == ["i0", "i2"] == [r["item"] for r in two[1]] and all(r.cosine == 0 for r in two[0])
    other, _ = matching(spark, "outra")
    assert M.candidate_pairs(other, items, "block", "code", "item", "tokens", 2, 0.0).count() == 0


def test_refilter_keeps_ties(spark):
    df = spark.createDataFrame([("c", i, s) for i, s in enumerate([0.9, 0.8, 0.8, 0.7, 0.1])], "code string, item int, score double")
    out = {r["item"]: r.cut_by for r in M.refilter_top_k(df, ["code"], "score", 2, 0.2).collect()}
    assert out == {0: None, 1: None, 2: None, 3: "top_k", 4: "floor"}
    assert M.top_k(df, ["code"], "score", "item", 2, 0.2).count() == 2


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    r = df.select(M.cosine(F.col("a"), F.col("b")).alias("x"), M.cosine(F.col("a"), F.col("z")).alias("y")).first()
    assert math.isclose(r.x, 2**-0.5) and r.y is None


def test_quality_gate(spark):
    rows = [(True, 0.84 + i / 100) for i in range(15)] + [(False, 0.02 + i / 100) for i in range(15)] + [(None, 0.55), (None, 0.6)]
    df = spark.createDataFrame(rows, "y boolean, s double")
    m = Q.regression_gate(Q.confusion_matrix(df, "y", "s", 0.8, 0.3), 0.85).first()
    assert (m.n, m.tp, m.fp, m.tn, m.fn, m.precision, m.recall, m.passed) == (30, 15, 0, 15, 0, 1.0, 1.0, True)
    assert Q.confusion_matrix(df, "y", "s", 0.1, 0.05).first().precision < 0.85
    assert Q.confusion_matrix(df, "y", "s", 0.99, 0.95).first().recall < 0.85
    assert not Q.regression_gate(Q.confusion_matrix(df.limit(0), "y", "s", 0.8, 0.3), 0.85).first().passed


def test_decisions(spark):
    rows = [("accept", None, "confirmed"), ("ambiguous", "yes", "confirmed"), ("ambiguous", "no", "rejected"), ("reject", None, "rejected"), ("ambiguous", None, "pending"), ("ambiguous", "undetermined", "rejected"), (None, None, "pending"), ("reject", "error", "pending")]
    df = spark.createDataFrame(rows, "d string, v string, want string")
    assert df.where(M.final_decision(F.col("d"), F.col("v")) != F.col("want")).count() == 0


def test_catalogue(spark):
    cat = spark.createDataFrame([("material", "1", "77"), ("material", "2", "88"), ("service", "77", None), ("service", "x", None)], "kind string, code string, pdm string")
    allow = spark.createDataFrame([("material", "77", True), ("service", "77", True), ("material", "88", False)], "kind string, code string, active boolean")
    cur = spark.createDataFrame([("material", "1", "arms"), ("material", "2", "old")], "kind string, code string, category string")
    got = {(r.kind, r.code): (r.category, r.active) for r in K.derive_catalog(cat, allow, cur).collect()}
    assert got == {("material", "1"): ("arms", True), ("material", "2"): ("old", False), ("service", "77"): (None, True)}
    cur_rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, h string")
    assert B.snapshot_delta(cur_rows, None, ["k"], "h").count() == 0
    prev = spark.createDataFrame([(2, "c"), (3, "d")], "k int, h string")
    assert {(r.k, r.status) for r in B.snapshot_delta(cur_rows, prev, ["k"], "h").collect()} == {(1, "new"), (2, "changed"), (3, "removed")}


def test_upsert_is_idempotent(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, name string, n int")
    new = spark.createDataFrame([(2, "x", 9), (2, "y", 8), (3, "c", 3)], "k int, name string, n int")
    once = B.upsert(cur, new, ["k"], ["n"], ["n"])
    assert {tuple(r) for r in once.collect()} == {(1, "a", 1), (2, "b", 8), (3, "c", 3)} == {tuple(r) for r in B.upsert(once, new, ["k"], ["n"], ["n"]).collect()}
    assert {tuple(r) for r in B.upsert(cur, new, ["k"], ["n"]).collect()} == {(1, "a", 1), (2, "b", 2), (3, "c", 3)}


def test_batch_score_isolates_failures(spark):
    def fn(pdf):
        if (pdf["t"] == "bad").any():
            raise RuntimeError("no")
        return [x.upper() for x in pdf["t"]]

    got = {r.k: (r.result, r.error) for r in C.batch_score(spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "k int, t string"), "k", ["t"], fn).collect()}
    assert got == {1: ("A", None), 2: (None, "RuntimeError: no"), 3: ("C", None)}


def test_terms(spark):
    df = spark.createDataFrame([(1, "Colete Balistico"), (2, "EQUIPAMENTO"), (3, "fuzil")], "k int, term string")
    got = {(r.k, r.term) for r in K.expand_terms(df, K.variant_groups(spark), K.generic_terms(spark), "k", "term").collect()}
    assert {k for k, _ in got} == {1, 3} and (1, "colete antibala") in got and (1, "colete à prova de tiro") in got and (3, "fuzil") in got
    assert one(spark, T.category_of_group, "MUNIÇÕES E EXPLOSIVOS") == "municao" and one(spark, T.category_of_group, "x") is None


def test_run_diff_takes_the_last_row(spark):
    a = spark.createDataFrame([(1, 10.0, 1), (1, 20.0, 2), (2, 5.0, 1)], "k int, p double, o int")
    b = spark.createDataFrame([(1, 20.0, 1), (3, 7.0, 1)], "k int, p double, o int")
    assert {(r.k, r.status) for r in R.run_diff(a, b, ["k"], "p", ["o"]).collect()} == {(2, "gone"), (3, "new")}


def test_ingest(spark):
    import datetime as dt

    t = lambda h: dt.datetime(2026, 1, 1, h)
    feed = spark.createDataFrame([("a", t(1)), ("a", t(2)), ("b", t(1))], "k string, ts timestamp")
    marks = spark.createDataFrame([("a", t(2))], "k string, watermark timestamp")
    assert {tuple(r) for r in I.since_watermark(feed, marks, ["k"], "ts").collect()} == {("a", t(2)), ("b", t(1))}
    later = I.advance_watermark(marks, feed.where("ts < timestamp'2026-01-01 02:00:00'"), ["k"], "ts")
    assert {tuple(r) for r in later.collect()} == {("a", t(2)), ("b", t(1))}
    visits = spark.createDataFrame([("a", t(1), False), ("a", t(2), True), ("b", t(1), False), ("b", t(3), False)], "k string, ts timestamp, ok boolean")
    assert [tuple(r) for r in I.pending_queue(feed.limit(0), visits, "k", "ts", "ok").collect()] == [("b", 2, t(3))]


def test_scorers_leave_failures_pending(spark):
    def fn(batch):
        if (batch["text"] == "bad").any():
            raise ValueError("no")
        return [[t] for t in batch["text"]]

    done = spark.createDataFrame([("h1", ["old"])], "h string, labels array<string>")
    rows = spark.createDataFrame([("h1", "a"), ("h2", "b"), ("h2", "b"), ("h3", "bad")], "h string, text string")
    first, failed = C.classify_with(rows, done, "h", "text", fn)
    assert {r.h: r.labels for r in first.collect()} == {"h1": ["old"], "h2": ["b"]} and failed.first() == ("h3", "ValueError: no")
    second, failed = C.classify_with(rows, first, "h", "text", lambda b: [["now"]] * len(b))
    assert {r.h: r.labels for r in second.collect()} == {"h1": ["old"], "h2": ["b"], "h3": ["now"]} and failed.count() == 0
    assert C.resolve_prompt("a {x}", "f", x=1) == "a 1" and C.resolve_prompt("a {y}", "f", x=1) == "f" and C.resolve_prompt(None, "f") == "f"


def test_report_of_a_code_without_catalogue_entry(spark):
    row = spark.createDataFrame([(1, 1, "9", "mesa, grande", None, "b", "12", "SP", "bad", None, 3, "un", 2.0, 1234.5, None, "s", None, "act", None, None)], "run_id int, position int, code string, catalog_text string, final_text string, buyer string, buyer_id string, state string, control string, year int, number int, unit string, quantity double, price double, estimated double, supplier_name string, result_date date, document_kind string, signed date, valid_until date")
    catalog = spark.createDataFrame([], "code string, kind string, class_name string, name string, description string")
    got = R.report_rows(row, catalog).first().asDict()
    assert len(got) == 24 and got["Nome"] == "mesa" and got["Quantidade"] == "2.0" and got["Valor Homologado"] == "1.234,50" and got["Valor Estimado"] == got["Ano"] == got["Fim de Vigencia"] == "" and got["Origem"] == "Ata"
