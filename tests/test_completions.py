"""Observed counts, retention, thresholds, integrity rules, baselines and ragged rows on small inputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators import quality as Q
from tenderspark.operators import runs as R
from tenderspark.operators.retention import retention
from tenderspark.operators.tables import Snapshot, orphan_report, rule_report
from tenderspark.sources import files as S
from tenderspark.sources.observed import counts_table, loaded, parsed
from tenderspark.streaming.tables import BucketTable


def test_failures_are_counted_by_the_job_that_parses(spark):
    raw = spark.createDataFrame([(1, "1,5", "2024-01-02"), (2, "x", None), (3, " ", "31/02/2024"), (4, None, "y")], "k int, q string, d string")
    out, seen = parsed(raw, "job", {"quantity": (F.col("q"), T.parse_number_br), "dated": (F.col("d"), T.parse_date)}, ["k"])
    assert out.columns == ["k", "quantity", "dated"]
    assert {r.k: (r.quantity, r.dated) for r in out.collect()} == {1: (1.5, dt.date(2024, 1, 2)), 2: (None, None), 3: (None, None), 4: (None, None)}
    assert seen.get == {"rows": 4, "quantity": 1, "dated": 2}
    assert {(r.step, r.metric, r.n) for r in counts_table(spark, {"job": seen}).collect()} == {("job", "rows", 4), ("job", "quantity", 1), ("job", "dated", 2)}


def test_a_load_counts_what_it_drops_by_the_first_reason(spark):
    df = spark.range(10)
    kept, seen = loaded(df, "load", {"small": F.col("id") < 3, "even": F.col("id") % 2 == 0})
    assert sorted(r.id for r in kept.collect()) == [3, 5, 7, 9]
    assert seen.get == {"read": 10, "small": 3, "even": 3, "written": 4}
    none, seen = loaded(df.limit(0), "load", {"small": F.col("id") < 3})
    assert none.count() == 0 and seen.get == {"read": 0, "small": 0, "written": 0}


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_retention_counts_first_and_applies_once(spark, tmp_path):
    now = F.to_date(F.lit("2026-07-01"))
    day = lambda n: dt.date(2026, 7, 1) - dt.timedelta(days=n)
    pages = BucketTable(spark, f"file://{tmp_path}/pages", "doc string, page int, text string", ["doc"], 16)
    logs = BucketTable(spark, f"file://{tmp_path}/logs", "id long, created date", ["id"], 8)
    pages.merge(spark.createDataFrame([(d, p, "xyz") for d in "abcdefgh" for p in range(3)], "doc string, page int, text string"), 0, lambda old, new: new)
    logs.merge(spark.createDataFrame([(1, day(91)), (2, day(90)), (3, None), (4, day(0))], "id long, created date"), 0, lambda old, new: new)
    docs = spark.createDataFrame([("a", day(181), "u"), ("b", day(180), "u"), ("c", day(400), " "), ("d", day(400), None), ("e", None, "u"), ("f", day(999), "u")], "doc string, extracted_at date, url string")
    run = lambda apply: {r.target: (r.n_rows, r.n_chars, r.applied) for r in retention(pages, docs, "doc", logs, "created", now, apply).collect()}
    before = files(tmp_path)
    assert run(False) == {"page": (6, 18, False), "log": (1, 0, False)} and files(tmp_path) == before
    assert run(True) == {"page": (6, 18, True), "log": (1, 0, True)}
    after = files(tmp_path)
    assert len(before - after) <= 3  # two documents' buckets and one of the log
    assert {r.doc for r in pages.read().collect()} == set("bcdegh") and {r.id for r in logs.read().collect()} == {2, 3, 4}
    assert run(True) == {"page": (0, 0, False), "log": (0, 0, False)} and files(tmp_path) == after


def brute_thresholds(rows):
    good = [s or 0.0 for y, s in rows if y]
    reject = [t for t in range(101) if good and sum(s >= t / 100 for s in good) / len(good) >= 0.99]
    accept = []
    for t in range(21):
        taken = [y for y, s in rows if y is not None and s is not None and s >= t / 20]
        if taken and sum(taken) / len(taken) >= 0.97:
            accept.append(t / 20)
    return (max(reject) / 100 if reject else None, min(accept) if accept else None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chosen_thresholds(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [(rng.choice([True, False, None]), rng.choice([None, 0.0, 1.0, rng.randint(0, 100) / 100, rng.random()])) for _ in range(300)]
    rows = [(y, s if s is None or not y else 0.5 + s / 2) for y, s in rows]
    got = Q.chosen_thresholds(spark.createDataFrame(rows, "y boolean, s double"), "y", "s").first()
    assert (got.reject_at, got.accept_at) == brute_thresholds(rows)
    assert tuple(Q.chosen_thresholds(spark.createDataFrame([(False, 0.5)], "y boolean, s double"), "y", "s").first()) == (None,) * 4


def test_orphans_and_rules(spark):
    child = spark.createDataFrame([(1, "h"), (2, ""), (None, None)], "k int, h string")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    got = orphan_report([("a", child, parent, ["k"]), ("b", parent, child, ["k"])])
    assert {r.check_name: r.n for r in got.collect()} == {"a": 2, "b": 1}
    rules = rule_report([("blank", child, F.coalesce(F.trim("h"), F.lit("")) == ""), ("high", child, F.col("k") > 1), ("p", parent, F.col("k") < 0)])
    assert {r.check_name: r.n for r in rules.collect()} == {"blank": 2, "high": 1, "p": 0}


def test_a_baseline_is_set_first_and_advances(spark, tmp_path):
    base = Snapshot(spark, f"file://{tmp_path}/base")
    rows = lambda *r: spark.createDataFrame(r, "k int, h string")
    delta = lambda *r: sorted(tuple(x) for x in base.delta(rows(*r), ["k"], "h").collect())
    assert base.read() is None
    assert delta((1, "a"), (2, "b"), (3, None)) == []
    assert delta((1, "a"), (2, "c"), (4, "d")) == [(2, "changed"), (3, "removed"), (4, "new")]
    assert delta((1, "a"), (2, "c"), (4, "d")) == []
    assert len(os.listdir(f"{tmp_path}/base")) == 2


def test_an_export_advances_with_all_keys(spark, tmp_path):
    done = Snapshot(spark, f"file://{tmp_path}/done")
    rows = lambda *r: spark.createDataFrame([(x,) for x in r], "k int")
    new = lambda *r: sorted(x.k for x in R.export_new(rows(*r), done, ["k"]).collect())
    assert new(1, 2) == [1, 2] and new(1, 2, 3) == [3] and new(1, 2, 3) == [] and new(4) == [4]
    assert new(1) == [1]  # 4 alone was delivered last


def test_ragged_rows_are_told_by_their_fields(spark, tmp_path):
    lines = ["k,v,w", "1,x,,extra", '2,"a,b",c', "3,y", '4,"a ""q"", b",c,d', '5,"a,b"', "6,,", "7"]
    (tmp_path / "r.csv").write_text("\n".join(lines))
    got = {r.k: (r.v, r.w, r.row_kind) for r in S.repair_ragged_csv(spark, f"file://{tmp_path}/r.csv", ["k", "v", "w"]).collect()}
    assert got == {"1": ("x", None, "cut"), "2": ("a,b", "c", "whole"), "3": ("y", None, "padded"), "4": ('a "q", b', "c", "cut"), "5": ("a,b", None, "padded"), "6": (None, None, "whole"), "7": (None, None, "padded")}
