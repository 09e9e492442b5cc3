"""Bucket tables, streams that start anew, and keyed state, on small inputs."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tenderspark.operators.tables import upsert
from tenderspark.sources.files import FOUND, identified
from tenderspark.streaming import ingest as I
from tenderspark.streaming import state as S
from tenderspark.streaming.tables import BucketTable

DAY = dt.datetime(2024, 1, 1)


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    table = BucketTable(spark, f"file://{tmp_path}/t", "k long, v long", ["k"], 50)
    merge = I.late_merged("k", ["v"], ["v"])
    assert table.read().count() == 0
    assert table.merge(spark.range(20_000).selectExpr("id as k", "id as v"), 0, merge) == 50
    before = files(f"{tmp_path}/t")
    few = spark.createDataFrame([(3, -1), (4, -2), (None, 5)], "k long, v long")
    assert table.merge(few, 1, merge) == 2
    after = files(f"{tmp_path}/t")
    new = {f: n for f, n in after.items() if f not in before}
    assert len(new) == 2 and sum(new.values()) < 0.1 * sum(after.values())
    assert len(before.keys() - after.keys()) == 2
    assert {r.k: r.v for r in table.read().where("k < 6").collect()} == {0: 0, 1: 1, 2: 2, 3: -1, 4: -2, 5: 5}
    assert table.read().count() == 20_000
    assert table.merge(few, 1, merge) == 0 and files(f"{tmp_path}/t") == after


def test_a_batch_that_broke_off_goes_on_in_the_buckets_it_has_not_done(spark, tmp_path):
    table = BucketTable(spark, f"file://{tmp_path}/t", "k long, n long", ["k"], 8)
    add = lambda old, batch: old.unionByName(batch).groupBy("k").agg(F.sum("n").alias("n"))  # noqa: E731  not idempotent by itself
    batch = spark.range(100).selectExpr("id as k", "1L as n")
    half = batch.where(F.pmod(F.xxhash64("k"), F.lit(8)) < 3)
    assert table.merge(half, 0, add) == 3
    assert table.merge(batch, 0, add) == 5
    assert table.merge(batch, 1, add) == 8
    assert table.read().agg(F.min("n"), F.max("n"), F.count("k")).first() == (2, 2, 100)


def test_deleted_rows_go_and_empty_buckets_stay_empty(spark, tmp_path):
    table = BucketTable(spark, f"file://{tmp_path}/t", "k long", ["k"], 4)
    table.merge(spark.range(40).withColumnRenamed("id", "k"), 5, lambda old, batch: batch)
    before = files(f"{tmp_path}/t")
    assert table.delete(F.col("k") == 7) == 1
    assert len(files(f"{tmp_path}/t").keys() & before.keys()) == 3
    assert table.delete(F.col("k") >= 0) == 4 and table.read().count() == 0
    assert table.delete(F.col("k") >= 0) == 0
    assert table.merge(spark.range(40).withColumnRenamed("id", "k"), 5, lambda old, batch: batch) == 0  # batch 5 is in


def test_upsert_changes_where_the_condition_holds(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", None)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "x", 2), (2, "y", 4), (3, "z", 9), (4, "w", None)], "k int, v string, n int")
    got = upsert(old, new, ["k"], ["n"], ["v"], F.col("_new.n") > F.col("_old.n"))
    assert sorted(map(tuple, got.collect())) == [(1, "x", 1), (2, "b", 5), (3, "c", None), (4, "w", None)]
    got = upsert(old, new, ["k"], ["n"], ["v", "n"], ~F.col("_new.v").eqNullSafe(F.col("_old.v")))
    assert sorted(map(tuple, got.collect())) == [(1, "x", 2), (2, "y", 4), (3, "z", 9), (4, "w", None)]


def hits(spark, rows):
    raw = spark.createDataFrame(rows, "control string, term string, source string, updated_at timestamp")
    others = [F.lit(None).cast(t).alias(c) for c, t in identified(spark.createDataFrame([], FOUND)).dtypes if c not in raw.columns]
    return raw.select("*", *others)


def test_collection_stops_at_the_watermark_and_repeats_a_batch(spark, tmp_path):
    found = I.Collection(spark, f"file://{tmp_path}/c", 4)
    assert found.hits().count() == 0
    at = lambda d: DAY + dt.timedelta(days=d)
    found.sink(hits(spark, [("a", "bolt", "s", at(3)), ("b", "bolt", "s", at(1)), ("n", None, "s", at(1))]), 0)
    second = hits(spark, [("c", "bolt", "s", at(3)), ("d", "bolt", "s", at(2)), ("e", "bolt", "t", at(0)), ("f", "bolt", "s", None), ("g", "bolt", "s", at(9)), ("m", None, "s", at(0))])
    kept = {("a", 0), ("b", 0), ("n", 0), ("c", 1), ("e", 1), ("f", 1), ("g", 1), ("m", 1)}
    for _ in range(2):  # the second time as after a failure behind the advance
        found.sink(second, 1)
        assert {(r.control, r.batch) for r in found.hits().collect()} == kept
        assert {(r.term, r.source, r.watermark) for r in found.marks.read().collect()} == {("bolt", "s", at(9)), ("bolt", "t", at(0))}
    found.sink(hits(spark, [("h", "bolt", "s", at(8)), ("i", "bolt", "t", at(0))]), 2)
    assert {r.control for r in found.hits().where("batch = 2").collect()} == {"i"}


class Timers:
    def __init__(self, watermark_ms):
        self.watermark = watermark_ms

    def getCurrentWatermarkInMs(self):
        return self.watermark


class Handle:
    """What a processor needs of Spark's handle, for one key."""

    def __init__(self):
        self.values, self.timers = {}, []

    def getValueState(self, name, schema):
        return Value(self.values, name)

    def getMapState(self, name, key, value):
        return Map(self.values.setdefault(name, {}))

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Value:
    def __init__(self, values, name):
        self.values, self.name = values, name

    def exists(self):
        return self.name in self.values

    def get(self):
        return self.values[self.name]

    def update(self, value):
        self.values[self.name] = value


class Map:
    def __init__(self, values):
        self.values = values

    def containsKey(self, key):
        return key in self.values

    def updateValue(self, key, value):
        self.values[key] = value


def rows_of(frames):
    return [tuple(None if v is pd.NA else v for v in r) for f in frames for r in f.itertuples(index=False)]


def test_pending_keys_leave_on_a_result_and_come_back(spark):
    p, h = S.PendingQueue(10_000_000), Handle()
    p.init(h)
    visit = lambda *rows: iter([pd.DataFrame(rows, columns=["at", "resolved"])])
    assert rows_of(p.handleInputRows(("k",), visit((1_000_000, False), (3_000_000, False)), Timers(0))) == [("k", 2, 3_000_000, False)]
    assert h.timers == [13_000]
    assert rows_of(p.handleExpiredTimer(("k",), Timers(14_000), None)) == [("k", 2, 3_000_000, True)]
    assert rows_of(p.handleInputRows(("k",), visit((2_000_000, True)), Timers(14_000))) == [("k", 1, 3_000_000, True)]  # a late result clears what was before it
    assert rows_of(p.handleInputRows(("k",), visit((15_000_000, True)), Timers(14_000))) == [("k", 0, None, False)]
    assert h.timers == []
    assert rows_of(p.handleInputRows(("k",), visit((16_000_000, False)), Timers(15_000))) == [("k", 1, 16_000_000, False)]
    assert h.timers == [26_000]


def test_heartbeats_are_stale_when_their_timer_fires(spark):
    p, h = S.Heartbeat(5_000_000), Handle()
    p.init(h)
    beat = lambda *rows: iter([pd.DataFrame(rows, columns=["at", "active"])])
    assert rows_of(p.handleInputRows(("k",), beat((2_000_000, True), (1_000_000, False)), Timers(0))) == [("k", 2_000_000, False)]
    assert rows_of(p.handleInputRows(("k",), beat((1_500_000, False)), Timers(2_000))) == [("k", 2_000_000, False)]
    assert h.timers == [7_000]
    assert rows_of(p.handleExpiredTimer(("k",), Timers(7_001), None)) == [("k", 2_000_000, True)]
    assert rows_of(p.handleInputRows(("k",), beat((9_000_000, False)), Timers(7_001))) == [("k", 9_000_000, False)]
    assert h.timers == []  # an inactive key cannot go stale


def test_keys_of_a_shard_are_worked_in_one_call_under_one_timer(spark):
    p, h = S.Heartbeat(5_000_000), Handle()
    p.init(h)
    beat = lambda *rows: iter([pd.DataFrame(rows, columns=["key", "at", "active"])])
    assert rows_of(p.handleInputRows((9,), beat(("a", 2_000_000, True), ("b", 1_000_000, True), ("c", 1_000_000, False), ("b", 500_000, False), (None, 4_000_000, True)), Timers(0))) == [("a", 2_000_000, False), ("b", 1_000_000, False), ("c", 1_000_000, False), (None, 4_000_000, False)]
    assert h.timers == [6_000]
    assert rows_of(p.handleExpiredTimer((9,), Timers(6_001), None)) == [("b", 1_000_000, True)]
    assert h.timers == [7_000]
    assert rows_of(p.handleInputRows((9,), beat(("c", 8_000_000, True)), Timers(7_001))) == [("a", 2_000_000, True), ("c", 8_000_000, False)]
    assert h.timers == [9_000]
    assert rows_of(p.handleInputRows((9,), beat(("b", 8_500_000, False)), Timers(9_001))) == [("b", 8_500_000, False), (None, 4_000_000, True)]
    assert h.timers == [13_000]  # nothing is told twice, and b is not active any more


def test_pending_keys_of_a_shard_fall_due_under_one_timer(spark):
    p, h = S.PendingQueue(10_000_000), Handle()
    p.init(h)
    visit = lambda *rows: iter([pd.DataFrame(rows, columns=["key", "at", "resolved"])])
    assert rows_of(p.handleInputRows((9,), visit(("a", 1_000_000, False), ("b", 2_000_000, False), ("c", 2_000_000, False), ("c", 3_000_000, True), ("b", 4_000_000, False)), Timers(0))) == [("a", 1, 1_000_000, False), ("b", 2, 4_000_000, False), ("c", 0, None, False)]
    assert h.timers == [11_000]
    assert rows_of(p.handleExpiredTimer((9,), Timers(11_001), None)) == [("a", 1, 1_000_000, True)]
    assert h.timers == [14_000]
    assert rows_of(p.handleInputRows((9,), visit(("c", 12_000_000, False), ("a", 12_000_000, True)), Timers(14_001))) == [("a", 0, None, False), ("b", 2, 4_000_000, True), ("c", 1, 12_000_000, False)]
    assert h.timers == [22_000]


def test_seen_documents_and_their_links(spark):
    p, h = S.SeenDocuments("string"), Handle()
    p.init(h)
    row = lambda *rows: iter([pd.DataFrame(rows, columns=["term", "at", "seq"])])
    two = iter([pd.DataFrame([("b", 5, 1)], columns=["term", "at", "seq"]), pd.DataFrame([("a", 4, 9), (None, 4, 8)], columns=["term", "at", "seq"])])
    assert sorted(rows_of(p.handleInputRows(("d",), two, None)), key=repr) == [("document", "d", None), ("link", "d", "a"), ("link", "d", "b")]
    assert rows_of(p.handleInputRows(("d",), row(("a", 1, 1)), None)) == []
    assert rows_of(p.handleInputRows(("d",), row(("c", 1, 1)), None)) == [("link", "d", "c")]


def test_documents_of_a_shard_are_seen_in_one_call(spark):
    p, h = S.SeenDocuments("string"), Handle()
    p.init(h)
    row = lambda *rows: iter([pd.DataFrame(rows, columns=["key", "term", "at", "seq"])])
    first = [("document", "d", "b"), ("document", "e", None), ("link", "d", "a"), ("link", "d", "b"), ("link", "e", "a")]
    assert sorted(rows_of(p.handleInputRows((9,), row(("d", "a", 5, 1), ("e", "a", float("nan"), 1), ("d", "b", 4, 2), ("e", None, 9, 2)), None)), key=repr) == first
    assert sorted(rows_of(p.handleInputRows((9,), row(("e", "a", 1, 1), ("d", "c", 1, 1), ("f", None, 1, 1)), None)), key=repr) == [("document", "f", None), ("link", "d", "c")]
    assert rows_of(p.handleInputRows((9,), row(("f", None, 1, 1), ("d", "c", 0, 0)), None)) == []


@pytest.mark.parametrize("days", [1, 400])
def test_a_document_is_new_once_however_long_the_feed(spark, tmp_path, days):
    feed = f"{tmp_path}/feed"
    schema = "doc string, term string, ts timestamp, seq long"
    table = BucketTable(spark, f"file://{tmp_path}/t", "part string, key string, term string, batch long", ["part", "key", "term"], 4)
    for i, rows in enumerate([[("a", "x"), ("b", "x")], [("a", "x"), ("a", "y"), ("c", "x")]]):
        spark.createDataFrame([(d, t, DAY + dt.timedelta(days=days * i), j) for j, (d, t) in enumerate(rows)], schema).write.parquet(f"{feed}/r{i}")
        seen = S.stream_seen(I.read_feed(spark, feed, schema), "doc", "term", "ts", "seq")
        sink = lambda batch, n: table.merge(batch.withColumn("batch", F.lit(n)), n, lambda old, new: old.unionByName(new.select(old.columns)))
        seen.writeStream.trigger(availableNow=True).outputMode("append").option("checkpointLocation", f"{tmp_path}/state").foreachBatch(sink).start().awaitTermination()
    got = sorted(tuple(r) for r in table.read().collect())
    assert got == [("document", "a", "x", 0), ("document", "b", "x", 0), ("document", "c", "x", 1), ("link", "a", "x", 0), ("link", "a", "y", 1), ("link", "b", "x", 0), ("link", "c", "x", 1)]


def test_error_state_counts_from_the_last_clear(spark, tmp_path):
    keys = ["run", "k"]
    table = BucketTable(spark, f"file://{tmp_path}/t", f"run int, k string, {I.ERRORS}", keys, 4)
    merge = I.errors_merged(keys, "ts", "seq", F.col("failed"), "message")
    at = lambda d: DAY + dt.timedelta(days=d)
    batch = lambda *rows: spark.createDataFrame([(1, *r) for r in rows], "run int, k string, ts timestamp, seq long, failed boolean, message string")
    table.merge(batch(("a", at(0), 1, True, "m1"), ("a", at(1), 2, False, None), ("a", at(1), 3, True, "m3"), ("b", at(1), 4, True, "m4"), ("c", at(1), 5, False, None)), 0, merge)
    table.merge(batch(("a", at(2), 6, True, "m6"), ("b", at(2), 7, False, None), ("d", at(2), 8, True, None)), 1, merge)
    got = {r.k: (r.attempts, r.first_at, r.last_error_at, r.message, r.last_at) for r in table.read().collect()}
    assert got == {"a": (2, at(1), at(2), "m6", at(2)), "b": (0, None, None, None, at(2)), "c": (0, None, None, None, at(1)), "d": (1, at(2), at(2), None, at(2))}
