"""Ingest queries over events: batch forms, and streams over landed files that must converge to the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderspark.plans.demo import Plans, r4, sql4, table
from tenderspark.sources.files import scratch, stream_search_hits
from tenderspark.streaming import ingest as I
from tenderspark.streaming import state as S
from tenderspark.streaming.tables import BucketTable

PLANS = Plans()
add, QUERIES, SQL = PLANS.add, PLANS.queries, PLANS.sql

_EARLY = "ts < TIMESTAMP '2024-01-15' AND event_type <> 'view'"
_MARKS = f"marks AS (SELECT event_type, user_id, max(ts) AS watermark FROM events WHERE {_EARLY} GROUP BY ALL)"


def marks(spark, sf_dir):
    early = table(spark, sf_dir, "events").where("ts < timestamp'2024-01-15' and event_type != 'view'")
    return early.groupBy("event_type", "user_id").agg(F.max("ts").alias("watermark"))


_SINCE = "SELECT event_id FROM events LEFT JOIN marks USING (event_type, user_id) WHERE watermark IS NULL OR ts IS NULL OR ts >= watermark"


@add("ingest_since_watermark", f"WITH {_MARKS} {_SINCE}")
def ingest_since_watermark(spark, sf_dir):
    return I.since_watermark(table(spark, sf_dir, "events"), marks(spark, sf_dir), ["event_type", "user_id"], "ts").select("event_id")


_LATER = f"SELECT event_type, user_id, max(ts) FROM events WHERE ({_EARLY}) IS NOT TRUE GROUP BY ALL"


@add("watermark_upsert", f"WITH {_MARKS} SELECT event_type, user_id, max(watermark) AS watermark FROM (SELECT * FROM marks UNION ALL {_LATER}) GROUP BY ALL")
def watermark_upsert(spark, sf_dir):
    later = table(spark, sf_dir, "events").where("not coalesce(ts < timestamp'2024-01-15' and event_type != 'view', false)")
    return I.advance_watermark(marks(spark, sf_dir), later, ["event_type", "user_id"], "ts")


@add("dedup_documents", "SELECT 'document' AS part, user_id, arg_min(event_type, (ts, event_id)) AS term FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 250) GROUP BY user_id UNION ALL SELECT DISTINCT 'link', user_id, event_type FROM events")
def dedup_documents(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    docs, links = I.new_documents(e, e.where("value > 250"), "user_id", "event_type", ["ts", "event_id"])
    return docs.select(F.lit("document").alias("part"), "user_id", F.col("event_type").alias("term")).unionByName(links.select(F.lit("link").alias("part"), "user_id", F.col("event_type").alias("term")))


_VISITS = "v AS (SELECT user_id, ts, event_type = 'purchase' AS done FROM events WHERE event_type IN ('purchase', 'view', 'error'))"
_PENDING = f"{_VISITS}, d AS (SELECT user_id, max(ts) FILTER (done) AS d FROM v GROUP BY user_id), p AS (SELECT user_id, count(*) AS tries, max(ts) AS last_seen FROM v JOIN d USING (user_id) WHERE d IS NULL OR ts > d GROUP BY user_id)"


@add("pending_revisit", f"WITH {_PENDING} SELECT * FROM p")
def pending_revisit(spark, sf_dir):
    """Errors put a key into the queue, views visit it without a result, a purchase is its result."""
    e = table(spark, sf_dir, "events")
    queue = e.where("event_type = 'error'").select("user_id", "ts")
    visits = e.where("event_type in ('purchase', 'view')").select("user_id", "ts", (F.col("event_type") == "purchase").alias("done"))
    return I.pending_queue(queue, visits, "user_id", "ts", "done")


_PROGRESS = f"SELECT event_type, user_id, count(*) AS n_rows, {sql4('sum(value)')} AS total FROM events GROUP BY ALL"


@add("progress_accumulate", _PROGRESS)
def progress_accumulate(spark, sf_dir):
    return I.progress(table(spark, sf_dir, "events"), ["event_type", "user_id"], F.col("value")).withColumn("total", r4("total"))


@add("late_updates", "SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(value, event_id) AS last_value FROM events GROUP BY user_id")
def late_updates(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("first_type"), F.col("value").alias("last_value"), "event_id")
    first = e.groupBy("user_id").agg(F.min_by(F.struct("first_type", "last_value", "event_id"), "event_id").alias("r")).select("user_id", "r.*")
    return I.late_updates(first, e, "user_id", [F.desc("event_id")], ["last_value"]).select("user_id", "first_type", "last_value")


@add("error_retry_state", "SELECT user_id, count(*) AS attempts, min(ts) AS first_at, max(ts) AS last_at, arg_max(props, ts) AS message FROM events WHERE event_type = 'error' GROUP BY user_id")
def error_retry_state(spark, sf_dir):
    from tenderspark.operators.runs import error_state

    return error_state(table(spark, sf_dir, "events").where("event_type = 'error'"), ["user_id"], "ts", "props")


@add("stale_keys", "SELECT user_id, last_at FROM (SELECT user_id, max(ts) AS last_at, arg_max(event_type <> 'signup', ts) AS act FROM events GROUP BY user_id) WHERE act AND last_at < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7200 SECOND")
def stale_keys(spark, sf_dir):
    return I.stale_keys(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") != "signup", F.lit("2024-01-30 12:00:00").cast("timestamp"), 7200)


# ---- streams: the events land in three runs; the stream starts anew for each and goes on where it stopped ----

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
RUNS = 3


def by_time():
    """Runs in the order of time; rows before, after and without a time are in the first and last of them."""
    ten_days = F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 10)
    return F.coalesce(F.greatest(F.least(ten_days, F.lit(RUNS - 1)), F.lit(0)), F.lit(0)).cast("int")


def by_id():
    """Runs in no order of time, so that later ones bring rows older than a watermark."""
    return F.pmod("event_id", F.lit(RUNS)).cast("int")


def played(spark, rows, run, kind, start) -> None:
    """Writes ``rows`` once, by run, then for each run moves its files to where the stream looks, as a feed publishes them, and
    starts the stream (``start`` takes the landing folder) until it has read all of them. Every task of the scan writes its own
    files: dealt by run, a third of all rows would be sorted and written by one task."""
    staged, landing = scratch(spark, "staged"), scratch(spark, "landing")
    path = spark._jvm.org.apache.hadoop.fs.Path
    rows.withColumn("run", run).write.partitionBy("run").format(kind).save(staged)
    fs = path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(landing))
    for i in range(RUNS):
        if fs.exists(path(f"{staged}/run={i}")):
            fs.rename(path(f"{staged}/run={i}"), path(f"{landing}/r{i}"))
        start(landing).awaitTermination()


def running(stream, state: str, mode: str, sink):
    """One start of a stream that ends with what has landed; ``state`` is where it goes on from."""
    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", state).outputMode(mode).foreachBatch(sink).start()


def kept(spark, sf_dir, label, run, schema, keys, stream, merge, mode="append"):
    """The table that ``merge`` keeps up to date with every micro-batch of ``stream`` over the landed events."""
    out = scratch(spark, label)
    state = BucketTable(spark, f"{out}/table", schema, keys, 16)
    played(spark, table(spark, sf_dir, "events"), run, "parquet", lambda landing: running(stream(I.read_feed(spark, landing, SCHEMA)), f"{out}/_state", mode, state.sink(merge)))
    return state


_HITS = f"h AS (SELECT event_id, event_type, user_id, date_trunc('hour', ts) AS u, event_id % {RUNS} AS run FROM events)"


@add("ingest_stream", f"""WITH {_HITS}, m AS (SELECT run, event_type, user_id, max(u) AS u FROM h GROUP BY ALL),
before AS (SELECT r.run, event_type, user_id, max(m.u) AS w FROM m JOIN range({RUNS}) AS r(run) ON m.run < r.run GROUP BY ALL)
SELECT CAST(event_id AS VARCHAR) AS control, CAST(run AS INT) AS batch FROM h LEFT JOIN before USING (run, event_type, user_id) WHERE w IS NULL OR u >= w""")
def ingest_stream(spark, sf_dir):
    """Hits land as JSON; a run reads those that are not older than its search's watermark and moves that on. Hits of the
    watermark's own hour are read again."""
    e = table(spark, sf_dir, "events")
    text = lambda c: F.col(c).cast("string")
    hits = e.select(text("event_id").alias("control"), F.lit("contract").alias("kind"), text("event_type").alias("term"), text("user_id").alias("source"), F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("updated"), "event_id")
    out = scratch(spark, "collected")
    found = I.Collection(spark, out, 16)
    played(spark, hits, by_id(), "json", lambda landing: running(stream_search_hits(spark, landing), f"{out}/_state", "append", found.sink))
    return found.hits().select("control", "batch")


@add("stream_first_seen", "SELECT user_id, event_type FROM (SELECT user_id, event_type FROM events GROUP BY ALL)")
def stream_first_seen(spark, sf_dir):
    seen = lambda feed: S.stream_seen(feed, "user_id", "event_type", "ts", "event_id").where("part = 'link'").select(F.col("key").alias("user_id"), F.col("term").alias("event_type"))
    keys = ["user_id", "event_type"]
    return kept(spark, sf_dir, "first-seen", by_time(), "user_id long, event_type string", keys, seen, I.replaced(keys)).read()


@add("stream_documents", "SELECT 'document' AS part, user_id, arg_min(event_type, (ts, event_id)) AS term FROM events GROUP BY user_id UNION ALL SELECT DISTINCT 'link', user_id, event_type FROM events")
def stream_documents(spark, sf_dir):
    """New documents and links of known ones to new terms, from one stateful operator; without a time bound."""
    seen = lambda feed: S.stream_seen(feed, "user_id", "event_type", "ts", "event_id").select("part", F.col("key").alias("user_id"), "term")
    keys = ["part", "user_id", "term"]
    return kept(spark, sf_dir, "documents", by_time(), "part string, user_id long, term string", keys, seen, I.replaced(keys)).read()


@add("stream_progress", _PROGRESS)
def stream_progress(spark, sf_dir):
    keys = ["event_type", "user_id"]
    counted = lambda feed: I.progress(feed, keys, F.col("value"))
    out = kept(spark, sf_dir, "progress", by_time(), "event_type string, user_id long, n_rows long, total double", keys, counted, I.replaced(keys), "update").read()
    return out.withColumn("total", r4("total"))


@add("stream_watermarks", "SELECT event_type, user_id, max(ts) AS watermark FROM events GROUP BY ALL")
def stream_watermarks(spark, sf_dir):
    keys = ["event_type", "user_id"]
    return kept(spark, sf_dir, "marks", by_id(), "event_type string, user_id long, watermark timestamp", keys, lambda feed: feed, I.marks_merged(keys, "ts")).read()


@add("stream_late_updates", f"SELECT user_id, arg_min(event_type, (event_id % {RUNS}, -event_id)) AS first_type, arg_max(value, event_id) AS last_value FROM events GROUP BY user_id")
def stream_late_updates(spark, sf_dir):
    """Known keys take only the value of later arrivals, and only where those are newer than what the table has."""
    late = lambda feed: feed.select("user_id", F.col("event_type").alias("first_type"), F.col("value").alias("last_value"), "event_id")
    newer = F.col("_new.event_id") > F.col("_old.event_id")
    merge = I.late_merged("user_id", [F.desc("event_id")], ["last_value", "event_id"], newer)
    schema = "user_id long, first_type string, last_value double, event_id long"
    return kept(spark, sf_dir, "late", by_id(), schema, ["user_id"], late, merge).read().drop("event_id")


_STALE = "last AS (SELECT user_id, max(ts) AS last_at, arg_max(event_type <> 'signup', (ts, event_type <> 'signup')) AS act FROM events GROUP BY user_id)"


@add("stream_stale_keys", f"WITH {_STALE} SELECT user_id, last_at FROM last WHERE act AND last_at + INTERVAL 7200 SECOND < (SELECT max(ts) FROM events)")
def stream_stale_keys(spark, sf_dir):
    beats = lambda feed: S.stream_heartbeats(feed, "user_id", "ts", F.col("event_type") != "signup", 7200).withColumnRenamed("key", "user_id")
    out = kept(spark, sf_dir, "heartbeats", by_time(), "user_id long, last_at long, stale boolean", ["user_id"], beats, I.replaced(["user_id"]), "update").read()
    return out.where("stale").select("user_id", F.timestamp_micros("last_at").alias("last_at"))


@add("stream_pending_revisit", f"WITH {_PENDING} SELECT user_id, tries, last_seen, last_seen + INTERVAL 5 DAY < (SELECT max(ts) FROM events WHERE event_type IN ('purchase', 'view', 'error')) AS due FROM p")
def stream_pending_revisit(spark, sf_dir):
    """The pending queue as keyed state; five days after its last visit a key is due again."""

    def queue(feed):
        visits = feed.where("event_type in ('purchase', 'view', 'error')").withColumn("done", F.col("event_type") == "purchase")
        return S.stream_pending(visits, "user_id", "ts", "done", 5 * 86_400).withColumnRenamed("key", "user_id")

    out = kept(spark, sf_dir, "pending", by_time(), "user_id long, tries long, last_seen long, due boolean", ["user_id"], queue, I.replaced(["user_id"]), "update").read()
    return out.where("tries > 0").select("user_id", "tries", F.timestamp_micros("last_seen").alias("last_seen"), "due")


_ERRORS = """e AS (SELECT user_id % 3 AS run, CASE WHEN event_id % 2 = 0 THEN 'collect' ELSE 'enrich' END AS step, user_id, event_id, ts, event_type = 'error' AS failed, props FROM events),
c AS (SELECT run, step, user_id, max((ts, event_id)) FILTER (NOT failed) AS clear, max(ts) AS last_at FROM e GROUP BY ALL)"""


@add("stream_error_state", f"""WITH {_ERRORS} SELECT c.run, c.step, c.user_id, count(*) FILTER (open_) AS attempts, min(ts) FILTER (open_) AS first_at, max(ts) FILTER (open_) AS last_error_at,
arg_max(props, (ts, event_id)) FILTER (open_) AS message, c.last_at FROM (SELECT e.*, failed AND (clear IS NULL OR (ts, event_id) > clear) AS open_ FROM e JOIN c USING (run, step, user_id)) e JOIN c USING (run, step, user_id)
WHERE c.last_at >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY GROUP BY c.run, c.step, c.user_id, c.last_at""")
def stream_error_state(spark, sf_dir):
    """Errors of each (run, step, key) since its last event without one; keys without an event for ten days expire."""
    keys = ["run", "step", "user_id"]
    step = F.when(F.col("event_id") % 2 == 0, "collect").otherwise("enrich")
    keyed = lambda feed: feed.select((F.col("user_id") % 3).alias("run"), step.alias("step"), "user_id", "event_id", "ts", "props", (F.col("event_type") == "error").alias("failed"))
    schema = f"run long, step string, user_id long, {I.ERRORS}"
    state = kept(spark, sf_dir, "errors", by_time(), schema, keys, keyed, I.errors_merged(keys, "ts", "event_id", F.col("failed"), "props"))
    newest = state.read().agg(F.max("last_at")).first()[0]
    if newest is not None:
        state.delete(F.col("last_at") < F.lit(newest) - F.expr("interval 10 days"))
    return state.read().select(*keys, "attempts", "first_at", "last_error_at", "message", "last_at")
