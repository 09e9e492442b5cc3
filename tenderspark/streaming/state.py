"""Keyed state with timers: the pending queue, heartbeats, and documents seen, on a RocksDB state store.

Times are event times: a timer fires when the stream's watermark passes it, so a replay gives the same rows. State lives as
long as its key needs it, not as long as the watermark's delay.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State beyond memory, as processors with timers need it. They go to the workers by value: the process that prepares
    them beside the driver does not see files added to the application."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: Keys share so many states: a call of a processor costs milliseconds, whether it is for one key or for a thousand.
SHARDS = 1024


class _Sharded(StatefulProcessor):
    """A state for all keys of a shard, in arrays beside each other: the keys and what is known of each.

    Frames without a column ``key`` are of the group's own key."""

    STATE: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.STATE.format(self.key_type))

    def load(self) -> dict:
        """Entries by key."""
        if not self.state.exists():
            return {}
        keys, *columns = self.state.get()
        return dict(zip(keys, map(list, zip(*columns, strict=True)), strict=True))

    def store(self, entries: dict) -> None:
        self.state.update(([*entries], *map(list, zip(*entries.values(), strict=True))))

    @staticmethod
    def rows(key: Any, some: pd.DataFrame, *columns: str) -> Iterator[tuple]:
        """Key and ``columns`` of each row of a frame."""
        keys = some["key"].tolist() if "key" in some else [key[0]] * len(some)
        return zip([None if k != k else k for k in keys], *[some[c].tolist() for c in columns], strict=True)

    def close(self) -> None:
        pass


class _Timed(_Sharded):
    """Keys with a time each, at which they are told about once: a shard has one timer, at the earliest of them.

    An entry ends with whether its key has been told about."""

    def at(self, entry: list) -> int | None:
        """When to tell about a key, in microseconds; None for never."""
        raise NotImplementedError

    def frame(self, entries: list[tuple[Any, list]]) -> pd.DataFrame:
        raise NotImplementedError

    def settle(self, entries: dict, changed: dict, timerValues: Any) -> Iterator[pd.DataFrame]:
        """The rows of the keys that changed or whose time is behind the watermark; the others' earliest becomes the timer."""
        now, later, tell = timerValues.getCurrentWatermarkInMs() * 1000, [], []
        for key, entry in entries.items():
            at = self.at(entry)
            due = at is not None and at < now
            if key in changed or (due and not entry[-1]):
                entry[-1] = due
                tell.append((key, entry))
            if at is not None and not due:
                later.append(at)
        self.store(entries)
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if later:
            self.handle.registerTimer(min(later) // 1000)  # timers know milliseconds
        if tell:
            yield self.frame(tell)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self.settle(self.load(), {}, timerValues)


class PendingQueue(_Timed):
    """Keys whose visits brought no result since the last one that did.

    Of each key: the last result, and the times of the visits without one after it, so that visits may come in any order. A
    key is due for another visit ``retry_us`` after the last of them.
    """

    STATE = "keys array<{}>, done array<long>, missed array<array<long>>, told array<boolean>"
    OUT = "key {}, tries long, last_seen long, due boolean"

    def __init__(self, retry_us: int, key_type: str = "string") -> None:
        self.retry_us, self.key_type = retry_us, key_type

    def at(self, entry: list) -> int | None:
        return entry[1][-1] + self.retry_us if entry[1] else None

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        entries, changed = self.load(), {}
        for some in rows:
            for k, at, resolved in self.rows(key, some, "at", "resolved"):
                done, missed = changed.setdefault(k, [None, []])
                if not resolved:
                    missed.append(at)
                elif done is None or at > done:
                    changed[k][0] = at
        for k, (done, missed) in changed.items():
            before, earlier, told = entries.get(k, (None, [], False))
            done = before if done is None else done if before is None else max(before, done)
            entries[k] = [done, sorted(t for t in [*earlier, *missed] if done is None or t > done), told]
        yield from self.settle(entries, changed, timerValues)

    def frame(self, entries: list[tuple[Any, list]]) -> pd.DataFrame:
        missed = [e[1] for _, e in entries]
        last = pd.array([m[-1] if m else None for m in missed], "Int64")
        return pd.DataFrame({"key": [k for k, _ in entries], "tries": [len(m) for m in missed], "last_seen": last, "due": [e[-1] for _, e in entries]})


class Heartbeat(_Timed):
    """The last event of each key; an active key is reported as stale ``timeout_us`` after it."""

    STATE = "keys array<{}>, last array<long>, active array<boolean>, told array<boolean>"
    OUT = "key {}, last_at long, stale boolean"

    def __init__(self, timeout_us: int, key_type: str = "string") -> None:
        self.timeout_us, self.key_type = timeout_us, key_type

    def at(self, entry: list) -> int | None:
        return entry[0] + self.timeout_us if entry[1] else None

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        entries, changed = self.load(), {}
        for some in rows:
            for k, *here in self.rows(key, some, "at", "active"):
                if k not in changed or here > changed[k]:
                    changed[k] = here
        for k, here in changed.items():
            *before, told = entries.get(k, (*here, False))
            entries[k] = [*max(before, here), told]
        yield from self.settle(entries, changed, timerValues)

    def frame(self, entries: list[tuple[Any, list]]) -> pd.DataFrame:
        return pd.DataFrame({"key": [k for k, _ in entries], "last_at": [e[0] for _, e in entries], "stale": [e[-1] for _, e in entries]})


class SeenDocuments(_Sharded):
    """For each document its first row, once and for all time, and each term that finds it, once. Rows without a term
    make a document known, but no link."""

    OUT = "part string, key {0}, term {1}"

    def __init__(self, term_type: str, key_type: str = "string") -> None:
        self.term_type, self.key_type = term_type, key_type
        self.STATE = f"keys array<{{}}>, terms array<array<{term_type}>>"

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known, first, found = self.load(), {}, {}
        for some in rows:
            for k, term, at, seq in self.rows(key, some, "term", "at", "seq"):
                term = None if pd.isna(term) else term
                if term is not None:
                    found.setdefault(k, set()).add(term)
                if k not in known:
                    here = (pd.isna(at), 0 if pd.isna(at) else at, pd.isna(seq), 0 if pd.isna(seq) else seq)
                    if k not in first or here < first[k][0]:
                        first[k] = (here, term)
        new = {k: sorted(terms.difference(known[k][0]) if k in known else terms) for k, terms in found.items()}
        parts = [("link", k, t) for k, terms in new.items() for t in terms] + [("document", k, term) for k, (_, term) in first.items()]
        if parts:
            for k in [*new, *first]:
                known.setdefault(k, [[]])
            for k, terms in new.items():
                known[k] = [[*known[k][0], *terms]]
            self.store(known)
        yield pd.DataFrame(parts, columns=["part", "key", "term"])


def _us(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _shard(key: str):
    """Null is a shard of its own: pandas would make floats of whole numbers beside it."""
    return F.coalesce(F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(SHARDS))), F.lit(-1)).cast("int").alias("shard")


def stream_pending(visits: DataFrame, key: str, ts: str, resolved: str, retry_s: int, delay: str = "0 seconds") -> DataFrame:
    """(key, tries, last_seen in microseconds, due) whenever a key's entry changes or falls due; tries is 0 for a key that left."""
    use_rocksdb(visits.sparkSession)
    kind = visits.schema[key].dataType.simpleString()
    timed = visits.withWatermark(ts, delay).select(_shard(key), F.col(key).alias("key"), _us(ts).alias("at"), F.coalesce(resolved, F.lit(False)).alias("resolved"), ts)
    return timed.where(F.col("at").isNotNull()).groupBy("shard").transformWithStateInPandas(PendingQueue(retry_s * 1_000_000, kind), PendingQueue.OUT.format(kind), "Update", "EventTime")


def stream_heartbeats(events: DataFrame, key: str, ts: str, active, timeout_s: int, delay: str = "0 seconds") -> DataFrame:
    """(key, last_at in microseconds, stale) whenever a key's last event changes or its timeout passes."""
    use_rocksdb(events.sparkSession)
    kind = events.schema[key].dataType.simpleString()
    timed = events.withWatermark(ts, delay).select(_shard(key), F.col(key).alias("key"), _us(ts).alias("at"), F.coalesce(active, F.lit(False)).alias("active"), ts)
    return timed.where(F.col("at").isNotNull()).groupBy("shard").transformWithStateInPandas(Heartbeat(timeout_s * 1_000_000, kind), Heartbeat.OUT.format(kind), "Update", "EventTime")


def stream_seen(feed: DataFrame, document: str, term: str, ts: str, seq: str) -> DataFrame:
    """(part, key, term): a ``document`` row for each document when it is first seen, with the term that found it first, and a
    ``link`` row for each new pair of document and term, known documents included. No watermark, no time bound."""
    use_rocksdb(feed.sparkSession)
    kind, key_kind = feed.schema[term].dataType.simpleString(), feed.schema[document].dataType.simpleString()
    rows = feed.select(_shard(document), F.col(document).alias("key"), F.col(term).alias("term"), _us(ts).alias("at"), F.col(seq).alias("seq"))
    return rows.groupBy("shard").transformWithStateInPandas(SeenDocuments(kind, key_kind), SeenDocuments.OUT.format(key_kind, kind), "Append", "None")
