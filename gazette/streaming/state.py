"""Keyed state with event-time timers: first-seen records that are forgotten, and alerts that are sent once.

The watermark is the clock: a timer fires when all records up to ``delay`` before it have been seen. State is
in RocksDB and goes with its key's timer, so it holds the keys of the retention time and not all that ever came.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, which timers need; the session's setting stays as it is."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def _in_order(rows: Iterator[pd.DataFrame]) -> list:
    """A key's records of a batch by time and sequence; a batch repeats few records a key."""
    found = [r for part in rows for r in part.itertuples(index=False)]
    return sorted(found, key=lambda r: (r.at_ms, r.seq))


class FirstSeen(StatefulProcessor):
    """The newest record of a key and when the key was first seen; forgotten ``keep_ms`` after its newest record."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("record", "first_ms long, at_ms long, seq long, data string, n int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        first, at, seq, data, n = held if held else (None, None, None, None, 0)
        before = at
        for r in _in_order(rows):
            first = r.at_ms if first is None else min(first, r.at_ms)
            if at is None or (r.at_ms, r.seq) > (at, seq):
                at, seq, data = int(r.at_ms), int(r.seq), r.data
        if before is not None and before != at:
            self.handle.deleteTimer(before + self.keep_ms)
        self.handle.registerTimer(at + self.keep_ms)
        self.state.update((int(first), at, seq, data, n + 1))
        yield pd.DataFrame([(*key, int(first), at, seq, data, n + 1, False)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            first, at, seq, data, n = self.state.get()
            self.state.clear()
            yield pd.DataFrame([(*key, first, at, seq, data, n + 1, True)])

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, key: Sequence[str], at: str, seq: str, data: str, keep: str = "30 days", delay: str = "7 days") -> DataFrame:
    """A change of a key's record a row: key, first_seen, at, seq, data, version, expired. The last version of a key holds.

    ``at``: the records' event time. A record that is later than the watermark (``delay`` behind the newest) is dropped. A key is
    expired once no record has come for ``keep``; if it comes again it is new. Rows without a key, time or sequence are left out.
    """
    keep_ms = milliseconds(keep)
    known = stream.select(*key, F.col(at).cast("timestamp").alias("at"), F.col(seq).cast("long").alias("seq"), F.col(data).cast("string").alias("data")).dropna(subset=[*key, "at", "seq"])
    rows = known.withColumn("at_ms", F.unix_millis("at")).withWatermark("at", delay)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in key]
    made = rows.groupBy(*key).transformWithStateInPandas(FirstSeen(keep_ms), ", ".join([*fields, "first_ms long, at_ms long, seq long, data string, version int, expired boolean"]), "Append", "EventTime")
    return made.select(*key, F.timestamp_millis("first_ms").alias("first_seen"), F.timestamp_millis("at_ms").alias("at"), "seq", "data", "version", "expired")


class Alerts(StatefulProcessor):
    """One alert a kind and date of a notice, when its day has come; a moved date moves the alert that wasn't sent yet."""

    def __init__(self, lead: dict[str, int], keep_ms: int):
        self.lead, self.keep_ms = lead, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.notice = handle.getValueState("notice", "at_ms long, seq long, forget_ms long")
        #: By kind: the date, when it is to be sent, and the date that was sent last.
        self.due = handle.getMapState("due", "kind string", "date_ms long, send_ms long, sent_ms long")

    def _timers(self) -> dict[str, tuple]:
        return {k[0]: v for k, v in self.due.iterator()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        *newest, forget = self.notice.get() if self.notice.exists() else (-1, -1, -1)
        last = None
        for r in _in_order(rows):
            if (r.at_ms, r.seq) > tuple(newest):
                newest, last = (int(r.at_ms), int(r.seq)), r
        if last is None:
            return
        held = self._timers()
        before = {v[1] for v in held.values() if v[1] >= 0} | ({forget} if forget >= 0 else set())
        now = timerValues.getCurrentWatermarkInMs()
        # Once all its dates are long past, nothing of a notice can be sent again.
        forget = max([newest[0], *[int(getattr(last, kind)) for kind in self.lead if not pd.isna(getattr(last, kind))]]) + self.keep_ms
        self.notice.update((*newest, forget))
        after = {forget}
        for kind, lead in self.lead.items():
            date = getattr(last, kind)
            sent = held[kind][2] if kind in held else -1
            if pd.isna(date):
                self.due.updateValue((kind,), (-1, -1, sent))
                continue
            date, send = int(date), int(date) - lead
            # What was sent isn't sent again, and what has passed already isn't sent at all.
            wanted = date != sent and date >= now
            self.due.updateValue((kind,), (date, send if wanted else -1, sent))
            if wanted:
                after.add(send)
        for t in before - after:
            self.handle.deleteTimer(t)
        for t in after - before:
            self.handle.registerTimer(t)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        for kind, (date, send, _) in sorted(self._timers().items()):
            if send == fired:
                self.due.updateValue((kind,), (date, -1, date))
                out.append((*key, kind, date))
        if self.notice.exists() and self.notice.get()[2] == fired:
            self.notice.clear()
            self.due.clear()
        if out:
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def alerts(stream: DataFrame, key: Sequence[str], at: str, seq: str, dates: dict[str, tuple[str, int]], delay: str = "1 day", keep: str = "30 days") -> DataFrame:
    """key, kind, date of each alert. dates: by kind the timestamp column and the days before it.

    A notice's newest record (by ``at`` and ``seq``) holds. The clock is the watermark: ``delay`` behind the newest record. A date that was
    sent last isn't sent again, one that had passed when it came isn't sent at all. A notice is forgotten ``keep`` after its last date.
    """
    known = stream.select(*key, F.col(at).cast("timestamp").alias("at"), F.col(seq).cast("long").alias("seq"), *[F.unix_millis(F.col(c).cast("timestamp")).alias(kind) for kind, (c, _) in dates.items()]).dropna(subset=[*key, "at", "seq"])
    rows = known.withColumn("at_ms", F.unix_millis("at")).withWatermark("at", delay)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in key]
    lead = {kind: days * DAY_MS for kind, (_, days) in dates.items()}
    made = rows.groupBy(*key).transformWithStateInPandas(Alerts(lead, milliseconds(keep)), ", ".join([*fields, "kind string, date_ms long"]), "Append", "EventTime")
    return made.select(*key, "kind", F.timestamp_millis("date_ms").alias("date"))


def milliseconds(interval: str) -> int:
    """Milliseconds of '<n> days|hours|minutes|seconds'."""
    n, unit = interval.split()
    return int(n) * {"day": DAY_MS, "hour": 3_600_000, "minute": 60_000, "second": 1_000}[unit.rstrip("s")]


def run_to_table(changes: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream of changes over all that is there, and gives what is stored at ``path``; the file log of the sink stores each batch once."""
    spark = changes.sparkSession
    with rocks_state(spark):
        query = changes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(changes.schema).parquet(path)


def newest(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last version of each key, of a stored table of changes; a key that came again after it expired starts from version 1."""
    rest = [c for c in changes.columns if c not in key]
    return changes.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("at", "seq", "expired", "version")).alias("top")).select(*key, *[F.col(f"top.{c}").alias(c) for c in rest])
