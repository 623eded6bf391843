"""What each observation did to its record, counted on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from talkloom.plans.commits import CommitLog, merge_levels
from talkloom.streaming.observe import add_batch

STATES = ("added", "updated", "preserved", "same")


def nulls_first(*values) -> tuple:
    return tuple((v is not None, v) for v in values)


class UpsertCounter(StatefulProcessor):
    """The record of one message and the observations that wait for their turn.

    Observations count in the order of their time, which is not the order in which they come: each
    waits until the watermark has passed it, when no earlier one can come any more.  A timer stands
    at the time of each; the record is forgotten ``forget`` seconds after the last of them, so state
    is bounded by what is in flight and what is remembered.
    """

    def __init__(self, columns: tuple[str, ...], kinds: T.StructType, forget: int | None):
        self.columns, self.kinds, self.forget = columns, kinds, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.kinds)
        self.record = handle.getValueState("record", T.StructType([*self.kinds, T.StructField("held", T.BooleanType()), T.StructField("latest", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = set()
        for frame in rows:
            new = [tuple(None if pd.isna(v) else v for v in r) for r in frame[["observed_at", "recoverable", *self.columns]].itertuples(index=False)]
            self.waiting.appendList([(int(t), bool(recoverable), *rest) for t, recoverable, *rest in new])
            times |= {int(r[0]) for r in new}
        for t in times:
            self.handle.registerTimer(t * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        waiting = [tuple(r) for r in self.waiting.get()]
        due = sorted((r for r in waiting if r[0] * 1000 <= now), key=lambda r: nulls_first(*r))
        if not due:
            if self.record.exists() and (self.record.get()[-1] + (self.forget or 0)) * 1000 <= now:
                self.record.clear()
            return
        left = [r for r in waiting if r[0] * 1000 > now]
        self.waiting.clear()
        if left:
            self.waiting.put(left)
        counts = dict.fromkeys(STATES, 0)
        record = tuple(self.record.get()) if self.record.exists() else None
        for row in due:
            record = self.step(record, row, counts)
        self.record.update(record)
        if self.forget is not None:
            self.handle.registerTimer((due[-1][0] + self.forget) * 1000)
        yield pd.DataFrame([[key[0], *counts.values()]], columns=["chat_id", *STATES])

    @staticmethod
    def step(record: tuple | None, row: tuple, counts: dict[str, int]) -> tuple:
        """Count what ``row`` (time, recoverable, columns) does to ``record`` (the same of the row
        that it keeps, whether any was recoverable, the latest time) and give the record after it."""
        order = lambda r: nulls_first(r[1], r[0], *r[2:])
        if record is None:
            counts["added"] += 1
            return *row, row[1], row[0]
        *kept, held, latest = record
        counts["preserved" if held and not row[1] else "updated" if tuple(row[2:]) != tuple(kept[2:]) else "same"] += 1
        best = max(tuple(kept), row, key=order)
        return *best, held or row[1], max(latest, row[0])


def upserts(observations: DataFrame, late: str, keys: tuple[str, ...] = ("chat_id", "msg_id"), columns: tuple[str, ...] = ("text", "kind"), forget: int | None = None) -> DataFrame:
    """A stream of observations (keys, observed_at in seconds, recoverable, columns) -> a stream of
    (chat_id, added, updated, preserved, same), a row for a message and a moment; summed by chat they
    are what :func:`talkloom.operators.observe.upsert_counts` gives for the whole table.

    Input may come in any order as long as it is at most ``late`` behind the latest; what is later is
    dropped.  Observations count once the watermark has passed them.  Repeated ones count again.  With
    ``forget``, a message that is not observed for so many seconds begins anew.

    State is arbitrary state by key; the session must keep it in RocksDB (ValueError otherwise).
    """
    provider = observations.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "")
    if "RocksDB" not in provider:
        raise ValueError("set spark.sql.streaming.stateStore.providerClass to the RocksDB provider")
    read = observations.select(*keys, F.col("observed_at").cast("bigint").alias("observed_at"), F.coalesce("recoverable", F.lit(False)).alias("recoverable"), *columns)
    read = read.withColumn("event_time", F.timestamp_seconds("observed_at")).withWatermark("event_time", late)
    kinds = T.StructType([read.schema[c] for c in ("observed_at", "recoverable", *columns)])
    made = T.StructType([T.StructField("chat_id", read.schema[keys[0]].dataType), *(T.StructField(s, T.LongType()) for s in STATES)])
    counter = UpsertCounter(columns, kinds, forget)
    return read.groupBy(*keys).transformWithStateInPandas(counter, made, "append", "EventTime")


def stream_upserts(observations: DataFrame, path: str, checkpoint: str, late: str = "1 hour", fan: int = 8, **how) -> StreamingQuery:
    """:func:`upserts` summed by batch and chat, each batch a part that is added once, parts merged by
    level.  :func:`read_upserts` gives the counts, of all batches or of each."""
    log = CommitLog(observations.sparkSession, path)

    def commit(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("chat_id").agg(*[F.sum(s).alias(s) for s in STATES])
        add_batch(log, sums, number)
        merge_levels(log, lambda old, *place: log.write(log.frame(old), *place), fan)

    return upserts(observations, late, **how).writeStream.outputMode("append").foreachBatch(commit).option("checkpointLocation", checkpoint).start()


def read_upserts(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """Counts by chat, further ``by`` ``batch`` if asked for."""
    log = CommitLog(spark, path)
    rows = log.frame(log.latest().parts)
    if rows is None:
        raise ValueError("nothing has been committed yet")
    return rows.groupBy("chat_id", *by).agg(*[F.sum(s).alias(s) for s in STATES])
