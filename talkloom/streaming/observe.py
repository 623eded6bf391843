"""The stateful operators on streams: same results as on the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talkloom.operators.observe import fold_observations
from talkloom.plans.commits import CommitLog, merge_levels


def add_batch(log: CommitLog, rows: DataFrame, number: int) -> None:
    """A batch's rows as a part, once: a batch that is run again finds its number and adds nothing."""
    held = lambda commit: any(p.first <= number <= p.last for p in commit.parts)
    if not held(log.latest()):
        part = log.write(rows.withColumn("batch", F.lit(number).cast("bigint")), 0, number, number)
        log.update(lambda commit: None if held(commit) else ((*commit.parts, part), commit.facts))


def _latest_rows(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    columns = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("row"))
    return latest.select(*keys, *[f"row.{c}" for c in columns])


def stream_cache(observations: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("chat_id", "msg_id"), fan: int = 8) -> StreamingQuery:
    """The observation cache in update mode: the fold is an aggregate, so state is one row a
    message, kept by Spark; each batch adds only the messages it changed, as a part of its own.

    Every ``fan`` parts of a level are merged into one of the next, so n batches leave fewer than
    ``fan`` parts on each of log(n) levels.  :func:`read_cache` gives the table, at any time.
    """
    log = CommitLog(observations.sparkSession, path)

    def commit(batch: DataFrame, number: int) -> None:
        add_batch(log, batch, number)
        merge_cache(log.spark, path, keys, fan)

    folded = fold_observations(observations, keys)
    return folded.writeStream.outputMode("update").foreachBatch(commit).option("checkpointLocation", checkpoint).start()


def merge_cache(spark: SparkSession, path: str, keys: tuple[str, ...] = ("chat_id", "msg_id"), fan: int = 8) -> None:
    """Merge a cache's parts by level, each message to its latest row.  The stream may go on."""
    log = CommitLog(spark, path)
    merge_levels(log, lambda old, *place: log.write(_latest_rows(log.frame(old), keys), *place), fan)


def clean_cache(spark: SparkSession, path: str, older: float = 24 * 3600) -> list[str]:
    """Remove parts that merges have replaced, ``older`` seconds after they were written."""
    return CommitLog(spark, path).clean(older=older)


def read_cache(spark: SparkSession, path: str, keys: tuple[str, ...] = ("chat_id", "msg_id")) -> DataFrame:
    """The latest row of each message of a cache written by :func:`stream_cache`, as of its last
    commit; merges that go on meanwhile do not change it."""
    log = CommitLog(spark, path)
    rows = log.frame(log.latest().parts)
    if rows is None:
        raise ValueError("nothing has been committed yet")
    return _latest_rows(rows, keys).drop("batch")


def stream_recoveries(events: DataFrame, cached: DataFrame, window: int, late: str = "10 minutes") -> DataFrame:
    """Withdrawals with cached records at most ``window`` seconds older: an interval join of two
    streams; both sides' state is bounded by watermarks (ours, no part of the batch meaning)."""
    e = events.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", late).select(F.col("chat_id").alias("e_chat"), F.col("msg_id").alias("event_id"), "event_time")
    c = cached.filter("recoverable").withColumn("cached_time", F.timestamp_seconds("timestamp")).withWatermark("cached_time", late).select("chat_id", "msg_id", "cached_time")
    span = F.expr(f"cached_time BETWEEN event_time - INTERVAL {int(window)} SECONDS AND event_time")
    return e.join(c, (F.col("e_chat") == F.col("chat_id")) & span)


def stream_without_duplicates(messages: DataFrame, time: Column, late: str = "1 hour", keys: tuple[str, ...] = ("source", "record_id")) -> DataFrame:
    """Records once, as long as copies arrive within the watermark."""
    return messages.withColumn("__time", time).withWatermark("__time", late).dropDuplicatesWithinWatermark(list(keys)).drop("__time")


def append_snapshot(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A resumable export: each batch's records land in the dataset under the batch's number, once
    even if the batch is run again.  Records that come twice are the caller's to drop
    (:func:`stream_without_duplicates`)."""

    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return messages.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
