"""Observations of messages over time, and what they recover after a withdrawal.

Joins whose sides grow with the messages ask for a merge.  Spark judges a side by its compressed
files and by what it was before ``explode``, and would send millions of rows through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.operators.lookup import positions
from talkloom.sources.scratch import kept


def fold_observations(log: DataFrame, keys: tuple[str, ...] = ("chat_id", "msg_id"), columns: tuple[str, ...] = ("text", "kind")) -> DataFrame:
    """The cache that replaying ``log`` (keys, observed_at, recoverable, columns) would give.

    A record gives way to a later one unless it is recoverable and the later one is not, so what
    stays is the latest recoverable observation, else the latest: an aggregate that needs no
    order, no state of its own, and works on streams as it does here.
    """
    rank = F.struct("recoverable", "observed_at", *columns)
    found = log.groupBy(*keys).agg(
        F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), F.count("*").alias("seen_count"), F.max(rank).alias("kept")
    )
    return found.select(*keys, "first_seen", "last_seen", "seen_count", "kept.recoverable", *[f"kept.{c}" for c in columns])


def upsert_counts(log: DataFrame, keys: tuple[str, ...] = ("chat_id", "msg_id"), columns: tuple[str, ...] = ("text", "kind")) -> DataFrame:
    """By chat: observations that added a record, updated it, or left a recoverable one alone."""
    order = Window.partitionBy(*keys).orderBy("observed_at", "recoverable", *columns)  # ties by content
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    content = F.struct("recoverable", "observed_at", *columns)
    kept = F.max(content).over(earlier)
    number = F.row_number().over(order)
    held = F.coalesce(F.max(F.col("recoverable")).over(earlier), F.lit(False)) & ~F.col("recoverable")
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(kept[c])
    state = F.when(number == 1, "added").when(held, "preserved").when(changed, "updated").otherwise("same")
    rows = log.select(keys[0], state.alias("state"))
    return rows.groupBy(keys[0]).agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("added", "updated", "preserved")])


def recall_context(messages: DataFrame, recall: Column, size: int = 3) -> DataFrame:
    """Every withdrawal with the ids of the rows before and after it in its chat.

    Neighbours are joined by their place in the chat, so a huge chat is not ordered in one task.
    """
    placed = kept(positions(messages.withColumn("__recall", recall), "msg_id"), "positions")
    events = placed.filter("__recall").select(*messages.columns, "position")
    steps = F.array(*[F.lit(i) for i in range(-size, size + 1) if i])
    wanted = events.select("chat_id", F.col("msg_id").alias("__event"), F.col("position").alias("__at"), F.explode(steps).alias("__step"))
    near = wanted.withColumn("position", F.col("__at") + F.col("__step")).join(placed.select("chat_id", "position", "msg_id").hint("merge"), ["chat_id", "position"])
    side = lambda mine, name: F.transform(F.array_sort(F.collect_list(F.when(mine, F.struct("__step", "msg_id")))), lambda x: x["msg_id"]).alias(name)
    found = near.groupBy("chat_id", "__at").agg(side(F.col("__step") < 0, "preceding"), side(F.col("__step") > 0, "following"))
    joined = events.join(found.withColumnRenamed("__at", "position").hint("merge"), ["chat_id", "position"], "left")
    none = F.array().cast(f"array<{messages.schema['msg_id'].dataType.simpleString()}>")
    return joined.select(*messages.columns, F.coalesce("preceding", none).alias("preceding"), F.coalesce("following", none).alias("following"))


def exact_recoveries(events: DataFrame, cache: DataFrame) -> DataFrame:
    """Withdrawn messages whose own cached record is recoverable."""
    return events.select("chat_id", "msg_id").join(cache.filter("recoverable").select("chat_id", "msg_id", "text").hint("merge"), ["chat_id", "msg_id"])


def recall_candidates(events: DataFrame, cache: DataFrame, live: DataFrame, window: int = 3600, most: int = 5) -> DataFrame:
    """For withdrawals (chat_id, msg_id, timestamp) without an exact recovery: cached recoverable
    records (chat_id, msg_id, timestamp) that are no longer live, at most ``window`` seconds
    older, nearest first, ``most`` of them.

    Records in order of their time, and in a second by falling id: an event needs the last
    ``most`` before it.  They are numbered in each step (a 64th of the window), behind the last
    ``most`` of the steps before, so an event meets ``most`` records by their numbers and no others.
    Events of one second need the same ones and are asked for once; of the records of one second
    the nearest ``most`` are kept.  So a step holds a bounded number of rows, however hot the chat.
    """
    step = max(1, window // 64)
    of_step = F.floor(F.col("timestamp") / step)
    exact = exact_recoveries(events, cache).select("chat_id", "msg_id")
    open_ = events.filter("timestamp > 0").join(exact.hint("merge"), ["chat_id", "msg_id"], "left_anti").select("chat_id", F.col("msg_id").alias("event_id"), F.col("timestamp").alias("event_ts"))
    open_ = kept(open_, "withdrawals")
    gone = cache.filter("recoverable AND timestamp IS NOT NULL").join(live.hint("merge"), ["chat_id", "msg_id"], "left_anti").select("chat_id", "msg_id", "timestamp", of_step.alias("step"))

    def nearest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
        return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__r") <= most).drop("__r")

    seconds = kept(nearest(gone, ["chat_id", "timestamp"], ["msg_id"]), "seconds")
    back = [F.desc("timestamp"), "msg_id"]
    moments = open_.select("chat_id", F.col("event_ts").alias("timestamp")).distinct().withColumn("step", of_step)
    first = F.floor((F.col("least") - window) / step)
    asked = moments.groupBy("chat_id", F.col("step").alias("at")).agg(F.min("timestamp").alias("least")).filter(first < F.col("at"))
    earlier = asked.select("chat_id", "at", F.explode(F.sequence(first, F.col("at") - 1)).alias("step")).join(nearest(seconds, ["chat_id", "step"], back).hint("merge"), ["chat_id", "step"])
    carried = nearest(earlier.drop("step").withColumnRenamed("at", "step"), ["chat_id", "step"], back)
    rows = seconds.unionByName(carried).withColumn("asks", F.lit(0)).unionByName(moments.withColumn("asks", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy("chat_id", "step").orderBy("timestamp", "asks", F.desc("msg_id")).rowsBetween(Window.unboundedPreceding, 0)
    placed = kept(rows.withColumn("number", F.count_if(F.col("asks") == 0).over(so_far)), "placed")
    numbers = F.explode(F.sequence(F.greatest(F.col("number") - most + 1, F.lit(1)), F.col("number")))
    wanted = placed.filter("asks = 1 AND number > 0").select("chat_id", "step", F.col("timestamp").alias("event_ts"), numbers.alias("number"))
    answers = wanted.join(placed.filter("asks = 0").drop("asks").hint("merge"), ["chat_id", "step", "number"]).withColumn("seconds", F.col("event_ts") - F.col("timestamp")).filter(F.col("seconds").between(0, window))
    pairs = open_.join(answers.hint("merge"), ["chat_id", "event_ts"])
    order = Window.partitionBy("chat_id", "event_id").orderBy("seconds", "msg_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("chat_id", "event_id", "rank", "msg_id", "seconds")


def latest_of(messages: DataFrame, most: int) -> DataFrame:
    """The newest ``most`` rows of each chat."""
    order = Window.partitionBy("chat_id").orderBy(F.desc("timestamp"), F.desc("seq"), F.desc("msg_id"))
    return messages.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= most).drop("__r")


def first_events(events: DataFrame, limit: int, descending: bool = False) -> DataFrame:
    """The first ``limit`` withdrawals of each chat in either order."""
    keys = [F.desc(c) if descending else F.asc(c) for c in ("timestamp", "seq", "msg_id")]
    return events.withColumn("__r", F.row_number().over(Window.partitionBy("chat_id").orderBy(*keys))).filter(F.col("__r") <= limit).drop("__r")


def recall_report(messages: DataFrame, recall: Column, cache: DataFrame, live: DataFrame, window: int = 3600, size: int = 3, most: int = 5) -> DataFrame:
    """Withdrawals end to end: (chat_id, msg_id, preceding, following, recovered_text, candidates)."""
    events = recall_context(messages, recall, size).select("chat_id", "msg_id", "timestamp", "preceding", "following")
    exact = exact_recoveries(events, cache).withColumnRenamed("text", "recovered_text")
    near = recall_candidates(events, cache, live, window, most).groupBy("chat_id", F.col("event_id").alias("msg_id")).agg(F.array_sort(F.collect_list(F.struct("rank", "msg_id", "seconds"))).alias("candidates"))
    return events.join(exact.hint("merge"), ["chat_id", "msg_id"], "left").join(near.hint("merge"), ["chat_id", "msg_id"], "left")
