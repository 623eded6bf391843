"""Single messages and their surroundings, for many targets in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.sources.scratch import kept

FACTS = ("message_id", "timestamp", "sender_id", "direction", "kind", "text")


def second_of(record: Column) -> Column:
    """The second that a nested source's record id holds, for pruning."""
    return F.split(record, ":")[3].try_cast("bigint")


def locate(messages: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` (target_id, chat_id, record_id) -> status ok, not_found or ambiguous, and the
    number of matches."""
    found = targets.join(messages.select("chat_id", "record_id", F.lit(1).alias("hit")), ["chat_id", "record_id"], "left")
    n = F.count("hit")
    status = F.when(n == 0, "not_found").when(n == 1, "ok").otherwise("ambiguous")
    return found.groupBy("target_id", "chat_id", "record_id").agg(n.alias("matches"), status.alias("status"))


def positions(messages: DataFrame, record: str = "record_id") -> DataFrame:
    """Place of each message in its chat by (timestamp, seq, ``record``), and how often its id
    occurs within its second.

    Chats are counted by day first, so a huge chat is numbered in many tasks: the place in the
    day by a window of that day, plus all earlier days of the chat.  Days are merged in, not sent
    to all tasks, since they grow with the chats; the rows are dealt by day already.
    """
    day = F.floor(F.col("timestamp") / 86400)
    rows = messages.withColumn("__day", day)
    counts = rows.groupBy("chat_id", "__day").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("chat_id").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("chat_id", "__day", F.coalesce(before, F.lit(0)).alias("__before"))
    order = Window.partitionBy("chat_id", "__day").orderBy("timestamp", "seq", record)
    same = Window.partitionBy("chat_id", "__day", "timestamp", record)
    placed = rows.withColumn("__r", F.row_number().over(order)).withColumn("same_second", F.count("*").over(same))
    return placed.join(starts.hint("merge"), ["chat_id", "__day"]).withColumn("position", F.col("__before") + F.col("__r")).drop("__day", "__n", "__before", "__r")


def context(messages: DataFrame, targets: DataFrame, before: int = 10, after: int = 10) -> DataFrame:
    """Neighbours of each target (target_id, chat_id, record_id), in order, side by side.

    ``(target_id, side, steps, record_id, timestamp, text)`` with side before, target or after.
    Targets that are missing or not unique within their second have no rows.
    """
    if not (0 <= before <= 50 and 0 <= after <= 50):
        raise ValueError("between 0 and 50 neighbours on a side")
    # used twice, for the targets and for their neighbours: placed once
    placed = kept(positions(messages).select("chat_id", "record_id", "timestamp", "text", "position", "same_second"), "positions")
    mine = targets.join(placed.filter("same_second = 1").select("chat_id", "record_id", "position"), ["chat_id", "record_id"])
    wanted = mine.select("target_id", "chat_id", F.col("position").alias("__at"), F.explode(F.sequence(F.col("position") - before, F.col("position") + after)).alias("position"))
    found = wanted.join(placed, ["chat_id", "position"])
    steps = F.col("position") - F.col("__at")
    side = F.when(steps < 0, "before").when(steps > 0, "after").otherwise("target")
    return found.select("target_id", side.alias("side"), steps.alias("steps"), "record_id", "timestamp", "text")


def same_facts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two reads of the same records: does each still state the same facts?"""
    both = old.alias("a").join(new.alias("b"), ["chat_id", "record_id"], "left")
    equal = F.lit(True)
    for c in FACTS:
        equal = equal & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return both.select("chat_id", "record_id", F.when(F.col("b.timestamp").isNull(), "missing").when(equal, "same").otherwise("changed").alias("verdict"))


def only_match(candidates: DataFrame, key: str, exact: Column, complete: Column) -> DataFrame:
    """One exact match among candidates; an incomplete list never proves it the only one."""
    n = F.count_if(exact)
    return candidates.groupBy(key).agg(
        n.alias("exact"), F.when(n == 0, "not_found").when((n == 1) & F.bool_and(complete), "ok").otherwise("ambiguous").alias("status")
    )


def overlapping_sides(around: DataFrame) -> DataFrame:
    """Targets whose sides share a record: their order was not consistent."""
    before, after = around.filter("side = 'before'"), around.filter("side = 'after'")
    return before.select("target_id", "record_id").intersect(after.select("target_id", "record_id")).select("target_id").distinct()
