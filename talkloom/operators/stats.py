"""Statistics of many chats in one pass each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions import texts, times


def sender_key(status: Column, uid: Column, uin: Column) -> Column:
    number = F.nullif(texts.filled(uin), F.lit("0"))
    return (
        F.when(status == "unresolved", "unknown").when(texts.filled(uid).isNotNull(), F.concat(F.lit("uid:"), texts.filled(uid)))
        .when(number.isNotNull(), F.concat(F.lit("uin:"), number)).otherwise("unknown")
    )


def chat_summary(messages: DataFrame) -> DataFrame:
    """One row for each chat: totals, with and without text, first and last time, unresolved."""
    text = F.coalesce(F.col("text"), F.lit("")) != ""
    return messages.groupBy("chat_id").agg(
        F.count("*").alias("total"), F.count_if(text).alias("with_text"), F.count_if(~text).alias("without_text"),
        F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
        F.count_if(F.col("sender_id").isNull()).alias("unknown_senders"),
        F.count_if(F.col("identity_status").isin("unresolved", "conflict")).alias("unresolved"),
    )


def chat_breakdowns(messages: DataFrame) -> DataFrame:
    """Counts by sender, kind and local month as rows (chat_id, dimension, value, n), in one pass
    over grouping sets; the whole chat has the dimension ``all``."""
    rows = messages.select(
        "chat_id", F.coalesce("sender_id", F.lit("unknown")).alias("sender"), F.coalesce("kind", F.lit("unknown")).alias("kind"),
        F.coalesce(times.local_month(F.col("timestamp")), F.lit("unknown")).alias("month"),
    )
    sets = [[F.col("chat_id"), F.col("sender")], [F.col("chat_id"), F.col("kind")], [F.col("chat_id"), F.col("month")], [F.col("chat_id")]]
    found = rows.groupingSets(sets, "chat_id", "sender", "kind", "month").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    name = F.when(F.col("g") == 3, "sender").when(F.col("g") == 5, "kind").when(F.col("g") == 6, "month").otherwise("all")
    return found.select("chat_id", name.alias("dimension"), F.coalesce("sender", "kind", "month", F.lit("")).alias("value"), "n")


def sender_stats(messages: DataFrame) -> DataFrame:
    """By chat and stable sender (null stays unknown): count, latest non-empty name, all names of a
    known sender, first appearance; the order within a chat is count, then first appearance.

    Whoever stands behind an unknown sender may have any number of names; :func:`sender_names` has
    them, and those of all others, as rows.
    """
    order = F.struct("timestamp", "seq", "record_id")
    named = texts.filled(F.col("sender_name")).isNotNull()
    return messages.groupBy("chat_id", "sender_id").agg(
        F.count("*").alias("n"), F.max_by("sender_name", F.when(named, order)).alias("latest_name"),
        F.array_sort(F.collect_set(F.when(named & F.col("sender_id").isNotNull(), F.col("sender_name")))).alias("names"), F.min(order).alias("first"),
    ).withColumn("rank", F.row_number().over(Window.partitionBy("chat_id").orderBy(F.desc("n"), "first"))).drop("first")


def sender_names(messages: DataFrame) -> DataFrame:
    """A row for each non-empty name of each sender of a chat: how often and when first and last."""
    named = messages.filter(texts.filled(F.col("sender_name")).isNotNull())
    return named.groupBy("chat_id", "sender_id", "sender_name").agg(F.count("*").alias("n"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))


def day_stats(messages: DataFrame) -> DataFrame:
    return messages.groupBy("chat_id", times.local_day(F.col("timestamp")).alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.col("kind") == "system").alias("system")
    )


def bounded_scan(messages: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The first ``most`` messages of each chat in time order, and for each chat whether that was
    all of it (``complete``; exactly ``most`` is complete)."""
    if most < 1:
        raise ValueError("at least one message")
    order = Window.partitionBy("chat_id").orderBy("timestamp", "seq", "record_id")
    taken = messages.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= most).drop("__n")
    verdict = messages.groupBy("chat_id").agg(F.count("*").alias("total")).select(
        "chat_id", "total", F.least("total", F.lit(most)).alias("scanned"), F.when(F.col("total") > most, "partial").otherwise("ok").alias("status")
    )
    return taken, verdict


def legacy_summary(messages: DataFrame) -> DataFrame:
    """Counts by month, sender name and kind over everything."""
    return messages.groupBy(times.local_month(F.col("timestamp")).alias("month"), "sender_name", "kind").agg(F.count("*").alias("n"))


def member_stats(members: DataFrame, messages: DataFrame) -> DataFrame:
    """Group members with their message counts, zero included."""
    counts = messages.groupBy("chat_id", F.col("sender_id").alias("uid")).agg(F.count("*").alias("n"))
    return members.join(counts, ["chat_id", "uid"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def status_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))
