"""Named reads that are thin views of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions.times import TimeRange
from talkloom.operators.filters import has_keyword


def sessions(messages: DataFrame, read_marks: DataFrame | None = None) -> DataFrame:
    """The latest message of each chat; with marks (chat_id, read_until) the unread count too."""
    latest = messages.groupBy("chat_id").agg(F.max_by(F.struct("record_id", "timestamp", "text"), F.struct("timestamp", "seq", "record_id")).alias("m"), F.count("*").alias("messages"))
    out = latest.select("chat_id", "messages", F.col("m.record_id").alias("last_record"), F.col("m.timestamp").alias("last_time"), F.col("m.text").alias("last_text"))
    if read_marks is None:
        return out
    unread = messages.join(read_marks, "chat_id").filter(F.col("timestamp") > F.col("read_until")).groupBy("chat_id").agg(F.count("*").alias("unread"))
    return out.join(unread, "chat_id", "left").withColumn("unread", F.coalesce("unread", F.lit(0)))


def filtered_feed(feed: DataFrame, users: tuple[str, ...] = (), keyword: str | None = None, time: TimeRange = TimeRange(), unread_only: bool = False) -> DataFrame:
    """Posts or notifications (user_id, text, timestamp and, if there, is_read)."""
    out = feed.filter(time.holds(F.col("timestamp")))
    if users:
        out = out.filter(F.col("user_id").isin(*users))
    if keyword is not None:
        out = out.filter(has_keyword(keyword, "text"))
    return out.filter(~F.col("is_read")) if unread_only else out


def of_kind(messages: DataFrame, details: DataFrame, kinds: tuple[str, ...], time: TimeRange = TimeRange()) -> DataFrame:
    """Messages of some kinds with their detail rows (record_id, ...): transfers and the like."""
    return messages.filter(F.col("kind").isin(*kinds) & time.holds(F.col("timestamp"))).join(details, "record_id", "left")


def forward_history(forwards: DataFrame) -> DataFrame:
    """The latest forward to each target chat."""
    return forwards.groupBy("target_chat").agg(F.max("timestamp").alias("last_forward"), F.count("*").alias("forwards"))


def contacts(people: DataFrame, friends_only: bool = False, groups_only: bool = False, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Contacts (..., contact_type) by type: only friends, only groups, or some types; what to
    look among when a chat is resolved by :func:`identity.discover`."""
    if friends_only and groups_only:
        raise ValueError("either friends or groups")
    kind = F.lower(F.col("contact_type"))
    out = people.filter(kind == "friend") if friends_only else people.filter(kind == "group") if groups_only else people
    return out.filter(kind.isin(*[k.lower() for k in kinds])) if kinds else out


def contact_stats(contacts: DataFrame, kind: str = "contact_type") -> DataFrame:
    return contacts.groupBy(kind).agg(F.count("*").alias("n"))


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Tables as temporary views for SQL; returns their schema as rows."""
    rows = []
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
        rows += [(name, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string, nullable boolean")
