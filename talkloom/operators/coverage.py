"""How complete an answer is, as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEGRADED = ("fts_unavailable", "self_identity_unresolved", "source_degraded")


def source_complete(warnings: Column) -> Column:
    """No warning says that the source was degraded."""
    return ~F.coalesce(F.exists(warnings, lambda w: F.regexp_extract(w, "^([a-z_]+)", 1).isin(*DEGRADED)), F.lit(False))


def chat_coverage(rows: DataFrame, index_available: bool = True, self_known: bool = True) -> DataFrame:
    """By chat: rows scanned, completeness of source and identities, reasons in a fixed order."""
    unresolved = F.bool_or(F.col("identity_status").isin("unresolved", "conflict", "unknown"))
    reasons = F.array_compact(F.array(F.when(F.lit(not index_available), F.lit("fts_unavailable")), F.when(F.lit(not self_known), F.lit("self_identity_unresolved"))))
    return rows.groupBy("chat_id").agg(F.count("*").alias("scanned"), unresolved.alias("__u")).select(
        "chat_id", "scanned", (F.size(reasons) == 0).alias("source_complete"), (~F.col("__u")).alias("identity_complete"),
        F.coalesce(F.get(reasons, F.lit(0)), F.lit("local_sources_readable")).alias("reason"),
    )


def violations(rows: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """What is wrong with each row: no id, no valid time, outside the range, foreign chat."""
    time = F.col("timestamp")
    outside = F.lit(False)
    if start is not None:
        outside = outside | (time < start)
    if end is not None:
        outside = outside | (time >= end)
    foreign = F.col("requested_chat") != F.col("chat_id") if "requested_chat" in rows.columns else F.lit(False)
    bad = F.array_compact(F.array(
        F.when(F.coalesce(F.col("message_id"), F.lit("")) == "", F.lit("missing_id")), F.when(time.isNull() | (time < 0), F.lit("invalid_time")),
        F.when(outside, F.lit("outside_range")), F.when(foreign, F.lit("foreign_chat")),
    ))
    return rows.withColumn("violations", bad)


def published(rows: DataFrame) -> DataFrame:
    """Only chats without a bad row; one bad row withholds its whole chat."""
    bad = rows.filter(F.size("violations") > 0).select("chat_id").distinct()
    return rows.join(bad, "chat_id", "left_anti")


def publication_status(rows: DataFrame) -> DataFrame:
    bad = F.count_if(F.size("violations") > 0)
    return rows.groupBy("chat_id").agg(F.count("*").alias("n"), bad.alias("bad"), F.when(bad > 0, "partial").otherwise("ok").alias("status"))


def source_gate(rows: DataFrame, statuses: DataFrame) -> DataFrame:
    """The merged rows, or none if any source (source, ok) failed."""
    failed = statuses.agg(F.count_if(~F.col("ok")).alias("failed"))  # one row
    return rows.crossJoin(F.broadcast(failed)).filter("failed = 0").drop("failed")


def request_conflicts(requests: DataFrame, key: str, *fields: str) -> DataFrame:
    """Requests whose alternative fields name different things."""
    values = F.array_distinct(F.array_compact(F.array(*[F.nullif(F.trim(F.col(f).cast("string")), F.lit("")) for f in fields])))
    return requests.select(key, F.when(F.size(values) > 1, "rejected").when(F.size(values) == 0, "missing").otherwise("ok").alias("status"), F.when(F.size(values) == 1, F.get(values, F.lit(0))).alias("value"))


def with_failures(rows: DataFrame, failures: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows keep their place when an enrichment (key, error) failed; the failure is a warning."""
    joined = rows.join(failures.groupBy(key).agg(F.min("error").alias("__error")), key, "left")
    warning = F.array_append(F.coalesce("warnings", F.array().cast("array<string>")), F.concat(F.lit("enrichment_failed: "), "__error"))
    return joined.withColumn("warnings", F.when(F.col("__error").isNull(), F.col("warnings")).otherwise(warning)).drop("__error")


def pagination_coverage(pages: DataFrame) -> DataFrame:
    """By chat, of page rows (chat_id, has_more, failed): was everything read, and if not, why."""
    more, failed = F.bool_or("has_more"), F.bool_or("failed")
    reasons = F.array_compact(F.array(F.when(failed, "page_failed"), F.when(more, "more_pages")))
    return pages.groupBy("chat_id").agg(F.count("*").alias("pages"), reasons.alias("reasons")).withColumn("pagination_complete", F.size("reasons") == 0)
