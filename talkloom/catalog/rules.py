"""Coverage rules, small lookups and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import Registry, flat_rows, over, q_messages, w_messages
from talkloom.functions import media as on
from talkloom.functions import texts
from talkloom.operators import coverage, filters, identity, lookup, media, normalize, observe, paging, stats
from talkloom.sources import readers

query = Registry()


@query("SELECT event_id, event_id % 3 <> 0 AS complete FROM events")
def source_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 3
    warnings = F.when(n == 0, F.array(F.lit("other"), F.lit("fts_unavailable: no index"))).when(n == 1, F.array(F.lit("sender_identity_conflict")))
    return readers.table(spark, sf_dir, "events").select("event_id", coverage.source_complete(warnings).alias("complete"))


@query(over("SELECT record_id, chat_id <> '' AND message_id <> '' AS complete FROM w"))
def identity_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = identity.identity_complete(F.col("chat_id"), F.col("timestamp"), F.nullif("message_id", F.lit("")), F.lit(None).cast("string"))
    return w_messages(spark, sf_dir).select("record_id", complete.alias("complete"))


@query(over("SELECT source, count(*) AS n FROM msgs WHERE source = 'w' GROUP BY source"))
def source_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate holds back everything if a source failed; here the failing one belongs elsewhere."""
    rows = paging.merge_sources(w_messages(spark, sf_dir), q_messages(spark, sf_dir))
    good = spark.createDataFrame([("w", True)], "source string, ok boolean")
    bad = spark.createDataFrame([("w", True), ("q", False)], "source string, ok boolean")
    kept = coverage.source_gate(rows.filter("source = 'w'"), good).unionByName(coverage.source_gate(rows, bad))
    return kept.groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT user_id AS chat_id, count(*) AS pages, concat_ws(',', CASE WHEN bool_or(value < 1) THEN 'page_failed' END, CASE WHEN bool_or(event_id % 40 = 0) THEN 'more_pages' END) AS reasons, NOT (bool_or(value < 1) OR bool_or(event_id % 40 = 0)) AS pagination_complete FROM events GROUP BY user_id")
def pagination_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = readers.table(spark, sf_dir, "events").select(F.col("user_id").alias("chat_id"), (F.col("event_id") % 40 == 0).alias("has_more"), (F.col("value") < 1).alias("failed"))
    return coverage.pagination_coverage(pages).withColumn("reasons", F.array_join("reasons", ","))


@query("SELECT d.doc_id, CASE WHEN quality = 0 THEN 'enrichment_failed: low' ELSE '' END AS warnings FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("array<string>").alias("warnings"))
    failed = readers.table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id", F.lit("low").alias("error"))
    return coverage.with_failures(rows, failed, "doc_id").withColumn("warnings", F.coalesce(F.array_join("warnings", ","), F.lit("")))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS exact, CASE WHEN count(*) FILTER (WHERE event_type = 'click') = 0 THEN 'not_found' WHEN count(*) FILTER (WHERE event_type = 'click') = 1 AND bool_and(value > 1) THEN 'ok' ELSE 'ambiguous' END AS status FROM events GROUP BY user_id")
def only_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.only_match(readers.table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "click", F.col("value") > 1)


@query(over("SELECT event_type AS stage, status, count(*) AS n FROM (SELECT event_type, CASE WHEN event_id % 7 = 0 THEN 'failed' WHEN event_id % 7 = 1 THEN 'unsupported' ELSE 'ok' END AS status FROM events) GROUP BY ALL"))
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from talkloom.operators.enrich import stage_status

    n = F.col("event_id") % 7
    word = F.when(n == 0, "Timeout").when(n == 1, "not_applicable").when(n == 2, "no_text").otherwise("OK")
    rows = readers.table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), stage_status(word).alias("status"))
    return stats.status_counts(rows, "stage", "status")


@query(over("SELECT chat_id, msg_id, text FROM flat WHERE kind = 'recall/system' AND text IS NOT NULL AND msg_id % 3 <> 0"))
def exact_recoveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat_rows(spark, sf_dir)
    cache = rows.select("chat_id", "msg_id", "text", (F.col("text").isNotNull() & (F.col("msg_id") % 3 != 0)).alias("recoverable"))
    return observe.exact_recoveries(rows.filter("kind = 'recall/system'"), cache)


@query(over("SELECT chat_id, msg_id FROM (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY timestamp DESC, seq DESC, msg_id DESC) AS r FROM flat WHERE kind = 'recall/system') WHERE r <= 20"))
def first_recalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    recall = filters.is_recall(F.col("kind"), F.col("type_code"), F.col("msg_code"), F.col("text"))
    return observe.first_events(flat_rows(spark, sf_dir).filter(recall), 20, descending=True).select("chat_id", "msg_id")


@query(over("""SELECT e.msg_id, c.text AS recovered_text, coalesce(k.n, 0) AS candidates FROM flat e LEFT JOIN (SELECT msg_id, text FROM flat WHERE text IS NOT NULL AND msg_id % 2 = 0 AND msg_id % 3 <> 0) c ON c.msg_id = e.msg_id
  LEFT JOIN (SELECT e.msg_id, least(count(*), 5) AS n FROM flat e JOIN flat o ON o.chat_id = e.chat_id AND e.timestamp - o.timestamp BETWEEN 0 AND 7200 AND o.text IS NOT NULL AND o.msg_id % 3 <> 0 AND o.msg_id % 5 = 0
    WHERE e.kind = 'recall/system' AND NOT (e.text IS NOT NULL AND e.msg_id % 3 <> 0) GROUP BY e.msg_id) k ON k.msg_id = e.msg_id WHERE e.kind = 'recall/system'"""))
def recall_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat_rows(spark, sf_dir)
    recall = filters.is_recall(F.col("kind"), F.col("type_code"), F.col("msg_code"), F.col("text"))
    cache = rows.select("chat_id", "msg_id", "timestamp", "text", (F.col("text").isNotNull() & (F.col("msg_id") % 3 != 0)).alias("recoverable"))
    found = observe.recall_report(rows, recall, cache, rows.filter("msg_id % 5 <> 0").select("chat_id", "msg_id"), 7200)
    return found.select("msg_id", "recovered_text", F.coalesce(F.array_size("candidates"), F.lit(0)).cast("bigint").alias("candidates"))


@query(over("SELECT DISTINCT target_id FROM (SELECT user_id AS target_id, event_id % 30 AS record_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id, event_id % 30 FROM events WHERE event_type = 'view')"))
def overlapping_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_type") == "click", "before").when(F.col("event_type") == "view", "after").otherwise("target")
    rows = readers.table(spark, sf_dir, "events").select(F.col("user_id").alias("target_id"), side.alias("side"), (F.col("event_id") % 30).alias("record_id"))
    return lookup.overlapping_sides(rows)


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'u_' || user_id WHEN event_id % 3 = 1 THEN user_id::VARCHAR END AS chat FROM events")
def group_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, user = F.col("event_id") % 3, F.col("user_id")
    number = F.when(n == 1, F.when(user == 0, None).otherwise(user)).when(n == 0, 0)
    chat = filters.group_chat_of(number, F.when((n == 0), F.concat(F.lit("u_"), user)).when((n == 1) & (user == 0), "0"))
    return readers.table(spark, sf_dir, "events").select("event_id", chat.alias("chat"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'voice' WHEN o_orderkey % 5 = 1 THEN 'video' WHEN o_orderkey % 5 = 2 THEN 'sticker' WHEN o_orderkey % 5 = 3 THEN 'image' ELSE 'text' END AS category, CASE WHEN o_orderkey % 5 = 0 THEN 'heard' ELSE o_orderpriority END AS shown, CASE WHEN o_orderkey % 5 = 3 THEN 'a' || chr(10) || 'b' ELSE '' END AS image_text, o_orderkey % 2 = 0 AS available FROM orders")
def reader_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).withColumn("o_orderkey", F.col("record_id")).drop("record_id")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") % 5
    some = lambda i: F.when(n == i, F.array(F.lit("x")))
    rows = readers.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("record_id"), F.when(n == 0, "voice").otherwise("other").alias("kind"), F.col("o_orderpriority").alias("text"), F.when(n == 0, "heard").alias("transcript"),
        F.when(n == 3, F.array(*map(F.lit, ("a", " ", "b")))).otherwise(F.array().cast("array<string>")).alias("image_texts"), some(3).alias("images"), some(1).alias("videos"), some(2).alias("stickers"),
        (F.col("o_orderkey") % 2 == 0).alias("available"),
    )
    return normalize.reader_items(rows)


@query("SELECT count(*) AS records, count(*) FILTER (WHERE o_orderkey % 5 <> 4) AS media_records, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS with_files FROM orders")
def reader_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.reader_totals(_items(spark, sf_dir))


@query("SELECT p_partkey, p_partkey % 9000 > 1000 AND p_partkey % 4 <> 0 AS needed FROM part")
def needs_retile(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, good = F.col("p_partkey") % 9000, F.col("p_partkey") % 4 == 0
    result = F.struct(
        F.lit("ok").alias("status"), F.lit("v2").alias("version"), F.lit("native_resolution_tiles").alias("method"), w.alias("width"), F.lit(10).alias("height"),
        F.lit(True).alias("complete"), F.lit(4).alias("done"), F.when(good, 4).otherwise(5).alias("tiles"),
    )
    return readers.table(spark, sf_dir, "part").select("p_partkey", on.needs_retile(w, F.lit(10), result, "v2", 1000).alias("needed"))


@query("SELECT c_custkey, sha256('m1|' || c_name || '|' || c_mktsegment) AS key FROM customer")
def revision_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.table(spark, sf_dir, "customer").select("c_custkey", texts.revision_key(F.lit("m1"), "c_name", "c_mktsegment").alias("key"))


@query("SELECT o_orderkey AS record_id, i AS position, '/images/' || i AS media_ref FROM orders, (SELECT unnest([0, 1, 2]) AS i) WHERE i < o_orderkey % 4")
def image_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = F.slice(F.array(*map(F.lit, "abc")), 1, (F.col("o_orderkey") % 4).cast("int"))
    rows = readers.table(spark, sf_dir, "orders").select(F.lit("w").alias("source"), F.col("o_orderkey").alias("record_id"), images.alias("images"))
    return media.image_references(rows).select("record_id", "position", "media_ref")


@query("SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 4 = 1 THEN 'd' || o_orderkey END AS digest FROM orders WHERE o_orderkey % 3 <> 0")
def refresh_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = readers.table(spark, sf_dir, "orders").select(k.alias("record_id"), F.lit("c").alias("chat_id"), k.alias("server_id"), k.alias("local_id"), F.lit(5).alias("timestamp"))
    found = rows.filter("record_id % 4 = 1").withColumn("digest", F.concat(F.lit("d"), "record_id")).drop("record_id")
    return media.refresh_missing(rows, rows.filter("record_id % 3 = 0"), found).select("record_id", "digest")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'b,a,' || event_type ELSE 'a,' || event_type END AS names FROM events")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("b"), F.lit("a")))
    names = normalize.ordered_distinct(first, F.array(F.lit("a"), F.col("event_type")))
    return readers.table(spark, sf_dir, "events").select("event_id", F.array_join(names, ",").alias("names"))


QUERIES, ORACLE_SQL = query.queries, query.sql
