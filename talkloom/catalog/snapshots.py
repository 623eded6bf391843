"""Snapshots, chunks, enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import DAY, Registry, messages, over, q_messages, w_messages
from talkloom.functions import texts, times
from talkloom.operators import enrich, paging, snapshot
from talkloom.sources import readers

query = Registry()

DOCS = "d AS (SELECT 'd' AS source, doc_id, (n_chars % 400)::VARCHAR AS message_id, source AS chat_id, sha256(text) AS fp, doc_id AS timestamp FROM documents)"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = readers.table(spark, sf_dir, "documents")
    return d.select(F.lit("d").alias("source"), "doc_id", (F.col("n_chars") % 400).cast("string").alias("message_id"), F.col("source").alias("chat_id"), F.sha2("text", 256).alias("fp"), F.col("doc_id").alias("timestamp"))


@query(f"WITH {DOCS} SELECT doc_id, fp FROM (SELECT *, row_number() OVER (PARTITION BY source, fp ORDER BY doc_id) AS r FROM d) WHERE r = 1")
def without_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.without_duplicates(_docs(spark, sf_dir), ["doc_id"]).select("doc_id", "fp")


@query(f"""WITH {DOCS}, u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, fp ORDER BY doc_id) AS r FROM d) WHERE r = 1)
SELECT doc_id, CASE WHEN n > 1 THEN message_id || ':sha256:' || fp ELSE message_id END AS record_id, CASE WHEN n > 1 THEN message_id END AS base_record_id FROM (SELECT *, count(*) OVER (PARTITION BY message_id) AS n FROM u)""")
def resolve_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot.without_duplicates(_docs(spark, sf_dir), ["doc_id"]).withColumnRenamed("message_id", "record_id")
    return snapshot.resolve_collisions(rows).select("doc_id", "record_id", "base_record_id")


@query(f"""WITH {DOCS} SELECT source, count(DISTINCT message_id || fp) AS records, count(*) - count(DISTINCT message_id || fp) AS duplicates, count(DISTINCT message_id || fp) - count(DISTINCT message_id) AS collisions,
  min(timestamp) AS first_time, max(timestamp) AS last_time FROM d GROUP BY source""")
def export_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.export_summary(_docs(spark, sf_dir))


LANES = ", ".join(f"sum(('0x' || substr(fp, {1 + 15 * i}, 15))::BIGINT)" for i in range(4))


@query(f"WITH {DOCS} SELECT chat_id, count(*) AS n, sha256(concat_ws('-', count(*), {LANES})) AS digest FROM d GROUP BY chat_id")
def bucket_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.bucket_digests(_docs(spark, sf_dir), ("chat_id",))


@query(over(f"""SELECT coalesce(a.chat_id, b.chat_id) AS chat_id, coalesce(a.day, b.day) AS day, CASE WHEN a.g IS NULL THEN 'added' WHEN b.g IS NULL THEN 'removed' WHEN a.g = b.g THEN 'same' ELSE 'changed' END AS verdict
  FROM (SELECT chat_id, day, string_agg(record_id, '' ORDER BY record_id) AS g FROM x WHERE seq <> 3 AND day < '2024-01-25' GROUP BY ALL) a FULL JOIN (SELECT chat_id, day, string_agg(record_id, '' ORDER BY record_id) AS g FROM x WHERE day >= '2024-01-04' GROUP BY ALL) b ON a.chat_id = b.chat_id AND a.day = b.day""",
  f"x AS (SELECT *, {DAY.format('timestamp')} AS day FROM q)"))
def compare_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q_messages(spark, sf_dir).withColumn("day", times.local_day(F.col("timestamp"))).withColumn("fp", F.sha2("record_id", 256))
    old, new = rows.filter("seq <> 3 AND day < '2024-01-25'"), rows.filter("day >= '2024-01-04'")
    return snapshot.compare_digests(snapshot.bucket_digests(old), snapshot.bucket_digests(new))


@query(over("""SELECT coalesce(a.record_id, b.record_id) AS record_id, CASE WHEN a.record_id IS NULL THEN 'inserted' WHEN b.record_id IS NULL THEN 'deleted' ELSE 'changed' END AS change
  FROM (SELECT record_id, text FROM q WHERE seq <> 2) a FULL JOIN (SELECT record_id, CASE WHEN seq = 4 THEN text || '!' ELSE text END AS text FROM q WHERE seq <> 3) b ON a.record_id = b.record_id WHERE a.text IS DISTINCT FROM b.text OR a.record_id IS NULL OR b.record_id IS NULL"""))
def compare_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q_messages(spark, sf_dir)
    old = rows.filter("seq <> 2").withColumn("fp", F.sha2("text", 256))
    new = rows.filter("seq <> 3").withColumn("fp", F.sha2(F.when(F.col("seq") == 4, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256))
    return snapshot.compare_snapshots(old, new).select("record_id", "change")


@query(over("SELECT chat_id, count(*) FILTER (WHERE back) AS violations FROM (SELECT chat_id, lag(timestamp) OVER (PARTITION BY chat_id ORDER BY record_id) > timestamp AS back FROM q) GROUP BY chat_id"))
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.order_violations(q_messages(spark, sf_dir), "record_id")


@query(over("SELECT record_id, row_number() OVER (ORDER BY timestamp, source, seq, message_id, record_id) AS position FROM msgs"))
def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.numbered(messages(spark, sf_dir), list(paging.ORDER)).select("record_id", "position")


@query(over("""SELECT chunk_id, n, first_time, last_time, CASE WHEN chunk_id > 1 THEN chunk_id - 1 END AS prev, CASE WHEN chunk_id < max(chunk_id) OVER () THEN chunk_id + 1 END AS next
  FROM (SELECT (p - 1) // 500 + 1 AS chunk_id, count(*) AS n, min(timestamp) AS first_time, max(timestamp) AS last_time FROM (SELECT timestamp, row_number() OVER (ORDER BY timestamp, source, seq, message_id, record_id) AS p FROM msgs) GROUP BY ALL)"""))
def chunk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.chunk_index(snapshot.numbered(messages(spark, sf_dir), list(paging.ORDER)), 500)


@query(over("SELECT source, record_id, timestamp FROM msgs ORDER BY timestamp, source, record_id LIMIT 1000"))
def capped_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.capped_export(messages(spark, sf_dir), 1000, ["timestamp", "source", "record_id"])[0].select("source", "record_id", "timestamp")


@query("SELECT event_id, '{\"b\":' || user_id || ',\"k\":\"' || event_type || '\"}' AS json, sha256('{\"b\":' || user_id || ',\"k\":\"' || event_type || '\"}') AS fp FROM events")
def canonical_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col("event_type").alias("k"), F.col("user_id").alias("b")]
    return readers.table(spark, sf_dir, "events").select("event_id", texts.canonical_json(*parts).alias("json"), texts.fingerprint(*parts).alias("fp"))


@query(over("""SELECT record_id, CASE WHEN seq % 3 = 2 THEN NULL ELSE record_id END AS base, CASE WHEN seq % 3 < 2 THEN sha256(text) END AS digest FROM q WHERE seq % 3 < 2
  UNION ALL SELECT record_id, NULL, NULL FROM q WHERE seq % 3 = 2"""))
def split_record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2("text", 256)
    n = F.col("seq") % 3
    given = F.when(n == 0, texts.extended_id(F.col("record_id"), digest)).when(n == 1, F.concat_ws(":", "record_id", digest)).otherwise(F.concat(F.lit("x"), "record_id"))
    rows = q_messages(spark, sf_dir).select("record_id", texts.split_id(given, F.col("chat_id"), 1).alias("s"))
    return rows.select("record_id", "s.base", "s.digest")


UPDATES = "up AS (SELECT 'd' AS source, doc_id::VARCHAR AS record_id, toxic, quality, doc_id % 7 = 0 AS wrong FROM labels)"


@query(f"""WITH {UPDATES} SELECT d.doc_id::VARCHAR AS record_id, CASE WHEN up.record_id IS NULL THEN 'none' WHEN wrong THEN 'refused' ELSE 'merged' END AS update_status,
  CASE WHEN up.record_id IS NOT NULL AND NOT wrong THEN quality END AS quality, d.lang AS kind FROM documents d LEFT JOIN up ON up.record_id = d.doc_id::VARCHAR""")
def merge_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = readers.table(spark, sf_dir, "documents").select(F.lit("d").alias("source"), F.col("doc_id").cast("string").alias("record_id"), F.col("lang").alias("kind"))
    wrong = F.col("doc_id") % 7 == 0
    updates = readers.table(spark, sf_dir, "labels").select(F.lit("d").alias("source"), F.col("doc_id").cast("string").alias("record_id"), F.when(wrong, "xx").alias("kind"), "quality")
    return enrich.merge_updates(base, updates, ("quality",)).select("record_id", "update_status", "quality", "kind")


@query("""SELECT user_id AS record_id, count(*) AS given, CASE WHEN count(DISTINCT event_type) > 1 THEN 'conflict' ELSE 'ok' END AS status, CASE WHEN count(DISTINCT event_type) = 1 THEN min(event_type) END AS patch
  FROM events GROUP BY user_id""")
def conflicting_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.table(spark, sf_dir, "events").select(F.col("user_id").alias("record_id"), F.col("event_type").alias("patch"))
    return enrich.conflicting_updates(rows, ("record_id",))


@query(over("""SELECT p.patch_id, CASE WHEN NOT p.full THEN 'skipped' WHEN count(w.record_id) = 0 THEN 'not_found' WHEN count(w.record_id) > 1 THEN 'ambiguous' ELSE 'matched' END AS status,
  CASE WHEN p.full AND count(w.record_id) = 1 THEN min(w.record_id) END AS record_id FROM p LEFT JOIN w ON p.full AND w.chat_id = p.chat_id AND w.timestamp = p.timestamp AND w.message_id = p.message_id GROUP BY p.patch_id, p.full""",
  "p AS (SELECT o_orderkey AS patch_id, chat_id, t + CASE WHEN o_orderkey % 5 = 1 THEN 1 ELSE 0 END AS timestamp, CASE WHEN o_orderkey % 5 <> 2 THEN CASE WHEN o_orderkey = 0 THEN '' ELSE lid END END AS message_id, o_orderkey % 5 <> 2 AS full FROM w0)"))
def match_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = w_messages(spark, sf_dir).withColumn("local_id", F.lit(None).cast("string"))
    n = F.col("seq") % 5
    patches = rows.select(F.col("seq").alias("patch_id"), "source", "chat_id", F.when(n != 2, F.col("message_id")).alias("message_id"), "local_id", (F.col("timestamp") + F.when(n == 1, 1).otherwise(0)).alias("timestamp"))
    return enrich.match_identities(patches, rows)


WORK = """ledger AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'v1' ELSE 'v2' END AS version, CASE WHEN doc_id % 5 = 0 THEN 'failed' ELSE 'ok' END AS status FROM documents WHERE doc_id % 4 <> 0)"""


def _work(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = readers.table(spark, sf_dir, "documents").select("doc_id", F.lit("d").alias("source"), F.col("doc_id").cast("string").alias("record_id"), F.lit("ocr").alias("stage"))
    status = F.when(F.col("doc_id") % 5 == 0, "failed").otherwise("ok")
    ledger = d.filter("doc_id % 4 <> 0").withColumn("version", F.when(F.col("doc_id") % 3 == 0, "v1").otherwise("v2")).withColumn("status", status).withColumn("recorded_at", F.lit(2))
    older = d.withColumn("version", F.lit("v2")).withColumn("status", F.lit("ok")).withColumn("recorded_at", F.lit(1)).filter("doc_id % 4 <> 0")
    return d.withColumn("version", F.lit("v2")), ledger.unionByName(older).drop("doc_id")


@query(f"WITH {WORK} SELECT d.doc_id::VARCHAR AS record_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.doc_id = d.doc_id AND version = 'v2' AND status = 'ok')")
def work_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.work_set(*_work(spark, sf_dir), retry_failed=True).select("record_id")


@query(f"WITH {WORK} SELECT 'ocr' AS stage, status, count(*) AS n, CASE WHEN (SELECT count(*) FROM ledger WHERE status = 'failed') > 0 THEN 'complete_with_errors' ELSE 'complete' END AS state FROM ledger GROUP BY status")
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.ledger_summary(enrich.ledger_latest(_work(spark, sf_dir)[1]))


ASSETS = """SELECT user_id % 40 AS digest, array_to_string(list_sort(list(DISTINCT event_id % 500)), ',') AS identities, count(*) AS uses, arg_max('http://h/' || event_id, event_id) FILTER (WHERE event_id % 3 <> 0) AS url
  FROM events WHERE event_id % 500 IN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) GROUP BY ALL"""


@query(ASSETS)
def missing_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = readers.table(spark, sf_dir, "events")
    metadata = e.select((F.col("user_id") % 40).alias("digest"), (F.col("event_id") % 500).alias("identity"), F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("http://h/"), "event_id")).otherwise("ftp://h").alias("url"), F.col("event_id").alias("created"))
    missing = readers.table(spark, sf_dir, "documents").filter("doc_id % 2 = 0").select(F.col("doc_id").alias("identity"))
    return enrich.missing_assets(metadata, missing).withColumn("identities", F.array_join(F.col("identities").cast("array<string>"), ","))


@query("SELECT user_id AS digest FROM (SELECT DISTINCT user_id FROM events) WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def new_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = readers.table(spark, sf_dir, "events").select(F.col("user_id").alias("digest")).distinct()
    return enrich.new_groups(groups, readers.table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("digest")))


@query('SELECT count(*) AS "references", count(DISTINCT user_id) AS digests, count(*) FILTER (WHERE value > 10) AS available_references, count(DISTINCT CASE WHEN value > 10 THEN user_id END) AS available_files FROM events')
def asset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = readers.table(spark, sf_dir, "events")
    return enrich.asset_summary(e.select(F.col("user_id").alias("digest"), (F.col("value") > 10).alias("available")))


@query("SELECT count(*) AS places, count(*) FILTER (WHERE event_id % 100 = 0) AS mismatches FROM events")
def order_agrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.table(spark, sf_dir, "events").select(F.col("event_id").alias("position"), F.col("user_id").alias("identity"))
    other = rows.withColumn("identity", F.when(F.col("position") % 100 == 0, -1).otherwise(F.col("identity")))
    return enrich.order_agrees(rows, other, "identity")


QUERIES, ORACLE_SQL = query.queries, query.sql
