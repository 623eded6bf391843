"""Normalization, filters, joins of the two tables, paging, context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import DAY, Registry, flat_rows, messages, over, q_messages, w_messages
from talkloom.functions import texts, times
from talkloom.functions.times import TimeRange
from talkloom.operators import combine, filters, lookup, normalize, paging
from talkloom.plans import views
from talkloom.sources import readers, sinks

query = Registry()


def _stored(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Events as stored message tables with numeric column names; private ones lack some columns."""
    e, n = readers.table(spark, sf_dir, "events"), F.col("event_id")
    raw = e.select(
        n.alias("40001"), times.epoch_of("ts").alias("40050"), (n % 7).alias("40003"), F.concat(F.lit("u_"), "user_id").alias("40020"), F.col("user_id").alias("40027"),
        (n % 3).cast("int").alias("40012"), F.col("user_id").alias("40033"), F.col("props").alias("41701"), F.col("event_type").alias("41702"),
    )
    return {"group": raw.filter("`40027` % 2 = 0"), "private": raw.filter("`40027` % 2 = 1").drop("40033", "41702")}


STORED = """SELECT event_id AS msg_id, epoch_us(ts) // 1000000 AS create_time, event_id % 7 AS seq, 'u_' || user_id AS sender_uid, user_id AS peer_num, {},
  CASE WHEN user_id % 2 = 0 THEN 'group' ELSE 'private' END AS chat_type FROM events"""


@query(STORED.format("event_id % 3 AS type_code, NULL::BIGINT AS msg_code, CASE WHEN user_id % 2 = 0 THEN user_id::VARCHAR END AS sender_uin"))
def scan_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readers.scan_primary(_stored(spark, sf_dir))
    return found.select("msg_id", "create_time", "seq", "sender_uid", "peer_num", "type_code", "msg_code", "sender_uin", "chat_type")


@query(STORED.format("props AS text, CASE WHEN user_id % 2 = 0 THEN event_type END AS aux_text"))
def scan_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_index(_stored(spark, sf_dir)).select("msg_id", "create_time", "seq", "sender_uid", "peer_num", "text", "aux_text", "chat_type")


@query(over("SELECT chat_id, msg_id, timestamp, seq, sender_uid, sender_uin, type_code, msg_code FROM rm"))
def primary_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.events_primary(spark, sf_dir).drop("value")


@query(over("SELECT chat_id, msg_id, timestamp, seq, sender_uid, text FROM ri"))
def index_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.events_index(spark, sf_dir)


@query(over("SELECT record_id, CASE WHEN seq % 4 = 0 THEN 'as it came ' || seq ELSE text END AS text, direction FROM w"))
def source_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    voice = F.when(F.col("seq") % 4 == 0, F.concat(F.lit("as it came "), "seq"))
    rows = w_messages(spark, sf_dir).withColumns({"original_voice_text": voice, "warnings": F.array(F.lit("derived")), "image_text": F.lit("derived")})
    return normalize.source_facts(rows, ("image_text",)).select("record_id", "text", "direction")


@query(over("""SELECT record_id, CASE WHEN seq % 3 = 0 THEN '[voice] spoken ' || seq ELSE text END AS text, CASE WHEN seq % 3 = 0 THEN text END AS original_voice_text,
  CASE WHEN seq % 3 = 0 THEN 'other' ELSE 'no transcript|other' END AS warnings FROM w"""))
def attach_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = w_messages(spark, sf_dir).withColumn("warnings", F.array(F.lit("no transcript"), F.lit("other")))
    status = F.when(F.col("seq") % 3 == 0, "ok").otherwise("failed")
    heard = rows.filter("seq % 3 < 2").select("record_id", status.alias("status"), F.concat(F.lit("spoken "), "seq").alias("transcript"))
    return normalize.attach_transcripts(rows, heard).select("record_id", "text", "original_voice_text", F.array_join("warnings", "|").alias("warnings"))


@query(over("""SELECT source, record_id FROM (SELECT *, row_number() OVER (ORDER BY timestamp DESC, source DESC, seq DESC, message_id DESC, record_id DESC) AS r FROM msgs
  WHERE timestamp < 1704816000) WHERE r > 50 AND r <= 100"""))
def merged_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of all sources as of a fixed time, by the cursor of the first."""
    rows = messages(spark, sf_dir).filter(TimeRange().clipped(1704816000).holds(F.col("timestamp")))
    scope = {"descending": True, "snapshot": 1704816000, "chats": "all"}
    first = paging.keyset_page(rows, 50, **scope)
    return paging.keyset_page(rows, 50, first.next_cursor, **scope).rows.select("source", "record_id")


@query(r"""SELECT page_id, nullif(regexp_extract(t, '<a\b[^>]*?\shref\s*=\s*["'']([^"'']*)["'']', 1), '') AS href, nullif(regexp_extract(t, '<html\b[^>]*?\slang\s*=\s*["'']([^"'']*)["'']', 1), '') AS lang
  FROM (SELECT page_id, CASE WHEN length(html) <= 2000000 AND NOT regexp_matches(upper(html), '<!(DOCTYPE|ENTITY)') THEN html END AS t
    FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN html ELSE regexp_replace(html, '^<!DOCTYPE html>', '') END AS html FROM pages))""")
def node_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a link and of the page; every other page comes without its document type, which is refused."""
    pages = readers.table(spark, sf_dir, "pages")
    html = F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(F.regexp_replace("html", "^<!DOCTYPE html>", ""))
    return pages.select(
        "page_id", texts.node_attributes(html, "a", ["href"])["href"].alias("href"), texts.node_attributes(html, "html", ["lang"])["lang"].alias("lang")
    )


@query("SELECT c_custkey::VARCHAR AS uid, NULL::VARCHAR AS uin, c_name AS nick, c_mktsegment AS remark FROM customer")
def scan_optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"uid": ("c_custkey", "string"), "uin": ("absent", "string"), "nick": ("c_name", "string"), "remark": ("c_mktsegment", "string")}
    return normalize.select_or_null(readers.table(spark, sf_dir, "customer"), wanted)


@query(over("SELECT * FROM w"))
def normalize_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w_messages(spark, sf_dir)


@query(over("SELECT * FROM q"))
def normalize_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_messages(spark, sf_dir)


CONVERSATIONS = """SELECT 'c' AS source, conv_id::VARCHAR AS chat_id, turn::VARCHAR AS message_id, conv_id || ':' || turn AS record_id, turn AS seq,
  CASE role WHEN 'user' THEN 'outgoing' WHEN 'assistant' THEN 'incoming' ELSE 'system' END AS direction, length(text) AS chars FROM conversations"""


@query(CONVERSATIONS)
def normalize_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = readers.table(spark, sf_dir, "conversations")
    direction = F.when(F.col("role") == "user", "outgoing").when(F.col("role") == "assistant", "incoming").otherwise("system")
    return c.select(
        F.lit("c").alias("source"), F.col("conv_id").cast("string").alias("chat_id"), F.col("turn").cast("string").alias("message_id"),
        F.concat_ws(":", "conv_id", "turn").alias("record_id"), F.col("turn").alias("seq"), direction.alias("direction"), F.length("text").cast("bigint").alias("chars"),
    )


@query(over("SELECT chat_id, msg_id, timestamp, seq, sender_uid, sender_uin, text, fts_only FROM merged"))
def merge_primary_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = combine.merge_primary_index(readers.events_primary(spark, sf_dir), readers.events_index(spark, sf_dir))
    return merged.select("chat_id", "msg_id", "timestamp", "seq", "sender_uid", "sender_uin", "text", "fts_only")


@query(over("SELECT chat_id, msg_id, timestamp, text, fts_only FROM merged WHERE timestamp >= 1704556800 AND timestamp < 1704643200"))
def merge_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = combine.merge_in_range(readers.events_primary(spark, sf_dir), readers.events_index(spark, sf_dir), TimeRange.of(date="2024-01-07"))
    return merged.select("chat_id", "msg_id", "timestamp", "text", "fts_only")


@query(over("SELECT ri.* FROM ri WHERE NOT EXISTS (SELECT 1 FROM rm WHERE rm.chat_id = ri.chat_id AND rm.msg_id = ri.msg_id)"))
def index_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.index_orphans(readers.events_primary(spark, sf_dir), readers.events_index(spark, sf_dir))


@query(over("SELECT kind, count(*) AS n FROM flat GROUP BY kind"))
def message_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_rows(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"))


@query(over("""SELECT msg_id, CASE WHEN msg_id % 4 <> 0 THEN kind WHEN kind <> 'text' AND text IS NULL THEN 'image' ELSE 'mixed/text-image' END AS kind FROM flat"""))
def refined_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = F.when(F.col("msg_id") % 4 == 0, F.array(F.lit("a.png"))).otherwise(F.array().cast("array<string>"))
    return flat_rows(spark, sf_dir).select("msg_id", texts.refined_kind(F.col("kind"), F.col("text"), images).alias("kind"))


@query(over("""SELECT msg_id, CASE WHEN t1 IS NOT NULL THEN t1 WHEN msg_id % 5 = 0 THEN 'aux ' || msg_id WHEN msg_id % 5 = 1 THEN 'payload' ELSE '' END AS text,
  CASE WHEN t1 IS NOT NULL THEN 'fts' WHEN msg_id % 5 = 0 THEN 'fts_aux' WHEN msg_id % 5 = 1 THEN 'payload.45101' END AS text_source
  FROM (SELECT msg_id, text AS t1 FROM flat)"""))
def text_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("msg_id") % 5
    aux, payload = F.when(n == 0, F.concat(F.lit(" aux\t"), "msg_id")), F.when(n == 1, "payload")
    text, source = normalize.resolved_text(F.col("text"), aux, payload, F.lit(None).cast("string"))
    return flat_rows(spark, sf_dir).select("msg_id", text.alias("text"), source.alias("text_source"))


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(html, '[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f]+', ' ', 'g'), '[\\t\\n\\x0b\\f\\r ]+', ' ', 'g')) AS text FROM pages""")
def compact_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.table(spark, sf_dir, "pages").select("page_id", texts.compact_text(F.col("html")).alias("text"))


@query(over("SELECT source, count(*) AS n, min(timestamp) AS a, max(timestamp) AS b FROM msgs WHERE timestamp >= 820425600 AND timestamp < 1704816000 GROUP BY source"))
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = TimeRange.of("1996-01-01", "2024-01-09")
    rows = messages(spark, sf_dir).filter(scope.holds(F.col("timestamp")))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))


@query(over(f"SELECT source, record_id, {DAY.format('timestamp')} AS day FROM msgs WHERE timestamp >= 1704556800 AND timestamp < 1704643200"))
def single_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir).filter(TimeRange.of(date="2024-01-07").holds(F.col("timestamp")))
    return rows.select("source", "record_id", times.local_day(F.col("timestamp")).alias("day"))


@query("""SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 + CASE WHEN o_orderkey % 4 = 0 THEN -28800 WHEN o_orderkey % 4 = 1 THEN 3600 - 28800 WHEN o_orderkey % 4 = 2 THEN 0 END AS bound FROM orders""")
def bounds_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    n = F.col("o_orderkey") % 4
    text = F.when(n == 0, day).when(n == 1, F.concat(day, F.lit(" 01:00"))).when(n == 2, F.concat(day, F.lit("T00:00:00Z"))).otherwise(F.lit("20240101"))
    return readers.table(spark, sf_dir, "orders").select("o_orderkey", times.parse_bounds(text).alias("bound"))


@query(over("SELECT source, record_id FROM msgs WHERE contains(lower(concat_ws(chr(10), text, kind)), '\"k\": 7')"))
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).filter(filters.has_keyword('"K": 7', "text", "kind")).select("source", "record_id")


@query(over("""SELECT 1 AS selector_id, msg_id FROM flat WHERE sender_uid = 'u_7' UNION ALL SELECT 2, msg_id FROM flat WHERE sender_uin = '10009'
  UNION ALL SELECT 3, msg_id FROM flat WHERE u % 4 = 3 UNION ALL SELECT 4, msg_id FROM flat WHERE 'name ' || (u % 50) = 'name 3'"""))
def sender_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = [filters.sender_selector(s) for s in ("u_7", "10009", "unknown", "name: name 3")]
    names = {"sender_uid": "uid", "sender_uin": "uin", "sender_name": "name", "direction": "direction"}
    rows = spark.createDataFrame([(i, names[c], v) for i, (c, v) in enumerate(parsed, 1)], "selector_id int, namespace string, value string")
    return filters.select_senders(flat_rows(spark, sf_dir).withColumnRenamed("sender", "sender_name"), rows).select("selector_id", "msg_id")


@query(over("""SELECT chat_id, count(*) AS n, count(*) FILTER (WHERE r) AS recalls, count(*) FILTER (WHERE NOT r AND text IS NOT NULL) AS recoverable
  FROM (SELECT *, coalesce(type_code = 4 AND msg_code = 5, false) AS r FROM flat) GROUP BY chat_id"""))
def recall_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    recall = filters.is_recall(F.col("kind"), F.col("type_code"), F.col("msg_code"), F.col("text"))
    rows = flat_rows(spark, sf_dir).withColumn("r", recall).withColumn("ok", filters.is_recoverable(F.col("r"), F.col("text")))
    return rows.groupBy("chat_id").agg(F.count("*").alias("n"), F.count_if("r").alias("recalls"), F.count_if("ok").alias("recoverable"))


@query("""SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN CASE WHEN user_id = 7 THEN CASE WHEN event_id % 5 = 0 THEN 'u_7' END ELSE 'u_' || user_id END
  ELSE 'u_' || (event_id % 5 + 100) END AS chat FROM events""")
def private_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 5
    peer = F.when(n == 0, "u_7").when(n == 1, "").otherwise(F.concat(F.lit("u_"), n + 100))
    sender = F.concat(F.lit("u_"), "user_id")
    return readers.table(spark, sf_dir, "events").select("event_id", filters.private_chat_of(peer, sender, "u_7").alias("chat"))


@query(over("""SELECT source, chat_id, message_id, record_id, timestamp, direction, kind, text FROM msgs
  ORDER BY timestamp DESC, source DESC, seq DESC, message_id DESC, record_id DESC LIMIT 100"""))
def timeline_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = paging.merged_timeline([w_messages(spark, sf_dir), q_messages(spark, sf_dir)], TimeRange(), 100)
    return page.select("source", "chat_id", "message_id", "record_id", "timestamp", "direction", "kind", "text")


@query(over("""SELECT source, record_id, timestamp FROM msgs WHERE timestamp < 1704672000 AND (timestamp, source, seq, message_id, record_id) > (820454400, 'w', 100, '', '')
  ORDER BY timestamp, source, seq, message_id, record_id LIMIT 250"""))
def timeline_after_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [w_messages(spark, sf_dir), q_messages(spark, sf_dir)]
    page = paging.merged_timeline(sources, TimeRange(), 250, 1704672000, [820454400, "w", 100, "", ""], descending=False)
    return page.select("source", "record_id", "timestamp")


@query(over("""SELECT record_id, total, CASE WHEN total > 65 THEN 65 END AS next_offset FROM (SELECT record_id, count(*) OVER () AS total, timestamp, seq FROM q
  ORDER BY timestamp DESC, seq DESC, record_id DESC LIMIT 40 OFFSET 25)"""))
def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = paging.offset_page(q_messages(spark, sf_dir), 40, 25, ("timestamp", "seq", "record_id"), descending=True)
    return page.rows.select("record_id", F.lit(page.total).cast("bigint").alias("total"), F.lit(page.next_offset).cast("int").alias("next_offset"))


TARGETS = "targets AS (SELECT event_id AS target_id, 'c' || (user_id % 10) AS chat_id, 'c' || (user_id % 10) || ':' || event_id AS record_id FROM events WHERE event_type = 'purchase')"
PLACED = "placed AS (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY timestamp, seq, record_id) AS p FROM q)"


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = readers.table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    chat = F.concat(F.lit("c"), F.col("user_id") % 10)
    return e.select(F.col("event_id").alias("target_id"), chat.alias("chat_id"), F.concat_ws(":", chat, "event_id").alias("record_id"))


@query(over("""SELECT target_id, count(q.record_id) AS matches, CASE WHEN count(q.record_id) = 0 THEN 'not_found' WHEN count(q.record_id) = 1 THEN 'ok' ELSE 'ambiguous' END AS status
  FROM targets t LEFT JOIN q ON q.chat_id = t.chat_id AND q.record_id = t.record_id GROUP BY target_id""", TARGETS))
def locate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.locate(q_messages(spark, sf_dir), _targets(spark, sf_dir)).select("target_id", "matches", "status")


@query(over("""SELECT t.target_id, CASE WHEN n.p < m.p THEN 'before' WHEN n.p > m.p THEN 'after' ELSE 'target' END AS side, n.p - m.p AS steps, n.record_id, n.timestamp
  FROM targets t JOIN placed m ON m.chat_id = t.chat_id AND m.record_id = t.record_id JOIN placed n ON n.chat_id = m.chat_id AND n.p BETWEEN m.p - 2 AND m.p + 3""", f"{TARGETS}, {PLACED}"))
def message_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.context(q_messages(spark, sf_dir), _targets(spark, sf_dir), 2, 3).drop("text")


@query(over("SELECT chat_id, record_id, CASE WHEN seq % 7 = 3 THEN 'changed' WHEN seq % 7 = 5 THEN 'missing' ELSE 'same' END AS verdict FROM q"))
def same_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = q_messages(spark, sf_dir)
    new = old.filter("seq % 7 <> 5").withColumn("text", F.when(F.col("seq") % 7 == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return lookup.same_facts(old, new)


@query(over("SELECT record_id, t AS second FROM (SELECT record_id, timestamp AS t FROM w)"))
def second_of_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w_messages(spark, sf_dir).select("record_id", lookup.second_of(F.col("record_id")).alias("second"))


HEAD = f"""SELECT record_id, CASE WHEN d IS DISTINCT FROM lag(d) OVER (PARTITION BY chat_id ORDER BY timestamp, seq, record_id) THEN '## ' || d || chr(10) || chr(10) || l ELSE l END AS line
  FROM (SELECT *, {DAY.format('timestamp')} AS d, substr(time, 12, 8) || ' ' || sender_name || ': ' || CASE WHEN trim(text) = '' THEN '[' || kind || ']' ELSE trim(text) END AS l FROM q)"""


@query(over(HEAD))
def markdown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.markdown_lines(q_messages(spark, sf_dir)).select("record_id", "line")


@query(over("""SELECT chat_id, messages, record_id AS last_record, timestamp AS last_time, (SELECT count(*) FROM q u WHERE u.chat_id = x.chat_id AND u.timestamp > 1704844800) AS unread
  FROM (SELECT *, count(*) OVER (PARTITION BY chat_id) AS messages, row_number() OVER (PARTITION BY chat_id ORDER BY timestamp DESC, seq DESC, record_id DESC) AS r FROM q) x WHERE r = 1"""))
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q_messages(spark, sf_dir)
    marks = rows.select("chat_id", F.lit(1704844800).alias("read_until")).distinct()
    return views.sessions(rows, marks).drop("last_text")


@query("""SELECT event_id, user_id FROM events WHERE user_id IN (3, 4, 5) AND contains(lower(props), '"k": 1') AND epoch_us(ts) // 1000000 >= 1704412800 AND value > 10""")
def feed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = readers.table(spark, sf_dir, "events").select("event_id", "user_id", F.col("props").alias("text"), times.epoch_of("ts").alias("timestamp"), (F.col("value") <= 10).alias("is_read"))
    return views.filtered_feed(feed, (3, 4, 5), '"k": 1', TimeRange.of("2024-01-05 08:00"), unread_only=True).select("event_id", "user_id")


@query(over("SELECT q.record_id, d.value FROM q LEFT JOIN (SELECT chat_id || ':' || msg_id AS record_id, value FROM rm) d ON d.record_id = q.record_id WHERE q.kind = 'reply/quote'"))
def messages_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = readers.events_primary(spark, sf_dir).select(F.concat_ws(":", "chat_id", "msg_id").alias("record_id"), "value")
    return views.of_kind(q_messages(spark, sf_dir), details, ("reply/quote",)).select("record_id", "value")


@query("SELECT user_id AS target_chat, max(epoch_us(ts) // 1000000) AS last_forward, count(*) AS forwards FROM events WHERE event_type = 'view' GROUP BY user_id")
def forward_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.table(spark, sf_dir, "events").filter("event_type = 'view'")
    return views.forward_history(rows.select(F.col("user_id").alias("target_chat"), times.epoch_of("ts").alias("timestamp")))


@query("SELECT c_mktsegment AS contact_type, count(*) AS n FROM customer GROUP BY ALL")
def contact_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.contact_stats(readers.table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "contact_type"))


QUERIES, ORACLE_SQL = query.queries, query.sql
