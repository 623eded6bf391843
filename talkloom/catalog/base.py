"""Registration, and the SQL forms of the message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions import texts
from talkloom.operators import combine, normalize
from talkloom.operators.paging import merge_sources
from talkloom.sources import readers


class Registry:
    def __init__(self):
        self.queries, self.sql = {}, {}

    def __call__(self, sql: str | None = None):
        def add(query):
            self.queries[query.__name__] = query
            if sql:
                self.sql[query.__name__] = sql
            return query

        return add


def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded rows of the second source: primary and index merged."""
    merged = combine.merge_primary_index(readers.events_primary(spark, sf_dir), readers.events_index(spark, sf_dir))
    user = F.substring("sender_uid", 3, 20).cast("bigint")
    direction = F.when(user % 4 == 0, "from_me").when(user % 4 == 1, "from_contact").when(user % 4 == 2, "from_member").otherwise("unknown")
    return merged.withColumns({
        "direction": direction, "kind": texts.message_kind(F.col("type_code"), F.col("msg_code")), "sender": F.concat(F.lit("name "), user % 50),
    })


def q_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_flat(flat_rows(spark, sf_dir))


def w_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_nested(readers.orders_nested(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_sources(w_messages(spark, sf_dir), q_messages(spark, sf_dir))


LOCAL = "strftime(make_timestamp(({0} + 28800) * 1000000), '%Y-%m-%d %H:%M:%S') || '+08:00'"
DAY = "strftime(make_timestamp(({0} + 28800) * 1000000), '%Y-%m-%d')"
MONTH = "strftime(make_timestamp(({0} + 28800) * 1000000), '%Y-%m')"

TABLES_SQL = f"""
rm AS (SELECT 'c' || (user_id % 10) AS chat_id, event_id AS msg_id, epoch_us(ts) // 1000000 AS timestamp, event_id % 7 AS seq, 'u_' || user_id AS sender_uid,
  (user_id + 10000)::VARCHAR AS sender_uin, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'error' THEN 4 ELSE 17 END AS type_code,
  CASE WHEN event_id % 2 = 0 THEN 5 ELSE 1 END AS msg_code, value FROM events WHERE event_id % 11 <> 0),
ri AS (SELECT 'c' || (user_id % 10) AS chat_id, event_id AS msg_id, epoch_us(ts) // 1000000 + 5 AS timestamp, event_id % 7 AS seq, 'u_' || user_id AS sender_uid, props AS text
  FROM events WHERE event_id % 3 <> 1 OR event_id % 11 = 0),
merged AS (SELECT coalesce(m.chat_id, i.chat_id) AS chat_id, coalesce(m.msg_id, i.msg_id) AS msg_id, CASE WHEN m.msg_id IS NOT NULL THEN m.timestamp ELSE i.timestamp END AS timestamp,
  coalesce(m.seq, i.seq) AS seq, coalesce(m.sender_uid, i.sender_uid) AS sender_uid, m.sender_uin, m.type_code, m.msg_code, i.text, m.msg_id IS NULL AS fts_only
  FROM rm m FULL JOIN ri i ON m.chat_id = i.chat_id AND m.msg_id = i.msg_id),
flat AS (SELECT *, substr(sender_uid, 3)::BIGINT AS u, CASE coalesce(type_code, -1) WHEN 1 THEN 'text' WHEN 2 THEN 'image' WHEN 3 THEN 'mixed/text-image'
  WHEN 4 THEN CASE WHEN msg_code = 5 THEN 'recall/system' ELSE 'type_4' END WHEN 17 THEN 'reply/quote' ELSE 'type_' || coalesce(type_code, -1) END AS kind FROM merged),
q AS (SELECT 'q' AS source, chat_id, msg_id::VARCHAR AS message_id, chat_id || ':' || msg_id AS record_id, {LOCAL.format('timestamp')} AS time, timestamp, seq,
  sender_uid AS sender_id, 'name ' || (u % 50) AS sender_name, CASE u % 4 WHEN 0 THEN 'outgoing' WHEN 3 THEN 'unknown' ELSE 'incoming' END AS direction,
  'reported' AS identity_status, kind, coalesce(text, '') AS text FROM flat),
w0 AS (SELECT *, 'o' || (o_custkey % 10) AS chat_id, o_orderkey::VARCHAR AS lid, epoch_us(o_orderdate) // 1000000 AS t, CASE WHEN o_orderstatus = 'P' THEN 'system' ELSE o_orderstatus END AS k,
  o_orderkey % 17 = 0 AS bad, CASE WHEN o_custkey % 13 <> 0 THEN 'w' || o_custkey END AS s FROM orders),
w AS (SELECT 'w' AS source, chat_id, CASE WHEN o_orderkey = 0 THEN '' ELSE lid END AS message_id,
  chat_id || ':' || CASE WHEN o_orderkey = 0 THEN '' ELSE lid END || ':' || lid || ':' || t || ':' || k AS record_id,
  {LOCAL.format('t')} AS time, t AS timestamp, o_orderkey AS seq, CASE WHEN NOT bad THEN s END AS sender_id, CASE WHEN bad THEN 'unknown' ELSE 'name ' || (o_custkey % 50) END AS sender_name,
  CASE WHEN bad THEN 'unknown' WHEN s IS NULL AND k = 'system' THEN 'system' WHEN o_custkey % 3 = 0 THEN 'outgoing' WHEN o_custkey % 3 = 1 THEN 'incoming' ELSE 'unknown' END AS direction,
  CASE WHEN bad THEN 'conflict' WHEN s IS NULL THEN 'unknown' ELSE 'reported' END AS identity_status, k AS kind, o_orderpriority AS text FROM w0),
msgs AS (SELECT * FROM w UNION ALL SELECT * FROM q)"""


def over(body: str, more: str = "") -> str:
    """A query over the message tables."""
    return f"WITH {TABLES_SQL}{', ' + more if more else ''} {body}"
