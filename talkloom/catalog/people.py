"""Identities, statistics, observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import DAY, MONTH, Registry, flat_rows, messages, over, q_messages
from talkloom.functions import texts
from talkloom.operators import combine, coverage, filters, identity, observe, stats
from talkloom.plans import views
from talkloom.sources import readers

query = Registry()

PEOPLE = "people AS (SELECT 'u_' || c_custkey AS uid, (c_custkey + 10000)::VARCHAR AS uin, c_name AS nick, c_mktsegment AS remark FROM customer)"


@query(f"""WITH {PEOPLE}, asked AS (SELECT DISTINCT CASE event_id % 4 WHEN 0 THEN 'u_' || user_id WHEN 1 THEN (user_id + 10000)::VARCHAR
  WHEN 2 THEN 'name:Customer#' || lpad(user_id::VARCHAR, 9, '0') ELSE 'BUILDING' END AS query FROM events),
 hits AS (SELECT query, uid, uin FROM asked a JOIN people p ON CASE WHEN query LIKE 'name:%' THEN p.nick = substr(query, 6) OR p.remark = substr(query, 6)
   WHEN query LIKE 'u\\_%' ESCAPE '\\' THEN p.uid = query WHEN regexp_matches(query, '^[0-9]+$') THEN p.uin = query ELSE p.nick = query OR p.remark = query END)
SELECT a.query, CASE WHEN count(uid) = 0 THEN 'not_found' WHEN count(uid) > 1 THEN 'ambiguous' ELSE 'resolved' END AS status,
  CASE WHEN count(uid) = 1 THEN min(uid) END AS uid, CASE WHEN count(uid) = 1 THEN min(uin) END AS uin FROM asked a LEFT JOIN hits h ON h.query = a.query GROUP BY a.query""")
def resolve_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 4
    text = (
        F.when(n == 0, F.concat(F.lit("u_"), "user_id")).when(n == 1, (F.col("user_id") + 10000).cast("string"))
        .when(n == 2, F.concat(F.lit("name:Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))).otherwise("BUILDING")
    )
    asked = readers.table(spark, sf_dir, "events").select(text.alias("query")).distinct()
    return identity.resolve_contacts(asked, readers.contacts(spark, sf_dir))


@query(f"""WITH {PEOPLE}, asked AS (SELECT 'u_' || c_custkey AS query FROM customer UNION SELECT n_name FROM nation UNION SELECT r_name FROM region UNION SELECT 'nobody')
SELECT query, CASE WHEN uid IS NOT NULL THEN 'private' WHEN n_name IS NOT NULL THEN 'group' WHEN r_name IS NOT NULL THEN 'discuss' END AS chat_type,
  coalesce(uid, n_nationkey::VARCHAR, r_regionkey::VARCHAR) AS canonical_id FROM asked LEFT JOIN people ON uid = query LEFT JOIN nation ON n_name = query LEFT JOIN region ON r_name = query""")
def resolve_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = readers.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    discussions = readers.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    people = readers.contacts(spark, sf_dir)
    asked = people.select(F.col("uid").alias("query")).union(groups.select("name")).union(discussions.select("name")).union(spark.createDataFrame([("nobody",)], "query string"))
    return identity.resolve_chats(asked, people, groups, discussions)


SENDERS = """SELECT event_id, CASE WHEN clash THEN 'unknown' WHEN user_id = 0 THEN 'from_me' ELSE 'from_member' END AS direction, CASE WHEN clash THEN 1 ELSE 0 END AS warnings,
  CASE WHEN clash THEN 'u_' || user_id WHEN user_id = 0 THEN 'me' ELSE coalesce(c_name, 'u_' || user_id) END AS sender
  FROM (SELECT event_id, user_id, c_name, CASE WHEN event_id % 6 = 0 THEN user_id = 0 OR (c_custkey IS NOT NULL) OR EXISTS (SELECT 1 FROM customer x WHERE x.c_custkey = user_id + 10 AND x.c_custkey % 10 = user_id % 10) ELSE false END AS clash
  FROM events LEFT JOIN customer ON c_custkey = user_id)"""


@query(SENDERS)
def sender_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth row carries another member's number beside the sender's uid."""
    people = readers.contacts(spark, sf_dir)
    rows = readers.table(spark, sf_dir, "events").select(
        "event_id", F.lit("group").alias("chat_type"), F.concat(F.lit("c"), F.col("user_id") % 10).alias("chat_id"), F.concat(F.lit("u_"), "user_id").alias("sender_uid"),
        (F.col("user_id") + 10000 + F.when(F.col("event_id") % 6 == 0, 10).otherwise(0)).cast("string").alias("sender_uin"),
    )
    members = people.select("chat_id", "uid", "uin", F.col("nick").alias("name"))
    nobody = members.filter("false")
    found = identity.sender_verdicts(rows, nobody, members, "u_0", "10000")
    return found.select("event_id", "direction", F.size("warnings").alias("warnings"), "sender")


@query("SELECT requested, CASE WHEN requested LIKE 'uin%' THEN 'u_' || substr(requested, 4) ELSE CASE WHEN requested LIKE 'u\\_%' ESCAPE '\\' THEN requested END END AS canonical_id FROM (SELECT DISTINCT CASE user_id % 3 WHEN 0 THEN 'uin' || user_id WHEN 1 THEN 'u_' || user_id ELSE 'other' || user_id END AS requested FROM events)")
def canonical_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("user_id") % 3
    asked = readers.table(spark, sf_dir, "events").select(F.when(n == 0, F.concat(F.lit("uin"), "user_id")).when(n == 1, F.concat(F.lit("u_"), "user_id")).otherwise(F.concat(F.lit("other"), "user_id")).alias("requested")).distinct()
    chats = readers.table(spark, sf_dir, "customer").select(F.concat(F.lit("u_"), "c_custkey").alias("canonical_id"), F.array(F.concat(F.lit("uin"), "c_custkey")).alias("aliases"))
    return identity.canonical_chats(asked, chats)


@query("""WITH q AS (SELECT unnest(['BUILDING', 'Customer#000000012', '1', '_']) AS query), c AS (SELECT 'u_' || c_custkey AS uid, c_mktsegment AS remark, c_name AS nick, (c_custkey + 10000)::VARCHAR AS uin FROM customer),
 s AS (SELECT query, uid, remark AS display_name, CASE WHEN query IN (remark, nick, uin, uid) THEN 0 WHEN contains(remark, query) OR contains(nick, query) THEN 1 WHEN contains(uin, query) OR contains(uid, query) THEN 2 END AS score FROM q, c)
SELECT query, uid AS id, score, display_name, rank, total <= 20 AS complete FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score, display_name, uid) AS rank, count(*) OVER (PARTITION BY query) AS total FROM s WHERE score IS NOT NULL) WHERE rank <= 20""")
def discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.createDataFrame([("BUILDING",), ("Customer#000000012",), ("1",), ("_",)], "query string")
    return identity.discover(asked, readers.contacts(spark, sf_dir), 20).select("query", "id", "score", "display_name", "rank", "complete")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey::VARCHAR END AS message_id, o_orderkey <> 0 AND o_orderkey % 5 = 0 AS conflict FROM orders""")
def merged_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    value, conflict = identity.merged_identity("message_id", key, F.concat(F.lit("00"), key), F.when(key % 5 == 0, key + 1 - F.when(key == 0, 1).otherwise(0)))
    return readers.table(spark, sf_dir, "orders").select("o_orderkey", value.alias("message_id"), conflict.alias("conflict"))


@query(over("""SELECT chat_id, count(*) AS total, count(*) FILTER (WHERE text <> '') AS with_text, count(*) FILTER (WHERE text = '') AS without_text, min(timestamp) AS first_time, max(timestamp) AS last_time,
  count(*) FILTER (WHERE sender_id IS NULL) AS unknown_senders, count(*) FILTER (WHERE identity_status = 'conflict') AS unresolved FROM msgs GROUP BY chat_id"""))
def chat_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.chat_summary(messages(spark, sf_dir))


@query(over(f"""SELECT chat_id, 'sender' AS dimension, coalesce(sender_id, 'unknown') AS value, count(*) AS n FROM msgs GROUP BY ALL UNION ALL SELECT chat_id, 'kind', kind, count(*) FROM msgs GROUP BY ALL
  UNION ALL SELECT chat_id, 'month', {MONTH.format('timestamp')}, count(*) FROM msgs GROUP BY ALL UNION ALL SELECT chat_id, 'all', '', count(*) FROM msgs GROUP BY ALL"""))
def chat_breakdowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.chat_breakdowns(messages(spark, sf_dir))


@query(over("SELECT chat_id, CASE WHEN identity_status = 'unresolved' THEN 'unknown' WHEN sender_uid IS NOT NULL THEN 'uid:' || sender_uid ELSE 'unknown' END AS sender, count(*) AS n FROM (SELECT *, CASE WHEN msg_id % 9 = 0 THEN 'unresolved' ELSE 'reported' END AS identity_status FROM flat) GROUP BY ALL"))
def sender_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("msg_id") % 9 == 0, "unresolved").otherwise("reported")
    rows = flat_rows(spark, sf_dir).select("chat_id", stats.sender_key(status, F.col("sender_uid"), F.col("sender_uin")).alias("sender"))
    return rows.groupBy("chat_id", "sender").agg(F.count("*").alias("n"))


@query(over("""SELECT chat_id, sender_id, n, latest_name, names, row_number() OVER (PARTITION BY chat_id ORDER BY n DESC, t, s, r) AS rank FROM (
  SELECT chat_id, sender_id, count(*) AS n, arg_max(sender_name, (timestamp, seq, record_id)) AS latest_name, coalesce(array_to_string(list_sort(list(DISTINCT sender_name) FILTER (sender_id IS NOT NULL)), '|'), '') AS names,
  min((timestamp, seq, record_id)).timestamp AS t, min((timestamp, seq, record_id)).seq AS s, min((timestamp, seq, record_id)).record_id AS r FROM (SELECT chat_id, sender_id, sender_name, timestamp, seq, record_id FROM msgs) GROUP BY ALL)""".replace("min((timestamp, seq, record_id))", "min(struct_pack(timestamp := timestamp, seq := seq, record_id := record_id))")))
def group_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sender_stats(messages(spark, sf_dir)).withColumn("names", F.array_join("names", "|"))


@query(over("SELECT chat_id, sender_id, sender_name, count(*) AS n, min(timestamp) AS first_time, max(timestamp) AS last_time FROM msgs WHERE sender_name <> '' GROUP BY ALL"))
def sender_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sender_names(messages(spark, sf_dir))


@query(over(f"SELECT chat_id, {DAY.format('timestamp')} AS day, count(*) AS n, count(*) FILTER (WHERE kind = 'system') AS system FROM msgs GROUP BY ALL"))
def group_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.day_stats(messages(spark, sf_dir))


@query(over("SELECT chat_id, count(*) AS total, least(count(*), 300) AS scanned, CASE WHEN count(*) > 300 THEN 'partial' ELSE 'ok' END AS status FROM msgs GROUP BY chat_id"))
def scan_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.bounded_scan(messages(spark, sf_dir), 300)[1]


@query(over("SELECT chat_id, kind, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY timestamp, seq, record_id) AS r FROM msgs) WHERE r <= 300 GROUP BY ALL"))
def bounded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.bounded_scan(messages(spark, sf_dir), 300)[0].groupBy("chat_id", "kind").agg(F.count("*").alias("n"))


@query(over(f"SELECT {MONTH.format('timestamp')} AS month, sender_name, kind, count(*) AS n FROM msgs GROUP BY ALL"))
def legacy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.legacy_summary(messages(spark, sf_dir))


@query(over(f"SELECT p.uid, 'c' || (substr(p.uid, 3)::BIGINT % 10) AS chat_id, p.nick AS name, count(q.record_id) AS n FROM people p LEFT JOIN q ON q.sender_id = p.uid GROUP BY ALL", PEOPLE))
def member_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = readers.contacts(spark, sf_dir).select("chat_id", "uid", F.col("nick").alias("name"))
    return stats.member_stats(members, q_messages(spark, sf_dir))


# Three rounds of observation; errors have lost their content.
LOG = """log AS (SELECT 'c' || (user_id % 10) AS chat_id, event_id AS msg_id, round * 1000 + event_id % 7 AS observed_at, NOT (event_type = 'error' AND round > 0) AND props IS NOT NULL AND event_id % 8 <> 0 AS recoverable,
  CASE WHEN event_type = 'error' AND round > 0 THEN '' ELSE props || round // 2 END AS text, event_type AS kind FROM events, (SELECT unnest([0, 1, 2]) AS round) WHERE event_id % (round + 2) <> 0)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("round")
    e = readers.table(spark, sf_dir, "events").select("*", rounds).filter(F.col("event_id") % (F.col("round") + 2) != 0)
    lost = (F.col("event_type") == "error") & (F.col("round") > 0)
    return e.select(
        F.concat(F.lit("c"), F.col("user_id") % 10).alias("chat_id"), F.col("event_id").alias("msg_id"), (F.col("round") * 1000 + F.col("event_id") % 7).alias("observed_at"),
        (~lost & F.col("props").isNotNull() & (F.col("event_id") % 8 != 0)).alias("recoverable"),
        F.when(lost, "").otherwise(F.concat("props", F.floor(F.col("round") / 2))).alias("text"), F.col("event_type").alias("kind"),
    )


@query(f"""WITH {LOG} SELECT chat_id, msg_id, first_seen, last_seen, seen_count, recoverable, text, kind FROM (SELECT *, min(observed_at) OVER p AS first_seen, max(observed_at) OVER p AS last_seen, count(*) OVER p AS seen_count,
  row_number() OVER (PARTITION BY chat_id, msg_id ORDER BY recoverable DESC, observed_at DESC) AS r FROM log WINDOW p AS (PARTITION BY chat_id, msg_id)) WHERE r = 1""")
def observation_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.fold_observations(_log(spark, sf_dir))


@query(f"""WITH {LOG}, steps AS (SELECT *, row_number() OVER w AS n, coalesce(bool_or(recoverable) OVER e, false) AND NOT recoverable AS held,
  max(struct_pack(r := recoverable, o := observed_at, t := text, k := kind)) OVER e AS prior FROM log WINDOW w AS (PARTITION BY chat_id, msg_id ORDER BY observed_at), e AS (PARTITION BY chat_id, msg_id ORDER BY observed_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT chat_id, count(*) FILTER (WHERE n = 1) AS added, count(*) FILTER (WHERE n > 1 AND NOT held AND (prior.t <> text OR prior.k <> kind)) AS updated, count(*) FILTER (WHERE n > 1 AND held) AS preserved FROM steps GROUP BY chat_id""")
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.upsert_counts(_log(spark, sf_dir))


def _recall(rows: DataFrame) -> DataFrame:
    return rows.withColumn("recall", filters.is_recall(F.col("kind"), F.col("type_code"), F.col("msg_code"), F.col("text")))


@query(over("""SELECT msg_id, array_to_string(b, ',') AS preceding, array_to_string(a, ',') AS following FROM (SELECT msg_id, kind, list(msg_id) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS b,
  list(msg_id) OVER (w ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS a FROM flat WINDOW w AS (PARTITION BY chat_id ORDER BY timestamp, seq, msg_id)) WHERE kind = 'recall/system'""".replace("array_to_string(b, ',')", "coalesce(array_to_string(b, ','), '')").replace("array_to_string(a, ',')", "coalesce(array_to_string(a, ','), '')")))
def recall_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _recall(flat_rows(spark, sf_dir))
    found = observe.recall_context(rows.drop("recall"), filters.is_recall(F.col("kind"), F.col("type_code"), F.col("msg_code"), F.col("text")))
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return found.select("msg_id", join("preceding"), join("following"))


CACHE = """cache AS (SELECT chat_id, msg_id, timestamp, text, text IS NOT NULL AND kind <> 'recall/system' AND msg_id % 4 <> 0 AS recoverable FROM flat),
 ev AS (SELECT chat_id, msg_id, timestamp FROM flat WHERE kind = 'recall/system'), live AS (SELECT chat_id, msg_id FROM flat WHERE msg_id % 5 <> 0)"""


@query(over("""SELECT * FROM (SELECT e.chat_id, e.msg_id AS event_id, row_number() OVER (PARTITION BY e.chat_id, e.msg_id ORDER BY e.timestamp - c.timestamp, c.msg_id) AS rank, c.msg_id, e.timestamp - c.timestamp AS seconds
  FROM ev e JOIN cache c ON c.chat_id = e.chat_id AND e.timestamp - c.timestamp BETWEEN 0 AND 86400 AND c.recoverable ANTI JOIN live l ON l.chat_id = c.chat_id AND l.msg_id = c.msg_id) WHERE rank <= 5""".replace(
    "AND c.recoverable ANTI JOIN live l ON l.chat_id = c.chat_id AND l.msg_id = c.msg_id)", "AND c.recoverable WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.chat_id = c.chat_id AND l.msg_id = c.msg_id))"), CACHE))
def recall_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _recall(flat_rows(spark, sf_dir))
    cache = rows.select("chat_id", "msg_id", "timestamp", "text", (filters.is_recoverable(F.col("recall"), F.col("text")) & (F.col("msg_id") % 4 != 0)).alias("recoverable"))
    return observe.recall_candidates(rows.filter("recall").select("chat_id", "msg_id", "timestamp"), cache, rows.filter("msg_id % 5 <> 0").select("chat_id", "msg_id"), 86400)


@query(over("SELECT chat_id, msg_id FROM rm UNION SELECT chat_id, msg_id FROM ri"))
def live_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine.live_ids(readers.events_primary(spark, sf_dir), readers.events_index(spark, sf_dir))


@query(over("SELECT chat_id, msg_id FROM (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY timestamp DESC, seq DESC, msg_id DESC) AS r FROM flat) WHERE r <= 50"))
def latest_of_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.latest_of(flat_rows(spark, sf_dir), 50).select("chat_id", "msg_id")


@query(over("SELECT chat_id, count(*) AS scanned, true AS source_complete, count(*) FILTER (WHERE identity_status IN ('conflict', 'unknown')) = 0 AS identity_complete, 'local_sources_readable' AS reason FROM msgs GROUP BY chat_id"))
def chat_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.chat_coverage(messages(spark, sf_dir))


@query(over("SELECT chat_id, count(*) AS n, count(*) FILTER (WHERE message_id = '' OR timestamp >= 1706000000) AS bad, CASE WHEN count(*) FILTER (WHERE message_id = '' OR timestamp >= 1706000000) > 0 THEN 'partial' ELSE 'ok' END AS status FROM msgs GROUP BY chat_id"))
def publication_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.publication_status(coverage.violations(messages(spark, sf_dir), end=1706000000))


@query(over("SELECT record_id FROM msgs WHERE chat_id NOT IN (SELECT chat_id FROM msgs WHERE message_id = '' OR timestamp >= 1706000000)"))
def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.published(coverage.violations(messages(spark, sf_dir), end=1706000000)).select("record_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'rejected' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey::VARCHAR END AS value FROM orders")
def request_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("chat"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") + 1).when(F.col("o_orderkey") % 3 == 1, F.col("o_custkey")).alias("contact"))
    return coverage.request_conflicts(rows, "o_orderkey", "chat", "contact")


@query("SELECT c_custkey, 'Customer_' || substr(c_name, 10) AS safe, 'group_Customer_' || substr(c_name, 10) AS part FROM customer")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_name")
    return readers.table(spark, sf_dir, "customer").select("c_custkey", texts.safe_name(c).alias("safe"), texts.partition_key(F.lit("群聊"), c).alias("part"))


@query("""SELECT c_custkey AS uid, c_mktsegment AS contact_type FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery')""")
def contacts_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = readers.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("contact_type"))
    return views.contacts(people, kinds=("Building", "MACHINERY"))


QUERIES, ORACLE_SQL = query.queries, query.sql
