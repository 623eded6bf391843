"""Stores that are built once and read many times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import Registry, messages, over
from talkloom.operators import identity, media, substrings
from talkloom.plans.digest_tree import DigestTree, changed_records
from talkloom.plans.known import KnownRecords
from talkloom.plans.page_store import PageStore
from talkloom.plans.reader_store import ReaderStore
from talkloom.functions import times
from talkloom.functions.times import TimeRange
from talkloom.sources import readers
from talkloom.sources.exports import read_exports
from talkloom.sources.scratch import kept, shared_dir

query = Registry()


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/talkloom/{name}-{uuid.uuid4().hex}"


@query(over("""SELECT source, record_id, timestamp FROM (SELECT *, row_number() OVER (ORDER BY timestamp, source, seq, message_id, record_id) AS r FROM msgs
  WHERE timestamp >= 1704816000) WHERE r <= 300"""))
def page_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages of 100 from a place deep in a store of all messages, which was filled in three parts
    and merged; each page opens the files around its place."""
    store = PageStore(spark, _place(spark, "pages"), file_rows=20_000)
    rows = kept(messages(spark, sf_dir), "messages")  # read by all three
    for part in range(3):
        store.append(rows.filter(F.pmod(F.crc32("record_id"), F.lit(3)) == part))
    store.merge(fan=2)
    out, at = None, [1704816000, "", -1, "", ""]
    for _ in range(3):
        page = store.page_rows(100, at)
        found = page.collect()  # a page
        part = spark.createDataFrame(found, page.schema)
        out = part if out is None else out.unionByName(part)
        at = [found[-1][k] for k in store.keys] if found else at
    return out.select("source", "record_id", "timestamp")


@query(over("""SELECT p.query, count(*) AS messages, count(DISTINCT chat_id) AS chats, min(record_id) AS first_record
  FROM (SELECT DISTINCT substr(props, 1 + event_id % 5, 1 + event_id % 7) AS query FROM events UNION SELECT unnest(['key', 'on_', '1', '%', '未'])) p JOIN msgs ON query <> '' AND contains(msgs.text, query) GROUP BY p.query"""))
def keywords_of_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages by keywords without a bound on their number: pieces of what all events say, one to
    seven characters long, and a few more."""
    pieces = readers.table(spark, sf_dir, "events").select(F.expr("substring(props, int(1 + event_id % 5), int(1 + event_id % 7))").alias("query"))
    asked = pieces.unionByName(spark.createDataFrame([(q,) for q in ("key", "on_", "1", "%", "未")], "query string"))
    rows = messages(spark, sf_dir)
    said = kept(rows.groupBy("text", "chat_id").agg(F.count("*").alias("n"), F.min("record_id").alias("first")), "said")
    found = substrings.find_bodies(asked, said).join(said, "text")
    return found.groupBy("query").agg(F.sum("n").alias("messages"), F.count_distinct("chat_id").alias("chats"), F.min("first").alias("first_record"))


@query("""WITH q AS (SELECT DISTINCT substr(c_name, 10, 2 + c_custkey % 8) AS query FROM customer), c AS (SELECT 'u_' || c_custkey AS uid, c_mktsegment AS remark, c_name AS nick, (c_custkey + 10000)::VARCHAR AS uin FROM customer),
 s AS (SELECT query, uid, remark AS display_name, CASE WHEN query IN (remark, nick, uin, uid) THEN 0 WHEN contains(remark, query) OR contains(nick, query) THEN 1 WHEN contains(uin, query) OR contains(uid, query) THEN 2 END AS score FROM q, c)
SELECT query, uid AS id, score, display_name, rank, total <= 5 AS complete FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score, display_name, uid) AS rank, count(*) OVER (PARTITION BY query) AS total FROM s WHERE score IS NOT NULL) WHERE rank <= 5""")
def discover_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many queries as there are customers: pieces of their names against all customers."""
    asked = readers.table(spark, sf_dir, "customer").select(F.expr("substring(c_name, 10, 2 + c_custkey % 8)").alias("query"))
    return identity.discover(asked, readers.contacts(spark, sf_dir), 5).select("query", "id", "score", "display_name", "rank", "complete")


@query("""WITH old AS (SELECT o_orderkey AS k, o_comment AS c FROM (SELECT o_orderkey, o_orderpriority || o_totalprice AS o_comment FROM orders) WHERE k % 97 <> 5),
 new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 89 = 7 THEN 'new' ELSE o_orderpriority || o_totalprice END AS c FROM orders WHERE o_orderkey % 101 <> 9)
SELECT coalesce(old.k, new.k)::VARCHAR AS record_id, CASE WHEN old.k IS NULL THEN 'inserted' WHEN new.k IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM old FULL JOIN new ON old.k = new.k WHERE old.k IS NULL OR new.k IS NULL OR old.c <> new.c""")
def changes_by_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the orders by their digest trees: only leaves that differ are compared."""
    o, key = readers.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = F.concat("o_orderpriority", F.col("o_totalprice").cast("string"))
    record = lambda body: (F.lit("o").alias("source"), key.cast("string").alias("record_id"), F.sha2(body, 256).alias("fp"))
    old = DigestTree.write(o.filter("o_orderkey % 97 <> 5").select(*record(text)), _place(spark, "tree"), leaf_rows=50)
    changed = o.filter("o_orderkey % 101 <> 9").select(*record(F.when(key % 89 == 7, "new").otherwise(text)))
    new = DigestTree.write(changed, _place(spark, "tree"), depth=old.depth())
    return changed_records(old, new).select("record_id", "change")


@query(over("""SELECT row_number() OVER (ORDER BY g) AS chunk_id, count(*) AS n, min(timestamp) AS first_time, max(timestamp) AS last_time, CASE WHEN row_number() OVER (ORDER BY g) > 1 THEN row_number() OVER (ORDER BY g) - 1 END AS prev,
  CASE WHEN row_number() OVER (ORDER BY g) < count(*) OVER () THEN row_number() OVER (ORDER BY g) + 1 END AS next
  FROM (SELECT timestamp, sum(CASE WHEN ('0x' || substr(md5(source || ':' || record_id), 1, 8))::BIGINT % 500 = 0 THEN 1 ELSE 0 END) OVER (ORDER BY timestamp, source, seq, record_id) AS g FROM msgs) GROUP BY g"""))
def reader_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of a reader store that was made of most messages and brought up to date with all."""
    store, rows = ReaderStore(spark, _place(spark, "reader"), 500), messages(spark, sf_dir)
    store.update(rows.filter("seq <> 3"))
    store.update(rows)
    return store.index().select("chunk_id", "n", "first_time", "last_time", "prev", "next")


@query(over("SELECT source, chat_id, record_id, timestamp, text FROM msgs WHERE timestamp >= 1704643200 AND timestamp < 1705248000"))
def exports_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages exported as JSON lines by local month, and a week of them read back; files of other
    months are not opened."""
    place, rows = _place(spark, "exports"), messages(spark, sf_dir)
    month = times.local_month(F.col("timestamp"))
    # rows of a month together, but a large month in several tasks and files
    rows.withColumn("month", F.coalesce(month, F.lit("unknown"))).hint("rebalance", F.col("month")).write.partitionBy("month").json(place)
    return read_exports(spark, place, TimeRange(1704643200, 1705248000)).select("source", "chat_id", "record_id", "timestamp", "text")


@query("""SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents WHERE doc_id % 3 = 2) WHERE r = 1
  AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 3 < 2 AND text IS NOT NULL)""")
def new_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the documents against two earlier versions by Bloom filters of their texts."""
    d = readers.table(spark, sf_dir, "documents").select(F.lit("d").alias("source"), "doc_id", F.sha2("text", 256).alias("fp"))
    known = KnownRecords(spark, _place(spark, "known"))
    known.add(d.filter("doc_id % 3 = 0"))
    known.add(d.filter("doc_id % 3 = 1"))
    return known.new_records(d.filter("doc_id % 3 = 2"), ["doc_id"]).select("doc_id")


@query("""SELECT conv_id, turn, '/body/items/0' AS media_ref, 3 AS depth, 'image' AS kind FROM conversations
  UNION ALL SELECT conv_id, turn, '/body/items/1/reply/parts/0/deep', 7, 'voice' FROM conversations WHERE turn % 2 = 0
  UNION ALL SELECT conv_id, turn, '/a~1b', 1, 'video' FROM conversations WHERE role = 'user'""")
def media_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media nodes of records nested six deep, made of all turns."""
    c = readers.table(spark, sf_dir, "conversations")
    of = lambda **fields: F.struct(*[F.lit(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in fields.items()])
    deep = of(deep=of(kind_name=F.when(F.col("turn") % 2 == 0, "voice").otherwise("text"), n=F.col("turn")))
    image = of(kind="image", inner=F.array(of(kind="video")), text=F.col("text"))
    item = of(kind="reply", kind_name="image", reply=of(parts=F.array(deep)))
    body = of(items=F.array(F.to_json(image), F.to_json(item)))
    text = F.concat(F.lit('{"id":'), "conv_id", F.lit(',"body":{"items":['), F.array_join(body["items"], ","), F.lit(']},"a/b":{"kind":"'), F.when(F.col("role") == "user", "video").otherwise("none"), F.lit('"}}'))
    return media.media_nodes(c.withColumn("payload", text), "payload", ("conv_id", "turn")).select("conv_id", "turn", "media_ref", "depth", "kind")


QUERIES, ORACLE_SQL = query.queries, query.sql
