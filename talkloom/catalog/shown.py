"""Columns as they are shown: types, names, scopes, stages and recognised texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import Registry, messages, over
from talkloom.functions import texts
from talkloom.functions.times import TimeRange
from talkloom.operators import media, normalize
from talkloom.operators.filters import MessageScope
from talkloom.sources import readers

query = Registry()

_WORD = "CASE c_custkey % 7 WHEN 0 THEN 'Group' WHEN 1 THEN 'private' WHEN 2 THEN NULL WHEN 3 THEN ' ' WHEN 4 THEN 'discuss' WHEN 5 THEN ' GROUP ' ELSE 'nothing' END"
_TYPE = f"(SELECT *, CASE lower(coalesce(nullif(trim({_WORD}), ''), 'private')) WHEN 'group' THEN 'group' WHEN 'private' THEN 'private' WHEN 'discuss' THEN 'discuss' END AS kind FROM customer)"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = readers.table(spark, sf_dir, "customer")
    word = F.try_element_at(F.array(*[F.lit(w) for w in ("Group", "private", None, " ", "discuss", " GROUP ", "nothing")]), (F.col("c_custkey") % 7 + 1).cast("int"))
    return c.withColumn("kind", texts.chat_type(word))


@query(f"""SELECT c_custkey, kind, CASE kind WHEN 'private' THEN CASE WHEN c_custkey % 5 > 0 THEN 'u_' || c_custkey END WHEN 'group' THEN CASE WHEN c_custkey % 3 > 0 THEN 'g' || c_custkey ELSE c_name END
  WHEN 'discuss' THEN CASE WHEN c_custkey % 2 > 0 THEN 'd' || c_custkey ELSE c_name END ELSE c_name END AS chat_id FROM {_TYPE}""")
def canonical_chat_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat types from words of any case, and the id that each type of chat has."""
    key = F.col("c_custkey")
    own = lambda n, mark: F.when(key % n > 0, F.concat(F.lit(mark), key)).otherwise(" ")
    found = normalize.canonical_chat_id(F.col("kind"), own(5, "u_"), own(3, "g"), own(2, "d"), F.col("c_name"))
    return _customers(spark, sf_dir).select("c_custkey", "kind", found.alias("chat_id"))


@query("SELECT c_custkey, CASE lower(trim(coalesce(w, ''))) WHEN '' THEN 'private' WHEN 'group' THEN 'group' WHEN 'private' THEN 'private' WHEN 'discuss' THEN 'discuss' END || '_' || coalesce(nullif(left(trim(regexp_replace(c_name, '[^A-Za-z0-9_.-]+', '_', 'g'), '._'), 96), ''), 'unknown') AS key FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN 'Group' WHEN 1 THEN 'private' END AS w FROM customer)")
def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("c_custkey") % 3 == 0, "Group").when(F.col("c_custkey") % 3 == 1, "private")
    return readers.table(spark, sf_dir, "customer").select("c_custkey", texts.partition_key(word, F.col("c_name")).alias("key"))


@query("SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS media FROM customer")
def allowed_with_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only columns of the list, media among them; the others, and one that is not there, stay out."""
    c = readers.table(spark, sf_dir, "customer").withColumnsRenamed({"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "media"})
    return normalize.allowed_columns(c, ("name", "absent", "media", "balance"))


@query("SELECT c_name AS name, c_acctbal AS balance FROM customer")
def allowed_without_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = readers.table(spark, sf_dir, "customer").withColumnsRenamed({"c_name": "name", "c_acctbal": "balance", "c_mktsegment": "media"})
    return normalize.allowed_columns(c, ("name", "absent", "media", "balance"), media=False)


@query("""SELECT event_id, array_to_string(list_filter([CASE WHEN event_type NOT IN ('view', 'click') THEN 'media' END, CASE WHEN event_type = 'view' THEN 'voice' END, CASE WHEN event_type = 'click' THEN 'video' END,
  CASE WHEN user_id % 3 > 0 THEN 'ocr' END], lambda x: x IS NOT NULL), ',') AS stages FROM events""")
def stages_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "voice").when(F.col("event_type") == "click", "video").otherwise("image")
    return readers.table(spark, sf_dir, "events").select("event_id", F.array_join(normalize.stages_for(kind, F.col("user_id") % 3), ",").alias("stages"))


@query("""SELECT event_id, coalesce(nested, outside) AS scope, coalesce(nested <> outside, false) AS conflict
  FROM (SELECT event_id, CASE WHEN event_id % 4 > 0 THEN 'c' || user_id % 10 END AS outside, CASE WHEN event_id % 3 > 0 THEN 'c' || (user_id + event_id % 2) % 10 END AS nested FROM events)""")
def bound_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, user = F.col("event_id"), F.col("user_id")
    outer, nested = F.when(n % 4 > 0, F.concat(F.lit("c"), user % 10)), F.when(n % 3 > 0, F.concat(F.lit("c"), (user + n % 2) % 10))
    scope, conflict = normalize.bound_scope(outer, nested)
    return readers.table(spark, sf_dir, "events").select("event_id", scope.alias("scope"), conflict.alias("conflict"))


@query(over("""SELECT source, record_id FROM msgs WHERE timestamp >= 1704643200 AND chat_id IN ('c7', 'c2', 'o3') AND sender_name = 'name 7' AND kind IN ('text', 'image', 'O', 'F') AND kind = 'text'
  AND (contains(lower(coalesce(text, '')), 'k') OR contains('text', 'k'))"""))
def scoped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats, time, sender, kind and keyword together."""
    scope = MessageScope(("c7", "c2", "o3"), TimeRange(1704643200), ("sender_name", "name 7"), "text", " K ")
    return scope.apply(messages(spark, sf_dir)).select("source", "record_id")


@query(over("SELECT source, record_id FROM msgs WHERE kind = 'image'"))
def messages_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MessageScope(kind="image").apply(messages(spark, sf_dir)).select("source", "record_id")


@query("""SELECT p_partkey AS image, CASE WHEN p_partkey % 3 = 0 THEN 'head\n' || p_name || '\nlast\n' || p_type WHEN p_partkey % 3 = 1 THEN 'head\n' || p_name || '\n' || p_name || ' \nlast\n' || p_type
  ELSE 'head\n' || p_name || '\nlast\nlast\n' || p_type END AS text, CASE p_partkey % 3 WHEN 0 THEN 2 ELSE 0 END AS removed FROM part""")
def stitched_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tiles an image: one below the other with two lines in common; beside each other; with a gap."""
    p, k = readers.table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    upper = F.struct(F.lit(0).alias("index"), F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.lit(9).alias("x1"), F.lit(10).alias("y1"), F.concat(F.lit("head\n"), F.col("p_name"), F.when(k == 1, F.lit("")).otherwise("\nlast")).alias("raw_text"))
    shared = F.when(k == 2, F.lit("last\n")).otherwise(F.concat(F.col("p_name"), F.lit(" \nlast\n")))
    lower = F.struct(
        F.lit(1).alias("index"), F.when(k == 1, 8).otherwise(0).alias("x0"), F.when(k == 2, 10).otherwise(8).alias("y0"), F.when(k == 1, 17).otherwise(9).alias("x1"), F.lit(18).alias("y1"),
        F.concat(shared, F.col("p_type")).alias("raw_text"),
    )
    tiles = p.select(F.col("p_partkey").alias("image"), F.explode(F.array(upper, lower)).alias("t")).select("image", "t.*")
    return media.stitch_tiles(tiles).select("image", "text", "removed")


@query("SELECT p_partkey, '中文' || p_name || '文字 a b' || '。 ' || '字' AS text FROM part")
def texts_without_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks between Han characters go, those beside other characters stay."""
    text = F.concat(F.lit("中 \t文"), F.col("p_name"), F.lit("文  字 a b"), F.lit("。 "), F.lit("字"))
    return readers.table(spark, sf_dir, "part").select("p_partkey", texts.without_cjk_gaps(text).alias("text"))


@query("""SELECT c_custkey, 'gone ' || c_custkey AS prompt, 'u_' || c_custkey AS actor, CASE WHEN c_custkey % 2 = 0 THEN 'u_' || (c_custkey + 1) END AS target,
  CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name || '|' || c_mktsegment END AS participants FROM customer""")
def recall_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What notices of withdrawal say, from fields of their payload."""
    key, name = F.col("c_custkey"), F.col("c_name")
    pairs = {
        47713: F.concat(F.lit("gone "), key), 47703: F.concat(F.lit("u_"), key), 47704: F.when(key % 2 == 0, F.concat(F.lit("u_"), key + 1)),
        47706: name, 47705: F.when(key % 3 > 0, F.col("c_mktsegment")).otherwise(" "), 47715: name, 47714: F.lit(None).cast("string"),
    }
    info = normalize.recall_info(F.array(*[F.lit(n) for n in pairs]), F.array(*pairs.values()))
    found = readers.table(spark, sf_dir, "customer").select("c_custkey", info.alias("i"))
    return found.select("c_custkey", "i.prompt", F.col("i.actor_uid").alias("actor"), F.col("i.target_uid").alias("target"), F.array_join("i.participants", "|").alias("participants"))


QUERIES, ORACLE_SQL = query.queries, query.sql
