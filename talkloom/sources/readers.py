"""Sources: message tables, JSON lines, file inventories, snapshots; and the driver's tables
seen as message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.functions import texts
from talkloom.functions.times import epoch_of
from talkloom.operators.normalize import MESSAGE_COLUMNS, member_name, select_or_null

#: Stored column names of a primary message table.
PRIMARY_COLUMNS = {
    "msg_id": ("40001", "bigint"), "create_time": ("40050", "bigint"), "seq": ("40003", "bigint"), "sender_uid": ("40020", "string"),
    "peer_uid": ("40021", "string"), "peer_num": ("40027", "bigint"), "msg_code": ("40011", "bigint"), "type_code": ("40012", "bigint"),
    "status_code": ("40013", "bigint"), "payload": ("40800", "binary"), "ext_payload": ("40900", "binary"), "sender_uin": ("40033", "string"),
    "peer_uin": ("40030", "string"),
}
INDEX_COLUMNS = {k: PRIMARY_COLUMNS[k] for k in ("msg_id", "create_time", "seq", "sender_uid", "peer_uid", "peer_num")} | {
    "text": ("41701", "string"), "aux_text": ("41702", "string"), "msg_code": ("41703", "bigint"), "type_code": ("41704", "bigint"),
}
CONTACT_COLUMNS = {
    "uid": ("1000", "string"), "uin": ("1002", "string"), "nick": ("20002", "string"), "remark": ("20009", "string"),
    "signature": ("20011", "string"), "avatar": ("20004", "string"),
}
GROUP_COLUMNS = {"group_id": ("60001", "bigint"), "name": ("60007", "string"), "description": ("60026", "string"), "alias": ("60267", "string")}
MEMBER_COLUMNS = {
    "group_id": ("60001", "bigint"), "uid": ("1000", "string"), "alias": ("1001", "string"), "uin": ("1002", "string"),
    "nick": ("20002", "string"), "card": ("64003", "string"),
}
NORMALIZED = "source string, chat_id string, message_id string, record_id string, time string, timestamp bigint, seq bigint, sender_id string, sender_name string, direction string, identity_status string, kind string, text string"


def scan_tables(tables: dict[str, DataFrame], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Tables by chat type (private, group, discuss) as one, columns named and typed."""
    out = None
    for kind, df in tables.items():
        part = select_or_null(df, columns).withColumn("chat_type", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def scan_primary(tables: dict[str, DataFrame]) -> DataFrame:
    return scan_tables(tables, PRIMARY_COLUMNS)


def scan_index(tables: dict[str, DataFrame]) -> DataFrame:
    return scan_tables(tables, INDEX_COLUMNS)


def scan_contacts(df: DataFrame) -> DataFrame:
    return select_or_null(df, CONTACT_COLUMNS)


def scan_members(df: DataFrame) -> DataFrame:
    found = select_or_null(df, MEMBER_COLUMNS)
    return found.withColumn("display_name", member_name(*[F.col(c) for c in ("card", "nick", "alias", "uid", "uin")]))


def read_normalized(spark: SparkSession, path: str, sources: tuple[str, ...] = ("w", "q")) -> tuple[DataFrame, DataFrame]:
    """JSON lines of normalized messages: (good rows, quarantined lines with a reason).

    A byte order mark and blank lines are no matter.  A row must have a known source and a
    record id, and its id must not belong to another chat.
    """
    lines = spark.read.text(path).select(F.regexp_replace("value", "^﻿", "").alias("line")).filter("trim(line) <> ''")
    parsed = lines.select("line", F.from_json("line", f"{NORMALIZED}, __corrupt string", {"columnNameOfCorruptRecord": "__corrupt"}).alias("row"))
    row = F.col("row")
    reason = (
        F.when(row.isNull() | row["__corrupt"].isNotNull(), "not_json")
        .when(~F.coalesce(row["source"].isin(*sources), F.lit(False)), "unknown_source")
        .when(texts.filled(row["record_id"]).isNull(), "missing_record_id")
        .when(row["chat_id"].isNotNull() & ~row["record_id"].startswith(F.concat(row["chat_id"], F.lit(":"))), "contradictory_identity")
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.filter("reason IS NULL").select(*[row[c].alias(c) for c in MESSAGE_COLUMNS])
    return good, judged.filter("reason IS NOT NULL").select("line", "reason")


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files with name, month folder, size and digests."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return files.select(
        "path", name.alias("name"), F.nullif(F.regexp_extract("path", r"/([0-9]{4}-[0-9]{2})/", 1), F.lit("")).alias("month"),
        F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"),
        F.nullif(F.regexp_extract(name, "^([0-9]+)_", 1), F.lit("")).alias("resource_id"),
    )


def snapshot_sources(spark: SparkSession, path: str) -> DataFrame:
    """What the last commit of a snapshot says of its sources (source, rows, first_time, last_time,
    complete); ValueError if it is not complete or there is none."""
    from talkloom.plans.commits import CommitLog

    found = CommitLog(spark, path).latest().facts.get("sources")
    if found is None or not all(s["complete"] for s in found):
        raise ValueError("the snapshot is not complete")
    columns = "source string, rows bigint, first_time bigint, last_time bigint, complete boolean"
    return spark.createDataFrame([tuple(s[c.split()[0]] for c in columns.split(", ")) for s in found], columns)


# -- the driver's tables as message tables ---------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    code = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "signup", 3).when(F.col("event_type") == "error", 4).otherwise(17)
    return e.filter("event_id % 11 <> 0").select(
        F.concat(F.lit("c"), F.col("user_id") % 10).alias("chat_id"), F.col("event_id").alias("msg_id"), epoch_of("ts").alias("timestamp"),
        (F.col("event_id") % 7).alias("seq"), F.concat(F.lit("u_"), "user_id").alias("sender_uid"), (F.col("user_id") + 10000).cast("string").alias("sender_uin"),
        code.cast("bigint").alias("type_code"), F.when(F.col("event_id") % 2 == 0, 5).otherwise(1).cast("bigint").alias("msg_code"), "value",
    )


def events_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.filter("event_id % 3 <> 1 OR event_id % 11 = 0").select(
        F.concat(F.lit("c"), F.col("user_id") % 10).alias("chat_id"), F.col("event_id").alias("msg_id"), (epoch_of("ts") + 5).alias("timestamp"),
        (F.col("event_id") % 7).alias("seq"), F.concat(F.lit("u_"), "user_id").alias("sender_uid"), F.col("props").alias("text"),
    )


def orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("o"), F.col("o_custkey") % 10).alias("chat_id"),
        F.struct(F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey").cast("string")).alias("server_id_str"), F.col("o_orderkey").alias("local_id")).alias("id"),
        epoch_of("o_orderdate").alias("create_time"), F.when(F.col("o_custkey") % 13 != 0, F.concat(F.lit("w"), "o_custkey")).alias("sender_wxid"),
        F.concat(F.lit("name "), F.col("o_custkey") % 50).alias("sender"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit(True)).when(F.col("o_custkey") % 3 == 1, F.lit(False)).alias("is_from_me"),
        F.when(F.col("o_orderstatus") == "P", "system").otherwise(F.col("o_orderstatus")).alias("kind"), F.col("o_orderpriority").alias("text"),
        F.when(F.col("o_orderkey") % 17 == 0, F.array(F.lit("sender_identity_conflict: two owners"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("u_"), "c_custkey").alias("uid"), (F.col("c_custkey") + 10000).cast("string").alias("uin"), F.col("c_name").alias("nick"), F.col("c_mktsegment").alias("remark"),
        F.concat(F.lit("c"), F.col("c_custkey") % 10).alias("chat_id"),
    )


NESTED = "chat_id string, id struct<server_id_str:string,local_id:bigint>, create_time bigint, time_iso string, sender_wxid string, sender string, is_from_me boolean, kind string, text string, identity_status string, warnings array<string>"


def read_nested(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Pages of the nested source as JSON lines: (rows, lines that are none)."""
    lines = spark.read.schema(f"{NESTED}, __corrupt string").option("columnNameOfCorruptRecord", "__corrupt").json(path)
    return lines.filter("__corrupt IS NULL AND id IS NOT NULL").drop("__corrupt"), lines.filter("__corrupt IS NOT NULL OR id IS NULL").select(F.coalesce("__corrupt", F.to_json(F.struct("*"))).alias("line"))


def read_coverage(good: DataFrame, bad: DataFrame) -> DataFrame:
    """Unreadable lines never count as an empty result: one row with counts and a status."""
    rows, lost = good.agg(F.count("*").alias("rows")), bad.agg(F.count("*").alias("unreadable"))  # one row each
    status = F.when(F.col("unreadable") == 0, "ok").when(F.col("rows") == 0, "failed").otherwise("partial")
    return rows.crossJoin(lost).withColumn("status", status)


def artifact_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Every data file below a path with its size and digest, for a job's manifest."""
    files = file_inventory(spark, path)
    return files.filter(~F.col("name").startswith("_") & ~F.col("name").startswith(".")).select("path", "bytes", "sha256")
