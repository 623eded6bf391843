"""Sinks: JSON lines, Markdown, chunked datasets, manifests.  Spark's job commit makes each of
them appear whole or not at all; an existing target is only replaced if asked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions import texts, times
from talkloom.operators.snapshot import chunk_index, day_headings, numbered
from talkloom.sources.scratch import kept


def write_jsonl(rows: DataFrame, path: str, order: list[str], overwrite: bool = False) -> None:
    rows.orderBy(*order).write.mode("overwrite" if overwrite else "errorifexists").json(path)


def markdown_lines(messages: DataFrame) -> DataFrame:
    """``(chat_id, position columns, line)``: a heading for each local day, then
    ``HH:MM:SS sender: body``; a blank body is the kind in brackets."""
    rows = messages.withColumn("day", times.local_day(F.col("timestamp")))
    body = F.coalesce(texts.filled(F.col("text")), F.concat(F.lit("["), F.col("kind"), F.lit("]")))
    line = F.concat(F.substring(times.local_time(F.col("timestamp")), 12, 8), F.lit(" "), F.coalesce("sender_name", F.lit("unknown")), F.lit(": "), body)
    headed = day_headings(rows)
    return headed.select(
        "chat_id", "timestamp", "seq", "record_id",
        F.when(F.col("new_day"), F.concat(F.lit("## "), "day", F.lit("\n\n"), line)).otherwise(line).alias("line"),
    )


def write_markdown(messages: DataFrame, path: str, overwrite: bool = False) -> None:
    """One folder a chat; its files, taken by name, hold its lines in order.

    Lines are dealt by range, so a huge chat is written by many tasks.
    """
    order = ["chat_id", "timestamp", "seq", "record_id"]
    dealt = markdown_lines(messages).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select("chat_id", F.col("line").alias("value")).write.mode("overwrite" if overwrite else "errorifexists").partitionBy("chat_id").text(path)


#: Chunks that share a folder.
CHUNKS_OF_FOLDER = 1000


def write_chunks(items: DataFrame, path: str, order: list[str], size: int = 2000, overwrite: bool = False) -> DataFrame:
    """Items in chunks of ``size`` in one order, and the index of chunks.

    A row has its ``position`` and ``chunk_id``; 1,000 chunks share a folder (``folder``), in
    files by range of positions, so a reader of one chunk opens one folder and a file or two.
    """
    placed = kept(numbered(items, order).withColumn("chunk_id", F.floor((F.col("position") - 1) / size) + 1), "chunks")
    mode = "overwrite" if overwrite else "errorifexists"
    folder = F.floor((F.col("chunk_id") - 1) / CHUNKS_OF_FOLDER)
    dealt = placed.withColumn("folder", folder).repartitionByRange("position").sortWithinPartitions("position")
    dealt.write.mode(mode).partitionBy("folder").json(f"{path}/items")
    index = chunk_index(placed, size)
    index.write.mode(mode).json(f"{path}/index")
    return index


def media_manifest(references: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """References (record_id, role, occurrence, path) with content and size, and the distinct
    contents to copy."""
    found = references.join(inventory.select("path", "sha256", "bytes"), "path", "left")
    rows = found.select("record_id", "role", "occurrence", "sha256", "bytes")
    return rows, found.filter("sha256 IS NOT NULL").groupBy("sha256", "bytes").agg(F.min("path").alias("path"), F.count("*").alias("uses"))


def write_manifest(rows: DataFrame, path: str) -> None:
    """A small table of what a job made and how complete it is."""
    rows.coalesce(1).write.mode("overwrite").parquet(path)
