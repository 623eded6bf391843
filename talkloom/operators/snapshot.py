"""Snapshots: duplicates, collisions, digests, differences, chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.sources.scratch import kept


def without_duplicates(rows: DataFrame, order: list[str], by: tuple[str, ...] = ("source", "fp")) -> DataFrame:
    """The first row of each fingerprint within a source."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__r = 1").drop("__r")


def resolve_collisions(rows: DataFrame) -> DataFrame:
    """Rows that share an id but not their content get the fingerprint into their id.

    ``rows`` (source, record_id, fp) without duplicates -> further ``base_record_id``.
    """
    sharing = F.count("*").over(Window.partitionBy("source", "record_id"))
    return (
        rows.withColumn("__n", sharing).withColumn("base_record_id", F.when(F.col("__n") > 1, F.col("record_id")))
        .withColumn("record_id", F.when(F.col("__n") > 1, F.concat_ws(":sha256:", "record_id", "fp")).otherwise(F.col("record_id"))).drop("__n")
    )


def export_summary(rows: DataFrame) -> DataFrame:
    """By source: records, exact duplicates, collisions of native ids, first and last time.

    ``rows`` (source, message_id, fp, timestamp) before duplicates are removed.
    """
    by_id = rows.groupBy("source", "message_id").agg(F.count("*").alias("rows"), F.count_distinct("fp").alias("kinds"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    return by_id.groupBy("source").agg(
        F.sum("kinds").alias("records"), F.sum(F.col("rows") - F.col("kinds")).alias("duplicates"),
        F.sum(F.col("kinds") - 1).alias("collisions"), F.min("a").alias("first_time"), F.max("b").alias("last_time"),
    )


def dealt_by_range(rows: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` in parts by range of ``order``, with the number of each part as ``__part``.

    Written once: a range exchange samples its input, so two runs of it may cut elsewhere, and
    whatever is counted by part must be counted on the very rows that were dealt.
    """
    count = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept(rows.repartitionByRange(count, *order).withColumn("__part", F.spark_partition_id()), "dealt")


def order_violations(rows: DataFrame, position: str = "position") -> DataFrame:
    """By chat, how often time runs backwards along the given order.

    A chat is cut by ranges of its positions: steps inside a part are counted there, and those
    from one part to the next by the parts' first and last rows.
    """
    dealt = dealt_by_range(rows.select("chat_id", position, "timestamp"), ["chat_id", position])
    back = F.lag("timestamp").over(Window.partitionBy("chat_id", "__part").orderBy(position)) > F.col("timestamp")
    parts = dealt.withColumn("__back", back).groupBy("chat_id", "__part").agg(
        F.count_if("__back").alias("inside"), F.min_by("timestamp", position).alias("first"), F.max_by("timestamp", position).alias("last")
    )
    step = F.lag("last").over(Window.partitionBy("chat_id").orderBy("__part")) > F.col("first")
    return parts.withColumn("__step", step).groupBy("chat_id").agg((F.sum("inside") + F.count_if("__step")).alias("violations"))


def set_digest(fp: Column | str) -> Column:
    """Aggregate: a digest of all fingerprints (SHA-256 in hex) of a group, whatever their order.

    Four lanes of sixty bits are summed, so tasks add up their own rows first and no group, however
    large, is ever gathered.
    """
    lane = lambda i: F.sum(F.conv(F.substring(fp, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string")
    return F.sha2(F.concat_ws("-", F.count("*").cast("string"), *map(lane, range(4))), 256)


def bucket_digests(rows: DataFrame, buckets: tuple[str, ...] = ("chat_id", "day")) -> DataFrame:
    """Count and digest of each bucket's fingerprints."""
    return rows.groupBy(*buckets).agg(F.count("*").alias("n"), set_digest("fp").alias("digest"))


def compare_digests(old: DataFrame, new: DataFrame, buckets: tuple[str, ...] = ("chat_id", "day")) -> DataFrame:
    """Buckets as same, changed, added or removed."""
    both = old.select(*buckets, F.col("digest").alias("a")).join(new.select(*buckets, F.col("digest").alias("b")), list(buckets), "full_outer")
    verdict = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") == F.col("b"), "same").otherwise("changed")
    return both.select(*buckets, verdict.alias("verdict"))


def compare_snapshots(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("source", "record_id")) -> DataFrame:
    """Records inserted, deleted or changed between two snapshots (keys, fp)."""
    both = old.select(*keys, F.col("fp").alias("a")).join(new.select(*keys, F.col("fp").alias("b")), list(keys), "full_outer")
    verdict = F.when(F.col("a").isNull(), "inserted").when(F.col("b").isNull(), "deleted").when(F.col("a") != F.col("b"), "changed")
    return both.select(*keys, verdict.alias("change")).filter("change IS NOT NULL")


def numbered(rows: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``position`` from 1 in the order given, without gathering the rows anywhere.

    Rows are dealt by range, numbered within each part, and the parts' sizes are added up: the
    only window without a key runs over one row a part.  ``order`` must be total.
    """
    dealt = dealt_by_range(rows, order, parts)
    placed = dealt.withColumn("__r", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return placed.join(starts, "__part").withColumn("position", F.col("__before") + F.col("__r")).drop("__part", "__r", "__before")


def chunk_index(rows: DataFrame, size: int = 2000) -> DataFrame:
    """Chunks of ``size`` items by ``position``: count, first and last time, neighbours."""
    if not 1 <= size <= 20_000:
        raise ValueError("between 1 and 20,000 items")
    chunk = (F.floor((F.col("position") - 1) / size) + 1).alias("chunk_id")
    index = rows.groupBy(chunk).agg(F.count("*").alias("n"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))
    last = index.agg(F.max("chunk_id").alias("last_chunk"))  # one row
    number = F.col("chunk_id")
    return index.crossJoin(F.broadcast(last)).select("chunk_id", "n", "first_time", "last_time", F.when(number > 1, number - 1).alias("prev"), F.when(number < F.col("last_chunk"), number + 1).alias("next"))


def day_headings(rows: DataFrame, day: str = "day", order: tuple[str, ...] = ("timestamp", "seq", "record_id")) -> DataFrame:
    """Whether a row is the first of its local day in its chat; each day is ordered by itself."""
    first = F.row_number().over(Window.partitionBy("chat_id", day).orderBy(*order)) == 1
    return rows.withColumn("new_day", first)


def capped_export(rows: DataFrame, limit: int, order: list[str]) -> tuple[DataFrame, bool]:
    """The first ``limit`` rows, and whether there were more."""
    ahead = rows.orderBy(*order).limit(limit + 1)
    return ahead.orderBy(*order).limit(limit), ahead.count() > limit
