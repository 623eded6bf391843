"""Reader data in chunks whose bounds follow from their contents.

A record begins a chunk if the hash of its key says so, one in ``size`` of them.  A record that comes,
goes or changes therefore touches the chunk it stands in, or two if it is a bound, and no other: an
update compares the digests of chunks and writes those that differ.  The index has the chunks in
order, with their neighbours, and the part that holds each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions import texts
from talkloom.operators.snapshot import numbered, set_digest
from talkloom.plans.commits import CommitLog, Part
from talkloom.sources.scratch import kept

ORDER = ("timestamp", "source", "seq", "record_id")


class ReaderStore:
    """Chunks of about ``size`` items below ``path``, in the order of ``order`` (total); ``keys`` name a record."""

    def __init__(self, spark: SparkSession, path: str, size: int = 2000, order: tuple[str, ...] = ORDER, keys: tuple[str, ...] = ("source", "record_id")):
        if not 1 <= size <= 20_000:
            raise ValueError("between 1 and 20,000 items")
        self.spark, self.size, self.order, self.keys, self.log = spark, size, tuple(order), tuple(keys), CommitLog(spark, path, ("index",))

    def _chunked(self, records: DataFrame) -> DataFrame:
        """Records with ``chunk``, the name of the chunk: the hash of the key that begins it.

        Names are carried along within parts by range of the order as they are dealt, and from part
        to part by one row a part, so no task sees more than its own records and none are dealt twice.
        """
        key = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in self.keys]))
        begins = F.when(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % self.size == 0, key)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = records.withColumn("__begins", begins).repartitionByRange(parts, *self.order).sortWithinPartitions(*self.order)

        def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, last = TaskContext.get().partitionId(), None
            for batch in batches:
                own = pc.fill_null_forward(pa.concat_arrays([pa.array([last], pa.string()), batch.column(batch.num_columns - 1).cast(pa.string())]))[1:]
                last = own[-1].as_py() if len(own) else last
                columns = [*batch.columns[:-1], own, pa.array([part] * len(own), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "__own", "__part"])

        schema = T.StructType([*records.schema, T.StructField("__own", T.StringType()), T.StructField("__part", T.IntegerType())])
        named = kept(dealt.mapInArrow(carry, schema), "dealt")
        ends = named.groupBy("__part").agg(F.max_by("__own", F.when(F.col("__own").isNotNull(), F.struct(*self.order))).alias("__last"))
        before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        carried = kept(ends.select("__part", F.last("__last", ignorenulls=True).over(before).alias("__before")), "carried")
        found = named.join(F.broadcast(carried), "__part", "left").withColumn("chunk", F.coalesce("__own", "__before", F.lit("")))
        return found.drop("__part", "__own", "__before")

    def update(self, records: DataFrame) -> int:
        """Make ``records`` the contents of the store; returns how many chunks were written.  Another
        update that was committed meanwhile is an error (RuntimeError): the later one begins again."""
        base = self.log.latest()
        columns = records.columns
        rows = self._chunked(records)
        first = F.min(F.struct(*self.order)).alias("lo")
        stats = rows.withColumn("__fp", texts.fingerprint(*columns)).groupBy("chunk").agg(F.count("*").alias("n"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"), set_digest("__fp").alias("digest"), first)
        placed = numbered(stats.select("chunk", "n", "first_time", "last_time", "digest", *[F.col(f"lo.{c}").alias(f"lo_{c}") for c in self.order]), [f"lo_{c}" for c in self.order])
        placed = kept(placed.withColumnRenamed("position", "chunk_id").drop(*[f"lo_{c}" for c in self.order]), "chunk_stats")
        old = self._index(base)
        if old is None:
            old = self.spark.createDataFrame([], "chunk string, digest string, part string")
        same = placed.join(old.select("chunk", "digest", "part"), ["chunk", "digest"], "left")
        new = kept(same.filter("part IS NULL").select("chunk"), "new_chunks")
        written = new.count()
        if base.version and not written and placed.count() == old.count():
            return 0
        fresh = rows.join(new, "chunk", "left_semi").repartitionByRange("chunk", *self.order).sortWithinPartitions("chunk", *self.order)
        part = self.log.write(fresh.select("chunk", *columns), first=base.version + 1, last=base.version + 1)
        held = same.withColumn("part", F.coalesce("part", F.lit(part.name)))
        held.repartitionByRange("chunk_id").sortWithinPartitions("chunk_id").write.parquet(f"{self.log.path}/index/{part.name}")
        used = {r[0] for r in held.select("part").distinct().collect()}  # as many as parts
        parts = (*(p for p in base.parts if p.name in used), part)
        if self.log.commit(base, parts, {"index": part.name, "schema": T.StructType([T.StructField("chunk", T.StringType()), *records.schema]).json()}) is None:
            raise RuntimeError("another update was first")
        return written

    def _index(self, commit=None) -> DataFrame | None:
        commit = commit or self.log.latest()
        return self.spark.read.parquet(f"{self.log.path}/index/{commit.facts['index']}") if commit.version else None

    def index(self) -> DataFrame:
        """(chunk_id, n, first_time, last_time, prev, next), as :func:`chunk_index` gives it, and the
        chunk's name, digest and part."""
        held = self._index()
        last = held.agg(F.max("chunk_id").alias("last"))  # one row
        number = F.col("chunk_id")
        neighbours = [F.when(number > 1, number - 1).alias("prev"), F.when(number < F.col("last"), number + 1).alias("next")]
        return held.crossJoin(F.broadcast(last)).select("chunk_id", "n", "first_time", "last_time", *neighbours, "chunk", "digest", "part")

    def _rows(self, parts: tuple[Part, ...]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.log.latest().facts["schema"]))
        rows = self.spark.read.schema(schema).parquet(*[self.log.folder(p) for p in parts])
        return rows.withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), "/parts/([0-9a-f]+)/", 1))

    def chunk(self, number: int) -> DataFrame:
        """The items of one chunk in order, from the part that holds it."""
        found = self._index().filter(F.col("chunk_id") == number).select("chunk", "part").collect()
        parts = tuple(p for p in self.log.latest().parts if found and p.name == found[0]["part"])
        rows = self._rows(parts or self.log.latest().parts[:1]).filter(F.col("chunk") == (found[0]["chunk"] if found else "none"))
        return rows.orderBy(*self.order).drop("chunk", "part")

    def items(self) -> DataFrame:
        """All items with the number of their chunk."""
        rows = self._rows(self.log.latest().parts)
        return rows.join(self._index().select("chunk", "part", "chunk_id"), ["chunk", "part"]).drop("chunk", "part")

    def compact(self) -> None:
        """Write all live chunks as one part, when the others hold too much that no index lists."""
        base, index = self.log.latest(), self._index()
        rows = self._rows(base.parts)
        live = rows.join(index.select("chunk", "part"), ["chunk", "part"], "left_semi").drop("part")
        part = self.log.write(live.repartitionByRange("chunk", *self.order).sortWithinPartitions("chunk", *self.order), 1, 1, base.version + 1)
        index.withColumn("part", F.lit(part.name)).repartitionByRange("chunk_id").sortWithinPartitions("chunk_id").write.parquet(f"{self.log.path}/index/{part.name}")
        self.log.commit(base, (part,), {**base.facts, "index": part.name})  # if an update was first, the next call tries again
