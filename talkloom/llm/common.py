"""Helpers shared by the operators: shared-folder tables, per-document maps, split rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.sources.scratch import kept, shared_dir

ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<float>": pa.list_(pa.float32()),
    "array<string>": pa.list_(pa.string()),
}


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/talkloom/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed once, lineage cut,
    and safe from lost executors.  The files live as long as the checkpoint folder does."""
    return kept(df, name)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared folder that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % modulus


#: Rows of a batch that are worked on at once; Spark bounds a batch's bytes.
PIECE = 1000


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces: whole texts are large, and a piece is held several times over."""
    for batch in batches:
        for i in range(0, batch.num_rows, PIECE):
            yield batch.slice(i, PIECE)


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    make: Callable[[], Callable[[list[str | None]], Sequence]],
    fields: Sequence[tuple[str, str]],
    carry: Sequence[str] = (),
) -> DataFrame:
    """One output row for each row: the ``keep`` columns, then ``fields`` (name, type).

    ``make`` runs once in each task and returns a function from a batch of texts (and of the
    ``carry`` columns) to the new columns.  Only these columns are read from ``df``.
    """
    chosen = df.select(
        *[df[c] for c in keep], *[df[c].alias(f"__{c}") for c in carry], df[text].cast("string").alias("__text")
    )
    kinds = [ARROW[t] for _, t in fields]
    names = [*keep, *(n for n, _ in fields)]
    schema = T.StructType(
        [*chosen.schema.fields[: len(keep)], *(T.StructField(n, T._parse_datatype_string(t)) for n, t in fields)]
    )
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in pieces(batches):
            made = work(*(batch.column(i).to_pylist() for i in (-1, *range(width, width + len(carry)))))
            new = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], names)

    return chosen.mapInArrow(run, schema)


def scan_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    make: Callable[[], Callable[[list, list[str | None]], Iterator[Sequence]]],
    fields: Sequence[tuple[str, str]],
    finish: bool = False,
) -> DataFrame:
    """Any number of output rows: ``make()`` returns a generator function over a batch's
    (kept columns, texts) that yields tuples of columns; with ``finish`` it is called once more
    with ``(None, None)`` after the last batch, for what a task has summed up."""
    chosen = df.select(*[df[c] for c in keep], df[text].cast("string").alias("__text"))
    kinds = [ARROW[t] for _, t in fields]
    names = [n for n, _ in fields]
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()

        def out(parts):
            for made in parts or ():
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(made, kinds, strict=True)], names
                )

        for batch in pieces(batches):
            yield from out(work([batch.column(i) for i in range(width)], batch.column(width).to_pylist()))
        if finish:
            yield from out(work(None, None))

    return chosen.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))


def in_blocks(docs: DataFrame, columns: Sequence[Column], name: str) -> DataFrame:
    """A copy of ``columns`` in the shared folder with ``rid``, a number for each row, and
    ``block``, the file that holds it: tasks that scan the copy find what other jobs prepared for
    their block as a side file, so the texts themselves are never shuffled."""
    spark = docs.sparkSession
    copy = docs.select(*columns, F.monotonically_increasing_id().alias("rid"), F.spark_partition_id().alias("block"))
    path = new_path(spark, name)
    copy.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(copy.schema).parquet(path)


def open_store(path: str):
    """(pyarrow file system, path in it) of a place in the shared folder, local or remote."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class SideFiles:
    """A table dealt by block into a bounded number of folders, for tasks that scan blocks.

    A folder holds the rows of several blocks in order, so a block is a few row groups of a file
    or two, and there are as many folders as shuffle partitions, not as blocks.  The block is the
    column ``key``, without its last ``shift`` bits.
    """

    def __init__(self, path: str, folders: int, key: str = "block", shift: int = 0):
        self.path, self.folders, self.key, self.shift = path, folders, key, shift

    def read(self, block: int, columns: list[str]) -> pa.Table | None:
        """What was written for ``block``, or None."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, folder = open_store(self.path)
        found = store.get_file_info(fs.FileSelector(f"{folder}/folder={block % self.folders}", allow_not_found=True))
        files = [f.path for f in found if f.path.endswith(".parquet")]
        own = [(self.key, ">=", block << self.shift), (self.key, "<", (block + 1) << self.shift)]
        tables = [pq.read_table(f, filesystem=store, columns=columns, partitioning=None, filters=own) for f in files]
        return pa.concat_tables(tables) if tables else None

    def frame(self, spark: SparkSession, columns: str) -> DataFrame:
        """The whole table."""
        return spark.read.schema(columns).parquet(self.path)


def write_side_files(df: DataFrame, name: str, order: Sequence[str] = (), key: str = "block", shift: int = 0) -> SideFiles:
    """Write ``df`` by block (not negative), within a block by ``order``."""
    path = new_path(df.sparkSession, name)
    folders = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.shiftright(F.col(key), shift) if shift else F.col(key)
    dealt = df.withColumn("folder", (block % folders).cast("int")).repartition(folders, "folder").sortWithinPartitions("folder", key, *order)
    dealt.write.partitionBy("folder").option("compression", "zstd").option("parquet.block.size", str(4 << 20)).parquet(path)
    return SideFiles(path, folders, key, shift)
