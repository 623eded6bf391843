"""Many literal texts sought in many texts at once, by a table of short substrings.

Every distinct text is listed under its distinct substrings of a few sizes (postings), each as a
64-bit hash.  A text that is sought can only be where all of its own are, so it meets the postings
of the rarest of them alone, and what it meets there is compared in full, so that equal hashes of
different substrings do no harm.  Of the sizes it is sought by the greatest that it has: by fewer
characters than it has, the texts of a substring and the texts that are sought by it would both
grow with their tables.  Up to 12 characters that is the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.sources.scratch import kept

#: Characters of a listed substring, in postings that are kept and in those made for one search.
STORED, SIZES = (1, 2, 3), (*range(1, 13), 24, 48)
#: The table of bits that tells tasks which substrings are sought: bits for each of them, and the
#: logarithm of its greatest size (32 MB).  More queries let more postings through, which the join drops.
_SPARSE, _MOST_BITS = 256, 28
_CHARS = 1 << 19


def size_of(query: Column, sizes: tuple[int, ...]) -> Column:
    """The greatest of ``sizes`` that ``query`` has characters for."""
    return F.greatest(*[F.when(F.char_length(query) >= n, n).otherwise(sizes[0]) for n in sizes], F.lit(sizes[0]))


def _joined(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """Hashes of substrings of ``size`` by those of their beginning and their end."""
    x = (first ^ (first >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + second + np.uint64(size)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(points: np.ndarray, size: int, known: dict[int, np.ndarray]) -> np.ndarray:
    """A hash of the ``size`` characters from each place of ``points`` on."""
    if size not in known:
        part = (size + 1) // 2
        ends = _hashes(points, part, known) if size > 1 else points.astype(np.uint64)
        known[size] = _joined(ends[: max(0, len(points) - size + 1)], ends[size - part :] if size > 1 else ends, size)
    return known[size]


def _listed(texts: DataFrame, sizes: tuple[int, ...], greatest: bool = False, sought: np.ndarray | None = None) -> DataFrame:
    rows = texts.filter("text IS NOT NULL").select("id", F.make_valid_utf8(F.col("text")).alias("text"))
    shared = None if sought is None else rows.sparkSession.sparkContext.broadcast(sought)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if shared is None else shared.value
        for batch in batches:
            lengths = pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            piece = (np.cumsum(lengths) - lengths) // _CHARS
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(lengths)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                own = lengths[begin:end]
                points = np.frombuffer("".join(batch.column(1).slice(begin, end - begin).to_pylist()).encode("utf-32-le"), np.uint32)
                place = np.repeat(np.arange(end - begin), own)
                left = np.repeat(np.cumsum(own), own) - np.arange(len(points))
                fit = np.array([0, *sizes])[np.searchsorted(sizes, own, side="right")]
                known = {}
                for size in sizes:
                    if size > len(points):
                        continue
                    grams = _hashes(points, size, known)
                    inside = left[: len(grams)] >= size
                    if greatest:
                        inside &= fit[place[: len(grams)]] == size
                    if table is not None:
                        at = grams >> np.uint64(64 - (len(table) * 64).bit_length() + 1)
                        inside &= (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                    at = np.flatnonzero(inside)
                    grams, rows_of = grams[at], place[at]
                    order = np.lexsort((grams, rows_of))
                    grams, rows_of = grams[order], rows_of[order]
                    new = np.ones(len(at), bool)
                    new[1:] = (grams[1:] != grams[:-1]) | (rows_of[1:] != rows_of[:-1])
                    if len(at):
                        ids = batch.column(0).take(pa.array(rows_of[new] + begin))
                        yield pa.RecordBatch.from_arrays([pa.array(grams[new].view(np.int64)), ids], ["gram", "id"])

    return rows.mapInArrow(run, T.StructType([T.StructField("gram", T.LongType()), rows.schema["id"]]))


def _as_texts(queries: DataFrame) -> DataFrame:
    return queries.select(F.col("query").alias("id"), F.col("query").alias("text"))


def _bits(queries: DataFrame, sizes: tuple[int, ...]) -> np.ndarray:
    """A table of bits, in words of 64, with that of each substring by which one of ``queries`` is
    sought, at its hash's first bits."""
    grams = kept(_listed(_as_texts(queries), sizes, greatest=True).select("gram").distinct(), "grams")
    size = min(_MOST_BITS, max(16, (_SPARSE * grams.count()).bit_length()))
    at = F.shiftrightunsigned("gram", 64 - size)
    words = grams.groupBy(F.shiftrightunsigned(at, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, int(shiftrightunsigned(gram, {64 - size}) & 63)))").alias("bits"))
    found, table = words.toArrow(), np.zeros(1 << (size - 6), np.uint64)  # at most the table
    table[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return table


def postings(texts: DataFrame, sizes: tuple[int, ...] = STORED, greatest: bool = False, sought: DataFrame | None = None) -> DataFrame:
    """``texts`` (id, text) -> ``(gram, id)``, the hash of each substring once for an id; null texts
    have none.  With ``greatest`` only substrings of the greatest size that a text has; with
    ``sought`` (query) only those by which one of these is sought, and a few more (:func:`_bits`)."""
    return _listed(texts, sizes, greatest, None if sought is None else _bits(sought, sizes))


def write_postings(texts: DataFrame, path: str) -> None:
    """Keep postings for many searches, in order of the substrings, so that a search for a few of
    them skips most of a file by its statistics."""
    postings(texts).repartitionByRange("gram").sortWithinPartitions("gram").write.option("compression", "zstd").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _wanted(asked: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """``asked`` (query) -> ``(gram, query)``: the substrings by which each is sought."""
    return postings(_as_texts(asked), sizes, greatest=True).withColumnRenamed("id", "query")


def _candidates(asked: DataFrame, listed: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """``(query, id)``: each of ``asked`` (query) with what its rarest substring is ``listed`` (gram, id) for."""
    wanted, held = kept(_wanted(asked, sizes), "wanted"), kept(listed, "postings")
    counts = held.groupBy("gram").agg(F.count("*").alias("texts"))
    # a query with a substring that no text has is found nowhere
    ranked = wanted.join(counts, "gram", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    rarest = ranked.groupBy("query").agg(F.min(F.struct("texts", "gram")).alias("least")).filter("least.texts > 0").select("query", F.col("least.gram").alias("gram"))
    return held.join(kept(rarest, "rarest"), "gram").select("query", "id")


def _asked(queries: DataFrame) -> DataFrame:
    return kept(queries.select(F.col("query").cast("string").alias("query")).filter("query <> ''").distinct(), "queries")


def _checked(candidates: DataFrame, texts: DataFrame, *columns: str) -> DataFrame:
    body = F.col("text")
    return candidates.join(texts, "id").filter(body.contains(F.col("query"))).select("query", *columns, (body == F.col("query")).alias("exact"))


def find_bodies(queries: DataFrame, texts: DataFrame) -> DataFrame:
    """``queries`` (query) in the distinct ``texts`` (text) -> ``(query, text, exact)``, each pair once:
    for callers who count by text, so that a text which a million rows share is compared once."""
    asked = _asked(queries)
    sizes = tuple(sorted(r[0] for r in asked.select(size_of(F.col("query"), SIZES)).distinct().collect())) or STORED  # one of SIZES each
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # short texts are few bytes but many substrings: dealt, so that all tasks list some
    bodies = kept(texts.select("text").filter("text <> ''").distinct().repartition(parts).withColumn("id", F.monotonically_increasing_id()), "bodies")
    return _checked(_candidates(asked, postings(bodies.select("id", "text"), sizes, sought=asked), sizes), bodies, "text")


def find(queries: DataFrame, texts: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``queries`` (query) in ``texts`` (id, text) -> ``(query, id, exact)``: every pair where the text
    contains the query, and whether it is nothing else.

    There is no bound on either side, and no pattern: a query stands for itself.  Null and empty
    queries find nothing, repeated ones count once.  ``stored`` are postings of the same texts
    (:func:`write_postings`); without them they are made for the sizes that the queries need.  Ids
    are unique; a text that is there under two ids is found under both.

    A frequent substring is the rarest of a query only if all of the query is frequent; its rows
    then meet the few queries that share it, and Spark may split them, as one side has a row a query.
    """
    if stored is not None:
        asked = _asked(queries)
        listed = stored.join(_wanted(asked, STORED).select("gram").distinct(), "gram", "left_semi")
        return _checked(_candidates(asked, listed, STORED), texts.select("id", "text"), "id")
    return find_bodies(queries, texts).join(texts.select("id", "text"), "text").select("query", "id", "exact")


def best(found: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """``found`` (query, order columns, ...) with ``rank`` up to ``limit`` by query, and ``complete``:
    whether no match of the query is left out."""
    place = Window.partitionBy("query").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= limit)
    totals = found.groupBy("query").agg((F.count("*") <= limit).alias("complete"))
    return ranked.join(totals, "query")
