"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is the set of its two-word shingles (one word, if it has but one).  To contain it, a
document must contain every shingle, so the necessary prefix is a single one: the rarest over
all documents.  Documents are read once.  Bit tables of the benchmark's words and shingles, of
bounded size, tell which places of a text can matter; shingles at these places are counted,
windows are joined on their rarest shingle alone, must fit in the document at that place (length
and position), and are then compared word by word, by the 64-bit hashes of their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import pieces, written

#: Bytes that separate words: ASCII other than letters and digits.
_TO_SPACE = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))
#: Bits of a table at most (32 MB); a larger benchmark only lets more places through to the join.
MOST_BITS = 1 << 28
_BUCKET = 32_768  # bits of a piece of a table, as Spark's bitmap functions have them


def words_of(text: str | bytes | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    return data.lower().translate(_TO_SPACE).split()


def pairs_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of two-word shingles from the words' hashes."""
    h = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ second >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h * np.uint64(0x9FB21C651E98DF25)


def hashes_of(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``items`` (item, text) -> ``(item, size, words, shingles)``: the distinct windows of each
    item, as hashes of their words, and the shingles by place."""

    def run(batches):
        for batch in pieces(batches):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes = hashes_of(words_of(text))
                found = {tuple(hashes[i : i + window].tolist()) for i in range(max(1, len(hashes) - window + 1) if len(hashes) else 0)}
                rows = [np.array(w, np.uint64) for w in sorted(found)]
                for i in range(0, len(rows), 5000):
                    part = rows[i : i + 5000]
                    shingles = [pairs_of(w[:-1], w[1:]) if len(w) > 1 else w for w in part]
                    lists = [pa.array([x.view(np.int64) for x in column], pa.list_(pa.int64())) for column in (part, shingles)]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(part), pa.string()), pa.array([len(w) for w in part], pa.int32()), *lists], ["item", "size", "words", "shingles"])

    return items.mapInArrow(run, "item string, size int, words array<bigint>, shingles array<bigint>")


def bit_table(values: DataFrame, count: int) -> np.ndarray:
    """A table with the bits of ``values`` (h) set, 64 for each of ``count`` of them and
    ``MOST_BITS`` at most: what comes to the driver is no more than that."""
    bits = min(MOST_BITS, max(_BUCKET, 1 << (64 * max(1, count) - 1).bit_length()))
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = values.select(F.bitmap_bucket_number(place + 1).alias("bucket"), F.bitmap_bit_position(place + 1).alias("bit"))
    table = np.zeros(bits // 8, np.uint8)
    for bucket, piece in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).collect():
        table[(bucket - 1) * _BUCKET // 8 : bucket * _BUCKET // 8] = np.frombuffer(piece, np.uint8)
    return table


def has_bit(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(table) * 8 - 1)
    return table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0


def document_hits(docs: DataFrame, words: np.ndarray, shingles: np.ndarray, single: bool) -> DataFrame:
    """``docs`` (any columns, the last one ``text``) -> the other columns, ``n_words``, and the
    ``places`` where a shingle of the benchmark may be, ascending, with the shingles there; with
    ``single`` also the places of its words."""
    sent = docs.sparkSession.sparkContext.broadcast((words, shingles))
    kept = docs.schema.fields[:-1]
    names = [*(f.name for f in kept), "n_words", "places", "shingles", "single_places", "single"]

    def run(batches):
        words, shingles = sent.value
        for batch in pieces(batches):
            own: dict[bytes, int] = {}
            take = own.setdefault
            rows = [[take(w, len(own)) for w in words_of(t)] for t in batch.column(batch.num_columns - 1).to_pylist()]
            sizes = np.array([len(r) for r in rows], np.int64)
            flat = np.fromiter((i for r in rows for i in r), np.int32, sizes.sum())
            hashes = hashes_of(list(own))
            known = has_bit(words, hashes)[flat] if len(own) else np.zeros(0, bool)
            begins = np.cumsum(sizes) - sizes
            row = np.repeat(np.arange(len(rows)), sizes)
            at = np.flatnonzero(known[:-1] & known[1:] & (row[:-1] == row[1:]))
            value = pairs_of(hashes[flat[at]], hashes[flat[at + 1]])
            some = has_bit(shingles, value)
            lists = []
            for places, found in ((at[some], value[some]), (np.flatnonzero(known) if single else at[:0], None)):
                found = hashes[flat[places]] if found is None else found
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[places], minlength=len(rows)))]).astype(np.int32))
                lists.append([pa.ListArray.from_arrays(ends, x) for x in (pa.array((places - begins[row[places]]).astype(np.int32)), pa.array(found.view(np.int64)))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes), *lists[0], *lists[1]], names)

    made = ["n_words bigint", "places array<int>", "shingles array<bigint>", "single_places array<int>", "single array<bigint>"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *made])
    return docs.mapInArrow(run, schema)


def merged_spans(hits: DataFrame) -> DataFrame:
    """``hits`` (rid, start, end) -> ``(rid, n_hit, starts, ends)`` of the merged spans."""
    order = Window.partitionBy("rid").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach >= F.col("start"), 0).otherwise(1)
    numbered = hits.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("rid", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    listed = F.array_sort(F.collect_list(F.struct("start", "end")))
    found = spans.groupBy("rid").agg(F.sum(F.col("end") - F.col("start")).cast("bigint").alias("n_hit"), listed.alias("s"))
    return found.select("rid", "n_hit", F.col("s.start").alias("starts"), F.col("s.end").alias("ends"))


def occurrences(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """``(rid, start, end, words)`` of every window that occurs in ``hits`` (rid, n_words, places,
    shingles), for windows of two words or more."""
    seen = hits.select(F.explode(F.array_distinct("shingles")).alias("shingle")).groupBy("shingle").count()
    asked = windows.select("words", "size", "shingles", F.posexplode("shingles").alias("at", "shingle"))
    # a window with a shingle that no document has is nowhere: the inner join leaves it short
    counted = asked.join(seen, "shingle").groupBy("words").agg(
        F.count("*").alias("found"), F.first("size").alias("size"), F.first("shingles").alias("shingles"), F.min(F.struct("count", "shingle", "at")).alias("least")
    )
    anchors = written(counted.filter(F.col("found") == F.col("size") - 1).select("words", "size", "shingles", "least.shingle", "least.at"), "anchors")
    places = hits.select("rid", "n_words", F.explode(F.arrays_zip("places", "shingles")).alias("h")).select("rid", "n_words", F.col("h.places").alias("place"), F.col("h.shingles").alias("shingle"))
    start = F.col("place") - F.col("at")
    fits = places.join(anchors, "shingle").withColumn("start", start).filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
    near = fits.select("rid", "start", "size", "words", F.col("shingles").alias("wanted"))
    at = F.array_position("places", F.col("start")).cast("int")
    whole = (at > 0) & (F.get("places", at + F.col("size") - 3) == F.col("start") + F.col("size") - 2) & (F.slice("shingles", F.greatest(at, F.lit(1)), F.col("size") - 1) == F.col("wanted"))
    both = near.join(hits.select("rid", "places", "shingles"), "rid").filter(at > 0).filter(whole)
    return both.select("rid", "start", (F.col("start") + F.col("size")).alias("end"), "words")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row for each document: its words, merged hit spans [start, end) and matched items.

    ``(*keep (the id, unless given), n_words, n_hit, starts, ends, item_ids)``; item ids as strings,
    sorted.  Null and empty texts have no words and no hits; items without words match nothing; an
    empty benchmark leaves every document clean; whole texts count, however long; repeated rows
    give repeated results, repeated items are one; shingles of equal rarity are taken by hash; columns
    other than those named are not read, whatever their names; an empty table gives an empty result.  The benchmark is joined as a table: what is sent to tasks
    are two bit tables of ``MOST_BITS`` at most, and nothing of it passes through the driver but
    these.
    """
    keep = keep or (id_col,)
    items = benchmark.filter(F.col(item_text_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    windows = written(item_windows(items, window), "windows")
    words, shingles = (windows.select(F.explode(c).alias("h")).distinct() for c in ("words", "shingles"))
    single = bool(windows.filter("size = 1").limit(1).count())
    tables = [bit_table(x, x.count()) for x in (words, shingles)]
    names = [f"keep_{i}" for i in range(len(keep))]
    read = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.monotonically_increasing_id().alias("rid"), F.col(text_col).cast("string").cast("binary").alias("text"))
    hits = written(document_hits(read, *tables, single), "hits")

    longer = windows.filter("size > 1").groupBy("words").agg(F.first("size").alias("size"), F.first("shingles").alias("shingles"))
    found = occurrences(hits.filter(F.size("places") > 0).select("rid", "n_words", "places", "shingles"), longer)
    if single:
        found = found.unionByName(_single_words(hits, windows))
    found = written(found, "found")
    spans = merged_spans(found.select("rid", "start", "end").distinct())
    matched = found.select("rid", "words").distinct().join(windows.select("words", "item").distinct(), "words")
    named = matched.groupBy("rid").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    empty = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    out = hits.select("rid", *names, "n_words").join(spans.join(named, "rid"), "rid", "left")
    return out.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), empty("starts", "int"), empty("ends", "int"), empty("item_ids", "string")
    )


def _single_words(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """The same for items of one word: every place of that word."""
    asked = windows.filter("size = 1").select("words", F.col("words")[0].alias("word")).distinct()
    places = hits.select("rid", F.posexplode("single").alias("at", "word"), "single_places").select("rid", "word", F.get("single_places", F.col("at")).alias("start"))
    return places.join(asked, "word").select("rid", "start", (F.col("start") + 1).alias("end"), "words")
