"""Ranked lexical search with per-term geometric blocking.

Documents are indexed in shards, a bounded number of documents and postings each, so no posting
list is ever gathered whole.  In a shard the posting list of each term is clustered by the
similarity of its documents; a block keeps, for every term, the largest weight that any of its
documents has (its coordinatewise maximum).  A query opens the lists of its terms from the rarest
on, and of each list only the blocks whose summary allows a score as high as the threshold: the
bound is exact, so no document is lost.  A document counts in the first list that has it; later
lists are bounded by their own and commoner terms alone, and a summary holds no others.

A few shards are searched first; the scores found there are thresholds for all others.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.llm.common import drop, new_path, pieces, written
from talkloom.llm.decontaminate import words_of

#: Documents and postings of a shard.
DOCS, POSTINGS = 2048, 1 << 19
#: Documents of a block, about; twice as many at most.
BLOCK = 64
#: Dimensions of the sketches that clustering compares.
SKETCH = 32
#: Blocks of a list that are opened before the threshold is looked at again.
STEP = 4
#: Terms of a block of queries, about; its vocabulary is sent to every task.
TERMS = 100_000
#: One shard in so many is searched first.
FIRST = 16


def impact(tf: np.ndarray, length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A term's share of a document's score, before its weight; all integers, rounded down."""
    m = 75 + 25 * length * documents // max(terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + sizes[i] - 1`` of all i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


# -- documents as vectors ------------------------------------------------------------------------

_VECTORS = [("n_docs", "bigint"), ("n_terms", "bigint"), ("lengths", "binary"), ("sizes", "binary"), ("terms", "binary"), ("tfs", "binary"), ("df_terms", "array<int>"), ("dfs", "array<int>")]


def vectors(docs: DataFrame, vocabulary: dict[bytes, int], text: str, key: str) -> DataFrame:
    """One row for each shard: keys, lengths, and the terms of the vocabulary in each document with
    their occurrences; how many documents and terms there are at all; document frequencies."""

    def run(batches):
        def shard(keys, lengths, sizes, found, n_docs, n_terms):
            terms = np.array([t for f in found for t in f], np.int32)
            tfs = np.array([n for f in found for n in f.values()], np.int64)
            present, df = np.unique(terms, return_counts=True)
            kept = pa.concat_arrays(keys) if keys else pa.array([], key_type)
            arrays = [
                pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept), pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()),
                *(pa.array([x.tobytes()], pa.binary()) for x in (np.array(lengths, np.int64), np.array(sizes, np.int32), terms, tfs)),
                pa.array([present], pa.list_(pa.int32())), pa.array([df.astype(np.int32)], pa.list_(pa.int32())),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["keys", *(n for n, _ in _VECTORS)])

        look, key_type, state = vocabulary.get, None, [[], [], [], [], 0, 0]
        for batch in pieces(batches):
            key_type, chosen = batch.column(0).type, []
            for i, body in enumerate(batch.column(1).to_pylist()):
                words = words_of(body)
                if words:
                    state[4] += 1
                    state[5] += len(words)
                    found = Counter(map(look, words))
                    found.pop(None, None)
                    if found:
                        chosen.append(i)
                        state[1].append(len(words))
                        state[2].append(len(found))
                        state[3].append(found)
                if len(state[1]) >= DOCS or (len(state[1]) % 256 == 255 and sum(state[2]) >= POSTINGS):
                    state[0].append(batch.column(0).take(pa.array(chosen, pa.int64())))
                    yield shard(*state)
                    state, chosen = [[], [], [], [], 0, 0], []
            if chosen:
                state[0].append(batch.column(0).take(pa.array(chosen, pa.int64())))
        if state[4]:
            yield shard(*state)

    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("keys", T.ArrayType(kind)), *(T.StructField(n, T._parse_datatype_string(t)) for n, t in _VECTORS)])
    return docs.select(docs[key], docs[text].cast("string").cast("binary").alias("__text")).mapInArrow(run, schema)


# -- the index -----------------------------------------------------------------------------------

#: Arrays of a shard's index, as stored: compressed one by one, so that Spark moves little and a task
#: unpacks one shard at a time.  Terms are ranks, the rarest first; terms that ascend are stored as steps.
_ARRAYS = {
    "doc_starts": np.int64, "doc_terms": np.int32, "doc_impacts": np.int32,  # documents: their terms in order
    "lists": np.int32, "list_most": np.int32, "list_blocks": np.int64,  # terms that have a list here, their largest impact, their first block
    "block_members": np.int64, "members": np.int16,  # a block's first member; members by block
    "block_summary": np.int64, "summary_terms": np.int32, "summary_impacts": np.int32,
}
_STEPS = {"doc_terms", "lists", "summary_terms"}


def packed(name: str, values: np.ndarray) -> bytes:
    values = values.astype(_ARRAYS[name])
    return zstandard.ZstdCompressor(level=1).compress(np.diff(values, prepend=values.dtype.type(0)) if name in _STEPS else values)


def unpacked(name: str, stored: pa.Buffer) -> np.ndarray:
    values = np.frombuffer(zstandard.ZstdDecompressor().decompress(stored), _ARRAYS[name])
    return np.cumsum(values, dtype=values.dtype) if name in _STEPS else values


def clusters(sketches: np.ndarray, size: int) -> np.ndarray:
    """A block number for each row: the row of an evenly spaced sample that it is most similar to.
    Clusters of over twice ``size`` rows are cut."""
    count = -(-len(sketches) // size)
    if count == 1:
        return np.zeros(len(sketches), np.int64)
    centres = sketches[np.arange(count) * len(sketches) // count]
    nearest = (sketches @ centres.T).argmax(axis=1)
    order = np.argsort(nearest, kind="stable")
    sizes = np.bincount(nearest, minlength=count)
    within = np.empty(len(nearest), np.int64)
    within[order] = ragged(np.zeros(count, np.int64), sizes)
    return np.unique(nearest * len(nearest) + within // (2 * size), return_inverse=True)[1]


def build_shard(starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray, block: int) -> dict[str, np.ndarray]:
    """The index of one shard from its documents' terms (ranks, ascending in each document)."""
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    mixed = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    place, sign = (mixed >> np.uint64(40)) % np.uint64(SKETCH), np.where(mixed >> np.uint64(63), 1.0, -1.0)
    sketch = np.bincount(doc * SKETCH + place.astype(np.int64), weights=sign * impacts * weights[terms], minlength=len(sizes) * SKETCH).reshape(-1, SKETCH)
    sketch = (sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    present, local = np.unique(terms, return_inverse=True)
    by_term = np.argsort(local, kind="stable")
    first = np.searchsorted(local[by_term], np.arange(len(present) + 1))
    ends, width, small = starts[1:][doc], len(present), impacts.astype(np.int32)
    blocks, members, sums, most = [0], [], [], np.maximum.reduceat(impacts[by_term], first[:-1]) if width else np.zeros(0)
    sizes_of_blocks, sizes_of_sums = [], []
    for t in range(width):
        own = by_term[first[t] : first[t + 1]]
        group = clusters(sketch[doc[own]], block)
        own = own[np.argsort(group, kind="stable")]
        group = np.sort(group)
        count = group[-1] + 1
        # terms from this one on of each member: the rarer ones are bounded in their own lists
        tail = ends[own] - own
        at = ragged(own, tail)
        table = np.zeros(count * (width - t), np.int32)
        np.maximum.at(table, np.repeat(group, tail) * (width - t) + local[at] - t, small[at])
        filled = np.flatnonzero(table)
        sums.append(((filled % (width - t) + t).astype(np.int32), table[filled]))
        sizes_of_sums.append(np.bincount(filled // (width - t), minlength=count))
        sizes_of_blocks.append(np.bincount(group))
        members.append(doc[own].astype(np.int16))
        blocks.append(blocks[-1] + count)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    begin = lambda parts: np.concatenate([[0], np.cumsum(join(parts))])
    return {
        "doc_starts": starts, "doc_terms": local, "doc_impacts": impacts, "lists": present, "list_most": most, "list_blocks": np.array(blocks),
        "block_members": begin(sizes_of_blocks), "members": join(members), "block_summary": begin(sizes_of_sums),
        "summary_terms": join([s[0] for s in sums]), "summary_impacts": join([s[1] for s in sums]),
    }


def index_shards(forward: DataFrame, rank: np.ndarray, weights: np.ndarray, documents: int, terms: int) -> DataFrame:
    """``vectors`` -> one row for each shard with its keys and the arrays of its index."""
    names, block = ["keys", *_ARRAYS], BLOCK

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                read = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: B023, E731
                sizes = read("sizes", np.int32)
                if len(sizes):
                    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                    own = rank[read("terms", np.int32)]
                    order = np.lexsort((own, np.repeat(np.arange(len(sizes)), sizes)))
                    value = impact(read("tfs", np.int64), np.repeat(read("lengths", np.int64), sizes), documents, terms)
                    made = build_shard(starts, own[order], value[order], weights, block)
                    arrays = [pa.array([packed(n, made.pop(n))], pa.binary()) for n in _ARRAYS]
                    yield pa.RecordBatch.from_arrays([batch.column("keys").slice(i, 1), *arrays], names)
                    del arrays  # one shard at a time

    schema = T.StructType([forward.schema["keys"], *(T.StructField(n, T.BinaryType()) for n in _ARRAYS)])
    return forward.mapInArrow(run, schema)


class Shard:
    """A shard's index as read back."""

    def __init__(self, arrays: dict[str, pa.Buffer], keys: pa.Array):
        for name in _ARRAYS:
            setattr(self, name, unpacked(name, arrays[name]))
        order = np.empty(len(keys), np.int64)
        order[pc.sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
        self.key_rank, self.looked = order, np.zeros(len(self.lists), np.int64)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        sizes = self.doc_starts[docs + 1] - self.doc_starts[docs]
        at = ragged(self.doc_starts[docs], sizes)
        return np.add.reduceat(self.looked[self.doc_terms[at]] * self.doc_impacts[at], np.cumsum(sizes) - sizes)

    def search(self, terms: np.ndarray, weights: np.ndarray, most: int, floor: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
        """The ``most`` best documents of a query (terms as ranks, the rarest first), none below
        ``floor``: (documents, scores, (blocks met, blocks opened))."""
        place = np.searchsorted(self.lists, terms)
        have = (place < len(self.lists)) & (self.lists[np.minimum(place, len(self.lists) - 1)] == terms)
        place, weights = place[have], weights[have]
        self.looked[place] = weights
        ahead = np.cumsum((weights * self.list_most[place])[::-1])[::-1]  # what documents can score that have none of the terms so far
        seen, docs, scores = np.zeros(len(self.doc_starts) - 1, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        met = opened = 0
        for i, term in enumerate(place):
            if ahead[i] < max(floor, 1):
                break
            blocks = np.arange(self.list_blocks[term], self.list_blocks[term + 1])
            begin = self.block_summary[blocks]
            part = slice(begin[0], self.block_summary[blocks[-1] + 1])
            bounds = np.add.reduceat(self.looked[self.summary_terms[part]] * self.summary_impacts[part], begin - begin[0])
            met += len(blocks)
            order = np.argsort(-bounds, kind="stable")
            blocks, bounds = blocks[order], bounds[order]
            for j in range(0, len(blocks), STEP):
                go = blocks[j : j + STEP][bounds[j : j + STEP] >= max(floor, 1)]
                if not len(go):
                    break
                opened += len(go)
                sizes = self.block_members[go + 1] - self.block_members[go]
                new = self.members[ragged(self.block_members[go], sizes)].astype(np.int64)
                new = new[~seen[new]]
                if len(new):
                    seen[new] = True
                    got = self.scores(new)
                    docs, scores = np.concatenate([docs, new]), np.concatenate([scores, got])
                    keep = scores >= max(floor, 1)
                    docs, scores = docs[keep], scores[keep]
                    if len(docs) >= most:
                        floor = max(floor, int(np.partition(scores, -most)[-most]))
        self.looked[place] = 0
        best = np.lexsort((self.key_rank[docs], -scores))[:most]
        return docs[best], scores[best], (met, opened)


def search_shards(index: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], most: int, floors: dict[int, int]) -> DataFrame:
    """The best documents of each shard for each query (number, terms, weights), with the blocks
    that the shard had met and opened for the query on each of them."""
    names = ["query", "key", "score", "met", "opened"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = batch.column("keys")[i].values
                shard = Shard({n: batch.column(n)[i].as_buffer() for n in _ARRAYS}, keys)
                found = [(q, *shard.search(terms, weights, most, floors.get(q, 0))) for q, terms, weights in queries]
                sizes = [len(f[1]) for f in found]
                each = lambda values: pa.array(np.repeat(np.array(values, np.int64), sizes))  # noqa: B023, E731
                docs, scores = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (1, 2))
                yield pa.RecordBatch.from_arrays([each([f[0] for f in found]), keys.take(pa.array(docs)), pa.array(scores), each([f[3][0] for f in found]), each([f[3][1] for f in found])], names)

    kind = index.schema["keys"].dataType.elementType
    fields = [("query", T.LongType()), ("key", kind), ("score", T.LongType()), ("met", T.LongType()), ("opened", T.LongType())]
    return index.mapInArrow(run, T.StructType([T.StructField(n, t) for n, t in fields]))


def best_of(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


@dataclass(frozen=True)
class LexicalIndex:
    """Shards of an index in the shared folder, and what queries need to know of its vocabulary."""

    shards: DataFrame
    vocabulary: dict[bytes, int]
    rank: np.ndarray
    weights: np.ndarray  # by rank
    path: str

    def drop(self) -> None:
        drop(self.shards.sparkSession, self.path)


def build_index(docs: DataFrame, terms: list[bytes], text: str = "text", key: str = "doc_id") -> LexicalIndex:
    """Index all documents for queries over ``terms``, a bounded list (it is sent to every task)."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(terms)}
    forward_path, path = new_path(spark, "vectors"), new_path(spark, "lexical_index")
    forward = vectors(docs, vocabulary, text, key)
    forward.write.option("compression", "zstd").parquet(forward_path)
    forward = spark.read.schema(forward.schema).parquet(forward_path)
    documents, length = (x or 0 for x in forward.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    counts = forward.select(F.explode(F.arrays_zip("df_terms", "dfs")).alias("t")).groupBy("t.df_terms").agg(F.sum("t.dfs").alias("df"))
    df = np.zeros(len(terms), np.int64)
    for row in counts.toLocalIterator():  # a row for each term of the vocabulary at most
        df[row[0]] = row[1]
    plain = np.array([weight(int(x), documents) for x in df], np.int64)
    order = np.lexsort((np.arange(len(df)), df))
    rank = np.empty(len(df), np.int64)
    rank[order] = np.arange(len(df))
    made = index_shards(forward, rank, plain[order], documents, length)
    # a row is a few megabytes: small row groups, so that a task reads a few shards
    made.write.option("compression", "zstd").option("parquet.block.row.count.limit", "2").parquet(path)
    drop(spark, forward_path)
    return LexicalIndex(spark.read.schema(made.schema).parquet(path), vocabulary, rank, plain[order], path)


def search(index: LexicalIndex, queries: list[tuple[int, dict[bytes, int]]], most: int = 20) -> DataFrame:
    """``queries`` (number, occurrences by term), a bounded block of them -> ``(query, key, score,
    met, opened, rank)``, the ``most`` best documents of each; terms outside the index's vocabulary
    count nothing.  ``met`` and ``opened`` are the blocks of the document's own shard."""
    asked = []
    for number, counts in queries:
        known = sorted((int(index.rank[index.vocabulary[t]]), n) for t, n in counts.items() if t in index.vocabulary)
        ranks = np.array([r for r, _ in known], np.int64)
        asked.append((number, ranks, index.weights[ranks] * np.array([n for _, n in known], np.int64)))
    turn = F.pmod(F.xxhash64("lists", "members"), F.lit(FIRST))
    first = written(best_of(search_shards(index.shards.filter(turn == 0), asked, most, {}), most), "first_shards")
    floors = {r["query"]: r["score"] for r in first.filter(F.col("rank") == most).toLocalIterator()}  # one row a query
    rest = search_shards(index.shards.filter(turn != 0), asked, most, floors)
    return best_of(first.drop("rank").unionByName(rest), most)


def rank_documents(docs: DataFrame, items: DataFrame, most: int = 20, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``most`` best documents of each item, ``(item, rank, key, score, met, opened)``; documents
    that share no term with an item, or only terms without weight, are not listed.

    Scores are whole numbers: the sum over the item's terms, repeats included, of the term's weight
    times its impact (:func:`weight`, :func:`impact`).  Equal scores go by ascending key, a null
    key last.  Items go in blocks of about ``TERMS`` terms, each with an index of its own over all
    documents, so that only bounded lists of terms are sent to tasks or held by the driver.

    Null texts have no terms; an item without terms has no rows; repeated items are ranked each by
    itself, and a document that is there twice is listed twice; whole texts count, however long;
    further columns, whatever their names, are not read.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    counted = items.select(items[item].alias("item"), items[item_text].cast("string").cast("binary").alias("text"), F.monotonically_increasing_id().alias("query"))

    def run(batches):
        for batch in pieces(batches):
            found = [Counter(words_of(t)) for t in batch.column(1).to_pylist()]
            arrays = [batch.column(0), batch.column(2), pa.array([list(f) for f in found], pa.list_(pa.binary())), pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "query", "terms", "counts"])

    schema = T.StructType([counted.schema["item"], T.StructField("query", T.LongType()), T.StructField("terms", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    asked = written(counted.mapInArrow(run, schema).filter(F.size("terms") > 0), "queries")
    blocks = 1 + (asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // TERMS
    out = None
    for block in range(blocks):
        own = [(r["query"], dict(zip(map(bytes, r["terms"]), r["counts"], strict=True))) for r in asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toLocalIterator()]
        index = build_index(docs, sorted({t for _, counts in own for t in counts}), text, key)
        found = written(search(index, own, most), "ranked")
        index.drop()
        out = found if out is None else out.unionByName(found)
    return out.join(asked.select("item", "query"), "query").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score", "met", "opened")
