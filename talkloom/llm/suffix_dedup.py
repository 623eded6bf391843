"""Repeated byte strings by blockwise suffix sorting with a difference cover.

A suffix counts by its first ``length`` bytes.  It belongs to the bucket of the least hash
among the grams of those bytes (its anchor), so equal ones share a bucket, and neighbouring
suffixes mostly share an anchor: text goes to buckets in stretches, not byte by byte.

1. All suffixes of all texts are dealt into runs of one anchor.  Anchors that occur once hold
   no repeats; runs with equal content count as one stretch that occurs so many times.
2. The distinct stretches are sorted one bucket at a time (:func:`repeated_starts`).  Ranks of a
   difference cover modulo 31, computed to a depth just short of ``length``, settle the long
   ties, so memory is a few arrays of the bucket's size.
3. An anchor with more distinct stretches than a bucket should hold (a passage in very many
   documents, at its edges) is dealt again by the anchors of another hash function.  What even
   those leave together is settled suffix by suffix, by digests counted by Spark, so that no
   bucket grows with the number of documents that share a passage.  Long stretches (periodic text
   is one run, whatever its length) are cut into parts first, and equal parts count as one.
4. What was found of a stretch goes to the blocks that hold it, once for each block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import SideFiles, in_blocks, pieces, scan_texts, write_side_files, written

#: A perfect difference set: every difference modulo 31 occurs exactly once.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
HEAD, TAIL = 32, 64
_CHUNK = 1 << 19


@dataclass(frozen=True)
class DedupConfig:
    """``length``: bytes of a repeat, at least 160.  ``most``: distinct stretches of one anchor
    that a bucket may hold.  ``bucket_bytes``: text of a bucket, about."""

    length: int = 400
    most: int = 2048
    bucket_bytes: int = 2 << 20

    def __post_init__(self):
        if self.length < 160:
            raise ValueError("a repeat must have 160 bytes at least")

    @property
    def gram(self) -> int:
        return self.length * 8 // 25

    @property
    def part(self) -> int:
        """Suffixes of a stretch that are sorted as one; only periodic text has longer runs."""
        return self.length * 4


# -- sorting within a bucket ----------------------------------------------------------------


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Order-preserving dense ranks of pairs."""
    codes = first * (int(second.max(initial=0)) + 1) + second
    return np.unique(codes, return_inverse=True)[1].astype(np.int64)


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[: len(values) - by] = values[by:] if by < len(values) else 0
    return out


def _common_offsets() -> np.ndarray:
    """For residues r and s the least k with r + k and s + k both in the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    table = np.full((MODULUS, MODULUS), -1)
    for r in range(MODULUS):
        for s in range(MODULUS):
            table[r, s] = next(k for k in range(MODULUS) if inside[(r + k) % MODULUS] and inside[(s + k) % MODULUS])
    return table


def cover_ranks(by_16: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the cover's suffixes by their first ``depth`` bytes, a multiple of 31.

    Depths double along the cover: position p and p + 31 have the same residue.
    """
    size = len(COVER)
    rows = -(-len(by_16) // MODULUS)
    places = (np.arange(rows)[:, None] * MODULUS + np.array(COVER)).ravel()
    padded = np.concatenate([by_16, np.zeros(rows * MODULUS + MODULUS - len(by_16), np.int64)])
    ranks, reach = _ranks(padded[places], padded[places + 15]), MODULUS
    while reach < depth:
        step = min(reach, depth - reach)
        ranks = _ranks(ranks, _ahead(ranks, step // MODULUS * size))
        reach += step
    return ranks


def repeated_starts(stretches: list[bytes], length: int) -> list[np.ndarray]:
    """For each stretch and each of its suffixes of ``length`` bytes or more: does its prefix of
    ``length`` bytes start anywhere else in these stretches?"""
    sizes = np.array([len(s) for s in stretches], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(stretches), np.uint8)
    counts = np.maximum(0, sizes - length + 1)
    starts = np.repeat(begins[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    found = np.zeros(len(data), bool)
    if len(starts) > 1:
        words = np.zeros(len(data), np.uint64)
        for j in range(8):
            words |= _ahead(data, j).astype(np.uint64) << np.uint64(8 * (7 - j))
        ranks = np.unique(words, return_inverse=True)[1].astype(np.int64)
        by_16 = _ranks(ranks, _ahead(ranks, 8))
        by_32 = _ranks(by_16, _ahead(by_16, 16))
        by_64 = _ranks(by_32, _ahead(by_32, 32))
        # head, tail and cover ranks together span the prefix, and nothing beyond it
        depth = (length - MODULUS + 1) // MODULUS * MODULUS
        ranks = cover_ranks(by_16, depth)
        del by_16, words
        order = np.zeros(MODULUS, np.int64)
        order[list(COVER)] = np.arange(len(COVER))
        common = _common_offsets()

        def rank_at(at):
            return ranks[at // MODULUS * len(COVER) + order[at % MODULUS]]

        group = _ranks(by_32[starts], by_64[starts + length - TAIL])
        tied = np.argsort(group, kind="stable")
        place, group = starts[tied], group[tied]
        while len(place):
            lead = np.concatenate([[True], group[1:] != group[:-1]])
            member = np.cumsum(lead) - 1
            leader = place[lead][member]
            k = common[place % MODULUS, leader % MODULUS]
            equal = rank_at(place + k) == rank_at(leader + k)
            several = np.bincount(member, equal) > 1
            found[place[equal & several[member]]] = True
            place, group = place[~equal], group[~equal]
    return [found[b : b + n] for b, n in zip(begins[:-1].tolist(), counts.tolist(), strict=True)]


# -- anchors --------------------------------------------------------------------------------

_TABLE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Runs of suffixes with one anchor, for texts of any length."""

    def __init__(self, config: DedupConfig, turn: int = 0):
        """``turn``: which of two hash functions chooses the anchors."""
        self.length, self.gram, base = config.length, config.gram, _BASES[turn]
        self.window = self.length - self.gram + 1
        size = 2 * _CHUNK + 4 * self.length
        self.powers, self.inverse = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)

    def _least(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window of grams the place of its least hash (leftmost), and all hashes."""
        n = len(data)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * self.powers[:n])])
        h = (total[self.gram :] - total[: -self.gram]) * self.inverse[: n - self.gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        w, bits = self.window, np.uint64(21)
        keys = h >> bits << bits | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(keys) // w)
        grid = np.full(rows * w, np.uint64((1 << 64) - 1))
        grid[: len(keys)] = keys
        grid = grid.reshape(rows, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(keys) - w + 1
        least = np.minimum(behind[:count], ahead[w - 1 : w - 1 + count])
        return (least & np.uint64((1 << 21) - 1)).astype(np.int64), h

    def runs(self, texts: list[bytes]):
        """(text index, first suffix, suffixes, anchor, content digest, whether the anchor occurs
        more than once in the run) as lists, in pieces."""
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for at in range(0, max(0, len(text) - self.length + 1), _CHUNK):
                piece = text[at : at + _CHUNK + self.length - 1]
                if len(piece) < self.length:
                    continue
                held.append((i, at, piece))
                size += len(piece)
                if size >= _CHUNK:
                    yield self._runs(held)
                    held, size = [], 0
        if held:
            yield self._runs(held)

    def _runs(self, held):
        joined = b"".join(p for _, _, p in held)
        least, hashes = self._least(np.frombuffer(joined, np.uint8))
        sizes = np.array([len(p) for _, _, p in held])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        counts = sizes - self.length + 1
        owner = np.repeat(np.arange(len(held)), counts)
        starts = np.repeat(begins - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        anchor = least[starts]
        values = hashes[anchor].view(np.int64)
        same = owner[1:] == owner[:-1]
        # where the next anchor has the same hash (periodic text) the run goes on
        new = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | ~same]))
        moved = np.concatenate([[False], (anchor[1:] != anchor[:-1]) & same])
        moved[new] = False
        several = np.add.reduceat(moved.astype(np.int64), new) > 0 if len(new) else np.zeros(0, bool)
        number = np.diff(np.append(new, len(starts)))
        first, owner = starts[new], owner[new]
        ends = first + number + self.length - 1
        digest = xxhash.xxh3_128_digest
        content = [digest(joined[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
        texts, offsets = (np.array([h[j] for h in held], dtype=np.int64) for j in (0, 1))
        return texts[owner], first - begins[owner] + offsets[owner], number, values[new], content, several


def anchor_runs(blocks: DataFrame, config: DedupConfig) -> DataFrame:
    """``(block, rid, anchor, content, first, number, several)`` for every run of every text."""
    import pyarrow as pa

    def make():
        anchors = Anchors(config)

        def work(kept, texts):
            data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            for text, first, number, anchor, content, several in anchors.runs(data):
                rows = pa.array(text)
                yield kept[0].take(rows), kept[1].take(rows), pa.array(anchor), pa.array(content, pa.binary()), pa.array(first.astype(np.int32)), pa.array(number.astype(np.int32)), pa.array(several)

        return work

    fields = [("block", "int"), ("rid", "bigint"), ("anchor", "bigint"), ("content", "binary"), ("first", "int"), ("number", "int"), ("several", "boolean")]
    return scan_texts(blocks, "text", ["block", "rid"], make, fields)


_STRETCH = [("anchor", "bigint"), ("content", "binary"), ("n", "bigint"), ("kinds", "bigint")]


def fetch_stretches(blocks: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of ``wanted`` runs (block, rid, first, number, anchor, content, n, kinds):
    ``(anchor, content, n, kinds, bytes)``."""
    names = ["first", "number", *(name for name, _ in _STRETCH)]
    folder = write_side_files(wanted.select("block", "rid", *names), "wanted")

    def make():
        state = {"block": None, "rows": {}}

        def work(kept, texts):
            out = []
            for block, rid, text in zip(kept[0].to_pylist(), kept[1].to_pylist(), texts, strict=True):
                if block != state["block"]:
                    state["block"], state["rows"] = block, _by_row(folder.read(block, ["rid", *names]))
                own = state["rows"].get(rid)
                if own:
                    data = text.encode("utf-8", "surrogatepass")
                    out += [(*more, data[a : a + n + length - 1]) for a, n, *more in own]
            for i in range(0, len(out), 20_000):
                yield tuple(zip(*out[i : i + 20_000], strict=True))

        return work

    return scan_texts(blocks, "text", ["block", "rid"], make, [*_STRETCH, ("bytes", "binary")])


def _by_row(table) -> dict[int, list[tuple]]:
    rows: dict[int, list[tuple]] = {}
    if table is not None:
        for rid, *rest in zip(*(c.to_pylist() for c in table.columns), strict=True):
            rows.setdefault(rid, []).append(tuple(rest))
    return rows


def _spans(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()


_FOUND = "anchor bigint, content binary, start int, number int"


def sort_buckets(stretches: DataFrame, buckets: int, length: int) -> DataFrame:
    """``(anchor, content, start, number)``: runs of repeated suffixes in ``stretches`` (anchor,
    content, n, base, bucket key, bytes), where ``base`` is the stretch's place in its content."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        flags = repeated_starts(rows["bytes"].tolist(), length)
        out = []
        for anchor, content, n, base, own in zip(rows["anchor"], rows["content"], rows["n"], rows["base"], flags, strict=True):
            own |= n > 1
            out += [(anchor, content, base + a, size) for a, size in zip(*_spans(own), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "content", "start", "number"])

    grouped = stretches.groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    return grouped.applyInPandas(settle, _FOUND)


def deal_again(stretches: DataFrame, config: DedupConfig) -> DataFrame:
    """Stretches cut by the anchors of the second hash function; ``key``: both anchors."""
    import pyarrow as pa

    names = ["anchor", "content", "n", "base", "key", "bytes"]

    def cut(batches):
        anchors = Anchors(config, turn=1)
        for batch in pieces(batches):
            given, own, n, data = (batch.column(i).to_pylist() for i in range(4))
            for text, first, number, anchor, _, _ in anchors.runs(data):
                rows, ends = text.tolist(), (first + number + config.length - 1).tolist()
                columns = [
                    pa.array([given[r] for r in rows], pa.int64()), pa.array([own[r] for r in rows], pa.binary()), pa.array([n[r] for r in rows], pa.int64()), pa.array(first.astype(np.int32)),
                    pa.array([xxhash.xxh3_64_intdigest(f"{given[r]} {a}") - (1 << 63) for r, a in zip(rows, anchor.tolist(), strict=True)], pa.int64()),
                    pa.array([data[r][a:b] for r, a, b in zip(rows, first.tolist(), ends, strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return stretches.select("anchor", "content", "n", "bytes").mapInArrow(cut, "anchor bigint, content binary, n bigint, base int, key bigint, bytes binary")


def count_suffixes(stretches: DataFrame, length: int) -> DataFrame:
    """The same as :func:`sort_buckets` for what both anchors leave together: one digest for each
    suffix, counted."""
    import pyarrow as pa

    names = ["anchor", "content", "start", "n", "suffix"]

    def cut(batches):
        digest = xxhash.xxh3_128_digest
        for batch in pieces(batches):
            for anchor, content, n, base, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = len(data) - length + 1
                columns = [
                    pa.array([anchor] * size, pa.int64()), pa.array([content] * size, pa.binary()), pa.array(range(base, base + size), pa.int32()),
                    pa.array([n] * size, pa.int64()), pa.array([digest(data[i : i + length]) for i in range(size)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = stretches.select("anchor", "content", "n", "base", "bytes").mapInArrow(cut, "anchor bigint, content binary, start int, n bigint, suffix binary")
    suffixes = written(rows, "suffixes")
    several = suffixes.groupBy("suffix").agg(F.sum("n").alias("total")).filter("total > 1").select("suffix")
    return suffixes.join(several, "suffix", "left_semi").select("anchor", "content", "start", F.lit(1).alias("number"))


def in_parts(stretches: DataFrame, config: DedupConfig) -> tuple[DataFrame, DataFrame | None]:
    """``stretches`` with the long ones cut into parts, each distinct part of an anchor as a content of
    its own, and the places of the parts: ``(anchor, part, content, base)``, None if none is long."""
    import pyarrow as pa

    length, size = config.length, config.part
    is_long = F.octet_length("bytes") >= size + length
    long = stretches.filter(is_long)
    if not long.limit(1).count():
        return stretches, None
    names = ["anchor", "content", "n", "kinds", "part", "base", "bytes"]

    def cut(batches):
        digest = xxhash.xxh3_128_digest
        for batch in pieces(batches):
            for anchor, content, n, kinds, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bases = range(0, len(data) - length + 1, size)
                own, count = [data[b : b + size + length - 1] for b in bases], len(bases)
                columns = [
                    pa.array([anchor] * count, pa.int64()), pa.array([content] * count, pa.binary()), pa.array([n] * count, pa.int64()), pa.array([kinds] * count, pa.int64()),
                    pa.array([digest(x) for x in own], pa.binary()), pa.array(bases, pa.int32()), pa.array(own, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = long.select("anchor", "content", "n", "kinds", "bytes").mapInArrow(cut, "anchor bigint, content binary, n bigint, kinds bigint, part binary, base int, bytes binary")
    parts = written(rows, "parts")
    distinct = parts.groupBy("anchor", F.col("part").alias("content")).agg(F.sum("n").alias("n"), F.max("kinds").alias("kinds"), F.min("bytes").alias("bytes"))
    distinct = written(distinct, "distinct-parts")
    # all of an anchor go the same way, so its parts count in place of the stretches they are of
    change = distinct.select("anchor", F.lit(1).alias("one")).unionByName(parts.filter("base = 0").select("anchor", F.lit(-1).alias("one")))
    more = written(change.groupBy("anchor").agg(F.sum("one").alias("more")), "more")
    both = stretches.filter(~is_long).unionByName(distinct).join(more, "anchor", "left")
    both = both.withColumn("kinds", F.col("kinds") + F.coalesce("more", F.lit(0))).drop("more")
    return written(both, "in-parts"), parts.select("anchor", "part", "content", "base")


def repeated_parts(stretches: DataFrame, config: DedupConfig) -> DataFrame:
    """``(anchor, content, start, number)`` of all distinct stretches."""

    def in_order(rows: DataFrame) -> DataFrame:
        size = rows.agg(F.sum(F.octet_length("bytes")).cast("bigint")).first()[0] or 0
        return sort_buckets(rows, max(1, -(-size // config.bucket_bytes)), config.length)

    out = in_order(stretches.filter(F.col("kinds") <= config.most).withColumn("key", F.col("anchor")).withColumn("base", F.lit(0)))
    hot = stretches.filter(F.col("kinds") > config.most)
    if hot.limit(1).count():
        again = written(deal_again(hot, config), "again")
        sizes = written(again.groupBy("key").count().filter(F.col("count") > config.most).select("key"), "sizes")
        out = out.unionByName(in_order(again.join(sizes, "key", "left_anti")))
        if sizes.limit(1).count():
            out = out.unionByName(count_suffixes(again.join(sizes, "key", "left_semi"), config.length))
    return out


def repeated_runs(blocks: DataFrame, config: DedupConfig) -> tuple[SideFiles, SideFiles]:
    """For each block its runs of anchors that recur ``(rid, first, anchor, content)``, and what
    repeats of their contents ``(anchor, content, start, number)``, the last two arrays."""
    runs = written(anchor_runs(blocks, config), "runs")
    # written by itself, so that the join below is between plain exchanges and a hot anchor can be split
    anchors = runs.groupBy("anchor").agg(F.count("*").alias("uses"), F.max("several").alias("several")).filter("uses > 1 OR several")
    shared = written(runs.join(written(anchors.select("anchor"), "anchors"), "anchor", "left_semi"), "shared")
    row = F.struct("block", "rid", "first", "number")
    held = [F.count("*").alias("n"), F.min(row).alias("row"), F.collect_set("block").alias("blocks")]  # a number for each block at most
    contents = written(shared.groupBy("anchor", "content").agg(*held), "contents")
    kinds = contents.groupBy("anchor").agg(F.count("*").alias("kinds"))
    stretches = written(fetch_stretches(blocks, contents.join(kinds, "anchor").select("anchor", "content", "n", "kinds", "row.*"), config.length), "stretches")
    short, places = in_parts(stretches, config)
    found = repeated_parts(short, config)
    if places is not None:
        found = written(found, "found-parts")
        again = found.withColumnRenamed("content", "part").join(places, ["anchor", "part"])
        found = found.unionByName(again.select("anchor", "content", (F.col("start") + F.col("base")).alias("start"), "number"))
    found = found.groupBy("anchor", "content").agg(F.collect_list(F.struct("start", "number")).alias("parts"))
    both = written(found, "found").join(contents.select("anchor", "content", "blocks"), ["anchor", "content"])
    # one row for each content of a block, whatever the number of its parts
    answers = both.select(F.explode("blocks").alias("block"), "anchor", "content", "parts.start", "parts.number")
    return write_side_files(shared.select("block", "rid", "first", "anchor", "content"), "runs-of-block"), write_side_files(answers, "repeats")


def _repeats_of(block: int, runs: SideFiles, repeats: SideFiles) -> dict[int, list[tuple[int, int]]]:
    """The block's repeated suffixes: (first, number) of each row."""
    parts: dict[tuple, list[tuple[int, int]]] = {}
    found = repeats.read(block, ["anchor", "content", "start", "number"])
    for anchor, content, start, number in zip(*(c.to_pylist() for c in found.columns), strict=True) if found is not None else ():
        parts[anchor, content] = list(zip(start, number, strict=True))
    rows: dict[int, list[tuple[int, int]]] = {}
    own = runs.read(block, ["rid", "first", "anchor", "content"]) if parts else None
    for rid, first, anchor, content in zip(*(c.to_pylist() for c in own.columns), strict=True) if own is not None else ():
        if some := parts.get((anchor, content)):
            rows.setdefault(rid, []).extend((first + start, number) for start, number in some)
    return rows


def remove_repeats(docs: DataFrame, config: DedupConfig | None = None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", as_text: bool = False) -> DataFrame:
    """Every row with the bytes removed that a repeated string of ``length`` bytes covers.

    ``(*keep, n_bytes, n_removed, n_spans, starts, ends, kept)``: ``kept`` (binary) is the text's
    UTF-8 without the removed spans ``[start, end)``; with ``as_text`` a string, from which
    characters that a span's edge cut through are gone too.  All occurrences go, the first as well;
    strings overlap, and a text may repeat itself.  Null is the empty text; texts shorter than
    ``length`` stay whole; texts of any length are cut into pieces that overlap, so that nothing is
    missed; equal rows remove each other; an id may be null or shared; other columns are not read;
    an empty table gives an empty result.
    """
    config = config or DedupConfig()
    length = config.length
    names = [f"keep_{i}" for i in range(len(keep))]
    blocks = in_blocks(docs, [*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.col(text_col).cast("string").alias("text")], "documents")
    runs, repeats = repeated_runs(blocks, config)

    def make():
        state = {"block": None, "rows": {}}

        def one(block, rid, text):
            if block != state["block"]:
                state["block"], state["rows"] = block, _repeats_of(block, runs, repeats)
            data = (text or "").encode("utf-8", "surrogatepass")
            spans: list[list[int]] = []
            for first, number in sorted(state["rows"].get(rid, ())):
                end = first + number + length - 1
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(end, spans[-1][1])
                else:
                    spans.append([first, end])
            edges = [0, *(x for s in spans for x in s), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            return len(data), len(data) - len(kept), len(spans), [a for a, _ in spans], [b for _, b in spans], kept.decode("utf-8", "ignore") if as_text else kept

        def work(kept, texts):
            rows = [one(b, r, t) for b, r, t in zip(kept[-2].to_pylist(), kept[-1].to_pylist(), texts, strict=True)]
            if rows:
                yield *kept[:-2], *zip(*rows, strict=True)

        return work

    made = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("starts", "array<int>"), ("ends", "array<int>"), ("kept", "string" if as_text else "binary")]
    fields = [*((n, docs.schema[c].dataType.simpleString()) for c, n in zip(keep, names, strict=True)), *made]
    return scan_texts(blocks, "text", [*names, "block", "rid"], make, fields).withColumnsRenamed(dict(zip(names, keep, strict=True)))
