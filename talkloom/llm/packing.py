"""Pattern packing: non-negative least squares over patterns of a few lengths."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import scan_texts, written
from talkloom.llm.tokens import encoder

Plan = list[tuple[tuple[int, ...], int]]  # lengths of a sequence, and how many such sequences


def patterns_of(size: int) -> np.ndarray:
    """All patterns of one to three lengths that fill ``size`` exactly; absent lengths are 0."""
    rows = [np.array([[0, 0, size]])]
    low = np.arange(1, size // 2 + 1)
    rows.append(np.stack([np.zeros_like(low), low, size - low], 1))
    for a in range(1, size // 3 + 1):
        b = np.arange(a, (size - a) // 2 + 1)
        rows.append(np.stack([np.full_like(b, a), b, size - a - b], 1))
    return np.concatenate(rows).astype(np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - histogram|: accelerated projected gradient.

    A has a column for each pattern with at most three entries, so it is never formed.
    """
    flat, n = patterns.ravel(), len(histogram)
    x = np.zeros(len(patterns))
    scale = float(histogram.max(initial=0)) or 1.0
    target = histogram / scale

    def covered(v):
        out = np.bincount(flat, weights=np.repeat(v, 3), minlength=n)
        out[0] = 0
        return out

    def pulled(r):
        r = r.copy()
        r[0] = 0
        return r[patterns].sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(30):  # largest eigenvalue of A'A
        v = pulled(covered(v))
        v /= np.linalg.norm(v)
    step = 1.0 / (1.05 * np.linalg.norm(pulled(covered(v))))
    y, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * pulled(covered(y) - target))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * scale


def pack_rest(histogram: np.ndarray, size: int) -> Plan:
    """Best fit, longest first, on (length, count) pairs rather than on single pieces."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # free room: pattern: count
    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            free = min((r for r in room if r >= length), default=0)
            if free:
                pattern, n = room[free].popitem()
                if not room[free]:
                    del room[free]
                used = min(n, left)
                if n > used:
                    room[free][pattern] = n - used
            else:
                # as many of this length as fit together, the last sequence partly filled
                each = size // length
                whole, over = divmod(left, each)
                for k, count in ((each, whole), (over, 1)):
                    if k and count:
                        new = (length,) * k
                        slot = room[size - length * k]
                        slot[new] = slot.get(new, 0) + count
                left = 0
                continue
            new = (*pattern, length)
            slot = room[free - length]
            slot[new] = slot.get(new, 0) + used
            left -= used
    return [(p, n) for slots in room.values() for p, n in slots.items()]


def make_plan(histogram: np.ndarray, size: int) -> Plan:
    """Sequences for a histogram of lengths 1..size: rounded fit, then the rest."""
    left = histogram.astype(np.int64).copy()
    plan: Plan = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    patterns = patterns_of(size)[1:]
    patterns = patterns[((left > 0) | (np.arange(size + 1) == 0))[patterns].all(axis=1)]
    if len(patterns):
        counts = np.floor(fit_counts(patterns, left.astype(float)) + 1e-6).astype(np.int64)
        for i in np.argsort(-counts, kind="stable"):
            lengths = tuple(int(a) for a in patterns[i] if a)
            n = min(int(counts[i]), *(int(left[a]) // lengths.count(a) for a in lengths))
            if n:
                plan.append((lengths, n))
                for a in lengths:
                    left[a] -= n
    return plan + pack_rest(left, size)


def plan_intervals(plan: Plan) -> dict[int, list[tuple[int, int, int]]]:
    """For each length, in order of rank: (first rank, first sequence, offset in the sequence)."""
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, n in plan:
        at = 0
        for length in lengths:
            out[length].append((ranks[length], sequence, at))
            ranks[length] += n
            at += length
        sequence += n
    return out


def cut_pieces(docs: DataFrame, tokenizer_path: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of all documents, with their number among those of their length in the same task."""
    fields = [("piece", "int"), ("start", "bigint"), ("length", "int"), ("ids_crc32", "bigint"), ("part", "int"), ("nth", "bigint")]

    def make():
        encode, seen, part = encoder(tokenizer_path, "I"), defaultdict(int), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()

        def work(kept, texts):
            rows, out = [], []
            for row, text in enumerate(texts):
                data = encode(text) + end
                total = len(data) // 4
                cuts = [0, *range(total % size or size, total + 1, size)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(row)
                    out.append((piece, a, b - a, zlib.crc32(data[4 * a : 4 * b]), part, seen[b - a]))
                    seen[b - a] += 1
            if rows:
                yield [kept[0].take(pa.array(rows)), *zip(*out, strict=True)]

        return work

    return scan_texts(docs, text_col, [id_col], make, [(id_col, docs.schema[id_col].dataType.simpleString()), *fields])


def pack_documents(
    docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)``, one row for each piece.

    A document is its ids and ``end_id`` (null or empty: the end id alone); longer ones are cut
    into pieces of ``size``, of which the first may be shorter.  The histogram of lengths (at
    most ``size`` counts) is all the driver sees; the plan maps the n-th piece of a length to a
    sequence and a place, and pieces find their n by counts of tasks and lengths, so no length,
    however common, meets in one task.  Whole texts are packed, however long; pieces of equal length
    are taken in the order of tasks; an id may be null, and repeated rows are packed one by one;
    other columns are not read.  An empty table gives an empty result.
    """
    pieces = written(cut_pieces(docs, tokenizer_path, size, end_id, id_col, text_col), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        histogram[length] = n
    intervals = plan_intervals(make_plan(histogram, size))
    table = pieces.sparkSession.sparkContext.broadcast({k: np.array(v, dtype=np.int64) for k, v in intervals.items()})
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "length"]).select(
        id_col, "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches):
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                own, rows = table.value[int(length)], lengths == length
                at = np.searchsorted(own[:, 0], ranks[rows], side="right") - 1
                sequence[rows] = own[at, 1] + ranks[rows] - own[at, 0]
                offset[rows] = own[at, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
