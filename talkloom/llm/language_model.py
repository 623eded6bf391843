"""Brown class-based n-grams: exchange clustering, class transitions, word emissions.

    P(w | v) = a * P(class(w) | class(v)) * P(w | class(w)) + (1 - a) * P(w)

* Texts are tokenized once: a block (what one task reads, or a bounded part of it) is written as
  numbers of its own vocabulary, and all later passes work on these numbers.
* The vocabulary is never sent whole to anyone.  Words meet by a 64-bit hash (two of a thousand
  million words share one with a chance of 1 in 37), are counted and classed, and the answer
  waits for each block that has the word as a side file.
* The most frequent words (``core``) start the clustering on their own bigrams.  Every other word
  takes the class that is likeliest under its neighbours over the whole corpus.  Then all words
  seen ``least`` times or more, however many these are, are exchanged in Spark rounds against
  the classes of all their neighbours.
* Unseen words are one event, with a class of its own whose chance after each class is that of
  words seen once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import SideFiles, pieces, write_side_files, written

END = b""  # no word is empty; number 0 of every block
_BLOCKS_OF_TASK = 1 << 12
#: A word's place is its block and, in the last bits, its number there.
_SHIFT = 24
#: What bounds a block, and so the memory of a task; tokens, words that are worked on at once.
_BLOCK_WORDS, _BLOCK_TOKENS = 450_000, 2_000_000
_STEP, _LISTED = 500_000, 10_000


@dataclass(frozen=True)
class LmConfig:
    """``core``: words that start the clustering, for ``rounds`` rounds; ``least``: count from
    which a word is exchanged; ``sweeps``: rounds over these words at most, each for one of
    ``shares`` parts of them; ``gain``: share of the log-likelihood that the last ``shares`` rounds
    must have added for another one to follow.  A round takes all words of a part at once; one that
    makes the texts less likely is undone (``undo``)."""

    classes: int = 48  # less than 8,191
    core: int = 1500
    rounds: int = 8
    least: int = 16
    sweeps: int = 8
    shares: int = 4
    gain: float = 1e-3
    undo: bool = True
    class_weight: float = 0.9
    transition_add: float = 0.5
    emission_add: float = 0.5


def words_of(text: bytes | str | None) -> list[bytes]:
    """Words, A-Z lower-cased, and the end token."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    words = data.lower().split()
    words.append(END)
    return words


# -- blocks ---------------------------------------------------------------------------------


def encoded_blocks(docs: DataFrame, id_col: str, text_col: str, learn: Column) -> DataFrame:
    """Texts as numbers, a row for each block: ``(block, ids, learn, sizes, tokens, hashes, n)``,
    where ``tokens`` are the texts one after the other, ``sizes`` their lengths, and ``hashes``
    and ``n`` the words' hashes and training counts by number (little-endian binaries)."""
    chosen = docs.select(
        F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    names = ["block", "ids", "learn", "sizes", "tokens", "hashes", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * _BLOCKS_OF_TASK
        own: dict[bytes, int] = {END: 0}
        held, tokens = [], 0

        def row():
            digest = xxhash.xxh3_64_intdigest
            hashes = np.array([digest(w) for w in own], np.uint64)
            sizes, flat = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            learned = np.concatenate([h[1].to_numpy(zero_copy_only=False) for h in held]).astype(bool)
            n = np.bincount(flat[np.repeat(learned, sizes)], minlength=len(own)).astype(np.int32)
            ids = pa.concat_arrays([h[0] for h in held])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, pa.array(learned))]
            binaries = [pa.array([x.tobytes()], pa.binary()) for x in (sizes, flat, hashes, n)]
            return pa.RecordBatch.from_arrays([pa.array([number]), *lists, *binaries], names)

        for batch in pieces(batches):
            if len(own) > _BLOCK_WORDS or tokens > _BLOCK_TOKENS:
                yield row()
                own, held, tokens, number = {END: 0}, [], 0, number + 1
            take = own.setdefault
            rows = [[take(w, len(own)) for w in words_of(t)] for t in batch.column(2).to_pylist()]
            sizes = np.array([len(r) for r in rows], np.int32)
            held.append((batch.column(0), batch.column(1), sizes, np.fromiter((i for r in rows for i in r), np.int32, sizes.sum())))
            tokens += len(held[-1][3])
        if held:
            yield row()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"block bigint, ids array<{kind}>, learn array<boolean>, sizes binary, tokens binary, hashes binary, n binary"
    return written(chosen.mapInArrow(run, schema), "encoded")


def _numbers(column: pa.Array, row: int, kind) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), kind)


def by_block(encoded: DataFrame, columns: list[str], make: Callable, schema: str, learn: bool = True) -> DataFrame:
    """``make()`` gives a generator function over ``(block, tokens, batch, row)`` of whole blocks,
    that yields batches; ``batch.column(2)`` and further hold ``columns``.  It is called once more
    with ``None`` for what a task has summed up.  With ``learn`` the tokens of training texts only."""
    rows = encoded.select("block", "tokens", *columns, *(("learn", "sizes") if learn else ()))

    def run(batches):
        work = make()
        for batch in batches:
            for row in range(batch.num_rows):
                flat = _numbers(batch.column(1), row, np.int32)
                if learn:
                    used = batch.column(batch.num_columns - 2)[row].values.to_numpy(zero_copy_only=False)
                    flat = flat[np.repeat(used, _numbers(batch.column(batch.num_columns - 1), row, np.int32))]
                yield from work(batch.column(0)[row].as_py(), flat, batch, row)
        yield from work(None, None, None, None)

    return rows.mapInArrow(run, schema)


class Blocks:
    """The words of the block at hand: counts and classes (-1: none), as last placed."""

    def __init__(self, placed: tuple[SideFiles, ...]):
        self.placed = placed

    def read(self, block: int, size: int) -> None:
        self.total, self.classes = np.zeros(size, np.int64), np.full(size, -1, np.int32)
        for side in self.placed:
            found = side.read(block, ["place", "total", "state"])
            if found is not None:
                at = found.column(0).to_numpy() - (block << _SHIFT)
                self.total[at], self.classes[at] = found.column(1).to_numpy(), found.column(2).to_numpy() // _STATE


def steps(flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers before, numbers), some at a time; before the first stands the end of a text."""
    for i in range(0, len(flat), _STEP):
        now = flat[i : i + _STEP]
        yield np.concatenate([flat[i - 1 : i] if i else np.zeros(1, flat.dtype), now[:-1]]), now


# -- core words -----------------------------------------------------------------------------


def core_words(encoded: DataFrame, size: int) -> np.ndarray:
    """Hashes of the ``size`` words most frequent over all training texts, most frequent first.

    Exact without counting every word: the sums of the blocks' own leaders give a count that
    ``size`` words reach; a word that reaches it has its share of it in some block.  The sums of
    such shares give a higher count that ``size`` words reach, and only words that may reach it with
    less than a share from every other block are counted everywhere: about ``size`` of them, however
    many blocks there are.
    """

    def rows_where(chosen: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
        def run(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    hashes, n = _numbers(batch.column(0), row, np.int64), _numbers(batch.column(1), row, np.int32)
                    some = chosen(n)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[some]), pa.array(n[some].astype(np.int64))], ["h", "n"])

        return encoded.select("hashes", "n").mapInArrow(run, "h bigint, n bigint")

    def leaders(n):
        some = np.flatnonzero(n)
        return some[np.argsort(-n[some], kind="stable")[:size]]

    top = rows_where(leaders).groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(size)
    reached, blocks = top.agg(F.min("n")).first()[0] or 1, max(1, encoded.count())
    share = max(1, -(-reached // blocks))
    parts = rows_where(lambda n: np.flatnonzero(n >= share)).groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("blocks"))
    parts = written(parts, "candidates")
    higher = parts.orderBy(F.desc("n"), "h").limit(size).agg(F.min("n")).first()[0] or 1
    reached = max(reached, higher) if top.count() >= size else 1
    asked = written(parts.filter(F.col("n") + (blocks - F.col("blocks")) * (share - 1) >= reached).select("h"), "asked")
    counted = rows_where(np.flatnonzero).join(asked, "h", "left_semi").groupBy("h").agg(F.sum("n").alias("n"))
    return np.array([r["h"] for r in counted.orderBy(F.desc("n"), "h").limit(size).collect()], np.int64)  # bounded by ``size``


def find_core(core: np.ndarray, order: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of words among the core ones, -1 for others; ``order`` sorts ``core``."""
    if not len(core):
        return np.full(len(hashes), -1, np.int32)
    at = np.minimum(np.searchsorted(core, hashes, sorter=order), len(core) - 1)
    return np.where(core[order[at]] == hashes, order[at], -1).astype(np.int32)


def core_bigrams(encoded: DataFrame, core: np.ndarray) -> DataFrame:
    """``(word, next, next_n, before, before_n)``: one row for each core word with a core neighbour."""
    sent = encoded.sparkSession.sparkContext.broadcast((core, np.argsort(core)))

    def make():
        size = len(sent.value[0])
        counts = np.zeros(size * size, dtype=np.int64)

        def work(block, flat, batch, row):
            if block is None:
                some = np.flatnonzero(counts)
                for i in range(0, len(some), 100_000):
                    part = some[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array((part // size).astype(np.int32)), pa.array((part % size).astype(np.int32)), pa.array(counts[part])], ["a", "b", "n"])
                return
            core_id = find_core(*sent.value, _numbers(batch.column(2), row, np.int64))
            for before, now in steps(flat):
                a, b = core_id[before], core_id[now]
                both = (a >= 0) & (b >= 0)
                codes, n = np.unique(a[both] * size + b[both], return_counts=True)
                counts[codes] += n

        return work

    rows = by_block(encoded, ["hashes"], make, "a int, b int, n bigint")
    pairs = written(rows.groupBy("a", "b").agg(F.sum("n").alias("n")), "bigrams")
    after = pairs.groupBy(F.col("a").alias("word")).agg(F.collect_list("b").alias("next"), F.collect_list("n").alias("next_n"))
    before = pairs.groupBy(F.col("b").alias("word")).agg(F.collect_list("a").alias("before"), F.collect_list("n").alias("before_n"))
    return written(after.join(before, "word", "full").repartition(8), "neighbours")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-12)), 0.0)


def best_class(out: np.ndarray, into: np.ndarray, own: float, now: int, table: np.ndarray) -> tuple[int, float]:
    """Best class of a word, and the gain in log-likelihood over staying (over nothing, if it has
    no class, -1, and ``table`` does without it).

    ``out``/``into``: its neighbour counts by class, without itself; ``own``: how often it
    follows itself; ``table``: class bigrams including it.
    """
    size = len(table)
    base = table
    if now >= 0:
        base = table.copy()
        base[now] -= out
        base[:, now] -= into
        base[now, now] -= own
    rows, cols = base.sum(1) + into, base.sum(0) + out  # sums, but for what the word itself begins or ends
    n_out, n_in = out.sum() + own, into.sum() + own
    by_row = _xlogx(base + out) - _xlogx(base)
    by_col = _xlogx(base + into[:, None]) - _xlogx(base)
    index = np.arange(size)
    diagonal = base[index, index]
    cross = _xlogx(diagonal + out + into + own) - _xlogx(diagonal)
    gain = by_row.sum(1) - by_row[index, index] + by_col.sum(0) - by_col[index, index] + cross
    gain -= _xlogx(rows + n_out) - _xlogx(rows) + _xlogx(cols + n_in) - _xlogx(cols)
    best = int(np.argmax(gain))
    return best, float(gain[best] - (gain[now] if now >= 0 else 0.0))


def exchange(neighbours: DataFrame, count: int, config: LmConfig) -> np.ndarray:
    """Class of each core word.  In a round every task takes the classes of the round before and
    exchanges its own words one after the other, first half, then a quarter of them at a time:
    all words at once would chase each other's old places.  The likeliest round counts."""
    context = neighbours.sparkSession.sparkContext
    classes, k, tasks = np.arange(count) % config.classes, config.classes, 4

    def mover(sent, turn):
        def move(rows):
            now, table = (x.copy() for x in sent.value)
            moved = []
            for row in rows.sort_values("word").itertuples():
                w = row.word
                share = 2 if turn < 4 else 4
                if w // tasks % share != turn % share:
                    continue
                nxt, before = (np.array([] if x is None else x, int) for x in (row.next, row.before))
                n, m = (np.array([] if x is None else x, float) for x in (row.next_n, row.before_n))
                own = n[nxt == w].sum()
                out = np.bincount(now[nxt[nxt != w]], n[nxt != w], k)
                into = np.bincount(now[before[before != w]], m[before != w], k)
                old = now[w]
                place, gain = best_class(out, into, own, int(old), table)
                if gain > 1e-9:
                    for at, sign in ((old, -1), (place, 1)):
                        table[at] += sign * out
                        table[:, at] += sign * into
                        table[at, at] += sign * own
                    now[w] = place
                    moved.append((w, place))
            return pd.DataFrame(moved, columns=["word", "class"])

        return move

    groups = neighbours.groupBy((F.col("word") % tasks).alias("task"))
    best = (-np.inf, classes)
    for turn in range(config.rounds + 1):
        table = _class_table(neighbours, classes, k)
        best = max(best, (likelihood_of(table), classes), key=lambda x: x[0])
        if turn == config.rounds:
            break
        moves = groups.applyInPandas(mover(context.broadcast((classes, table)), turn), "word int, class int").collect()  # at most ``core`` rows
        classes = classes.copy()
        for word, place in moves:
            classes[word] = place
    return best[1]


def likelihood_of(table: np.ndarray) -> float:
    """Log-likelihood of the classes' bigrams, but for what no exchange changes."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def _class_table(neighbours: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    sent = neighbours.sparkSession.sparkContext.broadcast(classes)

    def add(batches):
        table = np.zeros((k, k))
        for batch in batches:
            for row in batch.to_pylist():
                if row["next"]:
                    table[sent.value[row["word"]]] += np.bincount(sent.value[np.array(row["next"])], np.array(row["next_n"], float), k)
        yield pa.RecordBatch.from_arrays([pa.array([table.ravel().tolist()], pa.list_(pa.float64()))], ["t"])

    parts = neighbours.select("word", "next", "next_n").mapInArrow(add, "t array<double>")
    return np.sum([r[0] for r in parts.collect()], axis=0).reshape(k, k)  # a small table for each of a few tasks


# -- all words ------------------------------------------------------------------------------

_EVIDENCE = "h bigint, place bigint, total bigint, class int, cells array<int>"
#: ``state``: a word's class, the one before it (by 1 higher, 0 for none), and in the last bit
#: whether the row is the word's first.
_PLACED = "place bigint, total bigint, state int"
_STATE = 1 << 14


def evidence(encoded: DataFrame, listed: Callable[[], Callable], k: int) -> DataFrame:
    """For each block some of its words with the classes of their neighbours, as cells of count
    and kind (``count * (2k + 1) + kind``): kinds below k for the word before, below 2k for the
    word after, 2k for itself.

    ``listed()`` gives a function of a block, its hashes and counts to (numbers of the words,
    their totals, their classes, classes of all words as neighbours).
    """
    width = 2 * k + 1

    def make():
        chosen = listed()

        def work(block, flat, batch, row):
            if block is None:
                return
            hashes, n = _numbers(batch.column(2), row, np.int64), _numbers(batch.column(3), row, np.int32)
            some, totals, own, classes = chosen(block, hashes, n)
            kind = np.int32 if len(some) * width < 1 << 31 else np.int64
            slot = np.full(len(hashes), -1, kind)
            slot[some] = np.arange(len(some))
            codes, counts = np.zeros(0, kind), np.zeros(0, np.int64)
            found = []
            for before, now in steps(flat):
                a, b, ra, rb, same = classes[before], classes[now], slot[before], slot[now], before == now
                one, two, three = (rb >= 0) & (a >= 0) & ~same, (ra >= 0) & (b >= 0) & ~same, same & (rb >= 0)
                found += [(rb[one] * width + a[one]).astype(kind), (ra[two] * width + (k + b[two])).astype(kind), (rb[three] * width + 2 * k).astype(kind)]
            if found:
                codes, counts = np.unique(np.concatenate(found), return_counts=True)
            del found
            ends = np.concatenate([[0], np.cumsum(np.bincount(codes // width, minlength=len(some)))])
            for i in range(0, len(some), _LISTED):
                j = min(i + _LISTED, len(some))
                part, here, bounds = some[i:j], slice(ends[i], ends[j]), pa.array((ends[i : j + 1] - ends[i]).astype(np.int32))
                cells = pa.ListArray.from_arrays(bounds, pa.array((counts[here] * width + codes[here] % width).astype(np.int32)))
                plain = [hashes[part], (block << _SHIFT) + part.astype(np.int64), totals[i:j].astype(np.int64), own[i:j].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in plain), cells], ["h", "place", "total", "class", "cells"])

        return work

    return by_block(encoded, ["hashes", "n"], make, _EVIDENCE)


def likeliest(table: np.ndarray, logs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For rows of neighbour counts the likeliest class: chance of the neighbours under it, times
    its share of words (all there is to go by where no neighbour has a class)."""
    weights, prior = logs
    return np.argmax(table @ weights + prior, axis=1)


def summed(rows: DataFrame, width: int, add: bool, decide: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows of each word summed (its totals too, with ``add``), its class decided by
    ``decide(hashes, table, classes)`` and given to every block that has the word, but for words
    without a training token or whose class stays; ``first`` marks one row of each word.

    Words come sorted, batch by batch; a word has at most a row for each block.
    """
    names = ["place", "total", "state"]

    def run(batches):
        held = None  # the word that the last batch ended with: hash, sums, class, total, its places

        def answer(hashes, tables, classes, totals, runs):
            found = decide(hashes, tables, classes).astype(np.int32)
            sizes = np.array([len(x) for x in runs])
            state = np.repeat(found * _STATE + (classes + 1) * 2, sizes).astype(np.int32)
            state[np.cumsum(sizes) - sizes] += 1
            some = np.flatnonzero(np.repeat((totals > 0) & (found != classes), sizes))
            return pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (np.concatenate(runs), np.repeat(totals, sizes), state)], names)

        def alone():
            h, sums, now, total, asked = held
            return answer(np.array([h]), sums[None], np.array([now], np.int32), np.array([total]), [np.concatenate(asked)])

        for batch in batches:
            if not batch.num_rows:
                continue
            h, places, totals, classes = (batch.column(i).to_numpy() for i in range(4))
            starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            bounds = np.append(starts, len(h))
            ends = batch.column(4).offsets.to_numpy() - batch.column(4).offsets[0].as_py()
            cells = batch.column(4).flatten().to_numpy()
            owner = np.repeat(np.arange(len(starts)), np.diff(ends[bounds]))
            tables = np.bincount(owner * width + cells % width, cells // width, len(starts) * width).reshape(-1, width)
            sums = np.add.reduceat(totals, starts) if add else totals[starts].copy()
            runs = [places[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            begin = 0
            if held is not None and held[0] == h[0]:
                held = (held[0], held[1] + tables[0], held[2], held[3] + (sums[0] if add else 0), [*held[4], runs[0]])
                begin = 1
            if begin < len(starts):
                if held is not None:
                    yield alone()
                last = len(starts) - 1
                if begin < last:
                    some = slice(begin, last)
                    yield answer(h[starts[some]], tables[some], classes[starts[some]], sums[some], runs[some])
                held = (h[starts[last]], tables[last].copy(), classes[starts[last]], sums[last], [runs[last]])
        if held is not None:
            yield alone()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "h").sortWithinPartitions("h").mapInArrow(run, _PLACED)


def place_all(encoded: DataFrame, core: np.ndarray, core_classes: np.ndarray, core_table: np.ndarray, config: LmConfig) -> SideFiles:
    """Counts and first classes of all training words: the core's own, and for every other word
    the class likeliest under its core neighbours over the whole corpus."""
    k = config.classes
    table = core_table + config.transition_add
    to_next = np.log(table / table.sum(1, keepdims=True))
    prior = np.log(np.bincount(core_classes, minlength=k) + 0.5)
    # for a word of class c: chance of c after the class before it, of the next class after c
    logs = (np.concatenate([to_next, to_next.T]), prior)
    sent = encoded.sparkSession.sparkContext.broadcast((core, np.argsort(core), core_classes, logs))

    def listed():
        core, order, placed, _ = sent.value

        def chosen(block, hashes, n):
            at = find_core(core, order, hashes)
            classes = np.where(at >= 0, placed[at] if len(core) else -1, -1).astype(np.int32)
            return np.arange(len(hashes)), n, np.full(len(hashes), -1), classes

        return chosen

    def decide(hashes, tables, classes):
        core, order, placed, logs = sent.value
        at = find_core(core, order, hashes)
        found = likeliest(tables[:, : 2 * k], logs)
        return np.where(at >= 0, placed[at], found) if len(core) else found

    return write_side_files(summed(evidence(encoded, listed, k), 2 * k + 1, True, decide), "words", key="place", shift=_SHIFT)


def class_table(encoded: DataFrame, placed: tuple[SideFiles, ...], k: int) -> np.ndarray:
    """Class bigrams of all training tokens, (k + 1, k + 1): index k stands for words seen once,
    which are counted there besides their own class."""
    width = k + 1

    def make():
        own, table = Blocks(placed), np.zeros(width * width, np.int64)

        def work(block, flat, batch, row):
            if block is None:
                some = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(table[some])], ["code", "n"])
                return
            own.read(block, len(_numbers(batch.column(2), row, np.int32)))
            once = own.total == 1
            for before, now in steps(flat):
                a, b, oa, ob = own.classes[before], own.classes[now], once[before], once[now]
                start = a < 0  # before the first text, should no training text have been read yet
                if start.any():
                    a, b, oa, ob = a[~start], b[~start], oa[~start], ob[~start]
                for codes in (a * width + b, a[ob] * width + k, k * width + b[oa], np.full((oa & ob).sum(), width * width - 1)):
                    table[:] += np.bincount(codes, minlength=len(table))

        return work

    found = by_block(encoded, ["n"], make, "code int, n bigint")
    table = np.zeros(width * width)
    for code, n in found.groupBy("code").agg(F.sum("n")).collect():  # at most (k + 1) squared rows
        table[code] = n
    return table.reshape(width, width)


def sweep(encoded: DataFrame, placed: tuple[SideFiles, ...], table: np.ndarray, turn: int, config: LmConfig) -> SideFiles:
    """One round of the exchange for all words seen ``least`` times whose turn it is: the words
    that moved, with their new classes."""
    k = config.classes
    sent = encoded.sparkSession.sparkContext.broadcast(table)

    def listed():
        own = Blocks(placed)

        def chosen(block, hashes, n):
            own.read(block, len(hashes))
            some = np.flatnonzero((own.total >= config.least) & (hashes % config.shares == turn % config.shares))
            return some, own.total[some], own.classes[some], own.classes

        return chosen

    def decide(hashes, tables, classes):
        out = classes.copy()
        for i, now in enumerate(classes.tolist()):
            place, gain = best_class(tables[i, k : 2 * k], tables[i, :k], tables[i, 2 * k], now, sent.value)
            out[i] = place if gain > 1e-9 else now
        return out

    return write_side_files(summed(evidence(encoded, listed, k), 2 * k + 1, False, decide), "moved", key="place", shift=_SHIFT)


@dataclass(frozen=True)
class LmModel:
    """What scoring needs besides the blocks' words: small tables."""

    tokens: int
    words: int
    sizes: np.ndarray  # training tokens of each class
    kinds: np.ndarray  # distinct words of each class
    chances: np.ndarray  # (k + 1, k + 1) transitions, index k: the unseen word
    config: LmConfig

    def chance(self, totals: np.ndarray, classes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Base and model chance of each token of whole texts, by its number in ``totals`` and
        ``classes``."""
        c, k = self.config, len(self.sizes)
        base = (totals + 0.5) / (self.tokens + 0.5 * (self.words + 1))
        place = np.where(totals > 0, classes, k)
        known = place < k
        safe = np.where(known, place, 0)
        emission = np.where(known, (totals + c.emission_add) / (self.sizes[safe] + c.emission_add * self.kinds[safe]), 1.0)
        before = np.concatenate([np.zeros(1, flat.dtype), flat[:-1]])
        of_base = base[flat]
        return of_base, c.class_weight * self.chances[place[before], place[flat]] * emission[flat] + (1 - c.class_weight) * of_base


def learn_model(encoded: DataFrame, config: LmConfig) -> tuple[LmModel, tuple[SideFiles, ...], list[float]]:
    """The small tables, the side files of the blocks' words, and the likelihood before each sweep
    that could follow and after the last."""
    spark, k = encoded.sparkSession, config.classes
    core = core_words(encoded, config.core)
    core_classes, core_table = np.zeros(0, np.int64), np.zeros((k, k))
    if len(core):
        neighbours = core_bigrams(encoded, core)
        core_classes = exchange(neighbours, len(core), config)
        core_table = _class_table(neighbours, core_classes, k)
    placed = (place_all(encoded, core, core_classes, core_table, config),)
    sizes = np.zeros((2, k))

    new, old = F.floor(F.col("state") / _STATE), F.floor(F.col("state") % _STATE / 2) - 1

    def of_firsts(side: SideFiles, column: Column):
        found = side.frame(spark, _PLACED).filter((F.col("state") % 2 == 1) & (column >= 0)).groupBy(column).agg(F.sum("total"), F.count("*"))
        return [(place, np.array([tokens, kinds])) for place, tokens, kinds in found.collect()]  # at most k rows

    for place, n in of_firsts(placed[0], new):
        sizes[:, place] += n
    likelihoods = []
    counts = class_table(encoded, placed, k)
    for turn in range(config.sweeps):
        likelihoods.append(likelihood_of(counts[:k, :k]))
        # every part has had its turn since the likelihood before the last ``shares`` rounds
        if turn >= config.shares and likelihoods[-1] - likelihoods[-1 - config.shares] < config.gain * abs(likelihoods[-1]):
            break
        moved = sweep(encoded, placed, counts[:k, :k], turn, config)
        after = class_table(encoded, (*placed, moved), k)
        if config.undo and likelihood_of(after[:k, :k]) < likelihoods[-1]:
            continue  # words that moved at once have chased each other: the classes before stay
        placed, counts = (*placed, moved), after
        for column, sign in ((new, 1), (old, -1)):
            for place, n in of_firsts(moved, column):
                sizes[:, place] += sign * n
    likelihoods.append(likelihood_of(counts[:k, :k]))
    return _model(counts, sizes, config), placed, likelihoods


def _model(counts: np.ndarray, sizes: np.ndarray, config: LmConfig) -> LmModel:
    """Smoothed chances from class bigrams ``counts`` (index k: words seen once)."""
    k = config.classes
    once, plain = counts[:, k], counts[:, :k]
    unseen = (once + 0.5) / (plain.sum(1) + 1.0)
    smooth = (plain + config.transition_add) / (plain.sum(1, keepdims=True) + config.transition_add * k)
    chances = np.concatenate([(1 - unseen)[:, None] * smooth, unseen[:, None]], axis=1)
    if not sizes[1].sum():
        chances[:, :k], chances[:, k] = 0.0, 1.0
    return LmModel(int(sizes[0].sum()), int(sizes[1].sum()), sizes[0], sizes[1], chances, config)


def score_texts(docs: DataFrame, learn: Column, config: LmConfig | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where ``learn`` is true, score all rows.

    ``(id, learn, n_tokens, n_known, train_tokens, base_score, score, perplexity)``.  Null and
    empty texts are the end token alone; whole texts count, however long.  Repeated rows count as
    often as they occur; a null id is kept; a null ``learn`` is false.  Words of equal count are
    ordered by hash, classes of equal chance by number.  With no row to learn from, every token is
    unseen and both scores are 0.  Columns other than id, text and those of ``learn`` are not
    read.  An empty table gives an empty result.
    """
    config = config or LmConfig()
    encoded = encoded_blocks(docs, id_col, text_col, learn)
    found, placed, _ = learn_model(encoded, config)
    model = docs.sparkSession.sparkContext.broadcast(found)
    names = [id_col, "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]

    def make():
        own = Blocks(placed)

        def work(block, flat, batch, row):
            if block is None:
                return
            n = _numbers(batch.column(5), row, np.int32).astype(np.int64)
            own.read(block, len(_numbers(batch.column(2), row, np.int32)))
            offsets, parts = np.concatenate([[0], np.cumsum(n)]), []
            cuts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], _STEP)), len(n)))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):  # whole texts, about a step of tokens
                some, begins = flat[offsets[i] : offsets[j]], offsets[i:j] - offsets[i]
                chances = model.value.chance(own.total, own.classes, some)
                parts.append([np.add.reduceat((own.total[some] > 0).astype(np.int64), begins), *(np.add.reduceat(np.log10(x), begins) for x in chances)])
            known, base, score = (np.concatenate(x) for x in zip(*parts, strict=True))
            total = np.full(len(n), model.value.tokens)
            kept = [batch.column(i)[row].values for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x) for x in (n, known, total, base, score, 10 ** (-score / n)))], names)

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, learn boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
    return by_block(encoded, ["n", "ids", "learn", "sizes"], make, schema, learn=False)
