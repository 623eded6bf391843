"""Spelling variants: words one edit apart, by a bit-sliced position index.

The vocabulary is counted over whole texts.  Two words one edit apart agree before and after the
edit, so each word is dealt by its beginning and by its end; groups that are too large are dealt
again by a longer beginning or a longer end, until the edit has one place left.  Groups in order
make piles.  A pile is indexed by position and letter, a bit for each word; recurrences over the
letters of a query word then track, for all words of the pile at once, those without an error and
those with one, the latter with positions shifted where a letter is inserted.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import pieces, written

#: Latin-1 bytes of a run, A-Z as small letters; all others separate runs.
_RUNS = bytes(ord(chr(c).lower()) if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))
#: A document drops a letter of a run if this divides the checksum of both.
DROPS = 97
#: Words that a task counts before it passes them on.
FLUSH = 200_000
#: Words of a pile; a larger group is dealt again.
PILE = 2048
#: Query words that run through the index at once.
QUERIES = 256


def runs_of(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF as Latin-1 bytes; other characters separate."""
    return (text or "").encode("latin-1", "replace").translate(_RUNS).split()


def spelled(key: str, run: bytes) -> bytes:
    """``run`` as the document ``key`` spells it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(f"{key}:".encode()))
    at = h % len(run)
    return run if h % DROPS else run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 5, least: int = 3) -> DataFrame:
    """``(word, n)``: words of at least ``length`` letters and ``least`` occurrences.

    A task counts the words of its texts and passes sums on, at most ``FLUSH`` words at a time.
    """

    def run(batches):
        counts = Counter()

        def out():
            found = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return found

        for batch in pieces(batches):
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(runs_of(body)).items():
                    if len(word) >= length:
                        word = spelled(own or "", word)
                        if len(word) >= length:
                            counts[word] += n
                if len(counts) > FLUSH:
                    yield out()
        yield out()

    chosen = docs.select(docs[key].cast("string").alias("key"), docs[text].cast("string").alias("text"))
    return chosen.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# -- groups ------------------------------------------------------------------------------------


def _key() -> Column:
    return F.concat(F.expr("left(word, p)"), F.lit("\0"), F.expr("right(word, s)"))


def dealt(rows: DataFrame) -> DataFrame:
    """Each row twice, by a longer beginning and by a longer end.

    A row (a, p, s, word, n) stands in a group of words of ``a`` letters, or one more, that share
    their first ``p`` and last ``s`` letters, so that the edit lies in ``a - p - s`` letters.  The
    first half of these agrees in a pair, or else the second half does.
    """
    half = F.ceil((F.col("a") - F.col("p") - F.col("s")) / 2).cast("int")
    ways = F.array(
        F.struct((F.col("p") + half).alias("p"), F.col("s").alias("s")), F.struct(F.col("p").alias("p"), (F.col("a") - F.col("p") - half).cast("int").alias("s"))
    )
    return rows.withColumn("way", F.explode(ways)).select("a", F.col("way.p").alias("p"), F.col("way.s").alias("s"), "word", "n").withColumn("key", _key())


def groups(words: DataFrame, length: int, most: int) -> DataFrame:
    """All rows of groups of at most ``most`` words; only groups whose edit has one place left may
    be larger, and those have no more words than there are pairs of letters.

    Words of ``a`` and ``a + 1`` letters meet in class ``a``.  Each round deals the groups that are
    still too large again and halves the letters in which an edit may lie.
    """
    size = F.length("word")
    classes = words.select(F.explode(F.array(size, size - 1)).alias("a"), F.lit(0).alias("p"), F.lit(0).alias("s"), "word", "n").filter(F.col("a") >= length)
    rows, out, by = dealt(classes), None, ["a", "p", "s", "key"]
    while True:
        large = written(rows.groupBy(*by).count().filter((F.col("count") > most) & (F.col("a") - F.col("p") - F.col("s") > 1)).select(*by), "large_groups")
        done = not large.limit(1).count()
        settled = rows if done else rows.join(large, by, "left_anti").select(*rows.columns)
        out = settled if out is None else out.unionByName(settled)
        if done:
            return out
        rows = dealt(written(rows.join(large, by, "left_semi").drop("key"), "dealt_again"))


# -- the index -----------------------------------------------------------------------------------


class PositionIndex:
    """A bit for each word of a pile, by position and letter; positions are cut as they are asked for."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.lanes = codes, -(-len(codes) // 64)
        self.cut: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def packed(self, marks: np.ndarray) -> np.ndarray:
        """Booleans (rows, words) as lanes of 64 bits."""
        wide = np.zeros((len(marks), self.lanes * 64), bool)
        wide[:, : marks.shape[1]] = marks
        return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """For each query, the words that have its letter at ``position``."""
        if position not in self.cut:
            for old in [p for p in self.cut if p < position - 2]:
                del self.cut[old]
            column = self.codes[:, position] if position < self.codes.shape[1] else np.zeros(len(self.codes), np.uint8)
            present = np.unique(column[column > 0])
            place = np.full(256, len(present))
            place[present] = np.arange(len(present))
            none = np.zeros((1, len(column)), bool)
            self.cut[position] = place, self.packed(np.concatenate([column[None, :] == present[:, None], none]))
        place, bits = self.cut[position]
        return bits[place[letters]]

    def one_error(self, queries: np.ndarray, a: int, same: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries of ``a`` letters against all words: (replaced, inserted) as bits by query and word.

        ``exact`` holds the words without an error so far, ``replaced`` those with another letter
        in one place, ``inserted`` those with one letter more, whose positions run one ahead.
        """
        self.cut.clear()
        exact = np.full((len(queries), self.lanes), ~np.uint64(0))
        replaced, inserted = np.zeros_like(exact), np.zeros_like(exact)
        for i in range(a):
            here, ahead = self.at(i, queries[:, i]), self.at(i + 1, queries[:, i])
            inserted = (inserted | exact) & ahead
            replaced = replaced & here | exact & ~here
            exact &= here
        return replaced & same, (inserted | exact) & longer


def set_bits(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each bit set; only lanes that have one are unpacked."""
    row, lane = np.nonzero(bits)
    which, bit = np.nonzero(np.unpackbits(bits[row, lane].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return row[which], lane[which] * 64 + bit


def near_pairs(codes: np.ndarray, lengths: np.ndarray, group: np.ndarray, end: np.ndarray, a: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a pile in both directions: words of a group that are one edit apart.

    A pair meets in several groups and counts in one: where its common beginning is as long as
    can be, so in a group with a shared end (``end`` letters) only if the letters before that end
    do not agree.
    """
    index, short = PositionIndex(codes), np.flatnonzero(lengths == a)
    same, longer = index.packed((lengths == a)[None, :]), index.packed((lengths == a + 1)[None, :])
    left, right = [], []
    for i in range(0, len(short), QUERIES):
        own = short[i : i + QUERIES]
        for bits, both in zip(index.one_error(codes[own], a, same, longer), (False, True), strict=True):
            q, w = set_bits(bits)
            q = own[q]
            keep = group[q] == group[w]
            q, w = q[keep], w[keep]
            agree = codes[q, :a] == codes[w, :a]
            common = np.where(agree.all(axis=1), a, agree.argmin(axis=1))
            keep = (end[q] == 0) | (common < a - end[q])
            q, w = q[keep], w[keep]
            left += [q, w] if both else [q]
            right += [w, q] if both else [w]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def match_pile(a: int, rows: list[tuple]) -> pa.RecordBatch:
    """``rows`` (group, end, word, n) of words of ``a`` or ``a + 1`` letters -> for each row with a
    near word their number and the best of them, by count, then in code-point order."""
    group, end = (np.array([r[k] for r in rows]) for k in (0, 1))
    words, n = [r[2] for r in rows], np.array([r[3] for r in rows], np.int64)
    codes = np.frombuffer(b"".join(w.encode("latin-1").ljust(a + 1, b"\0") for w in words), np.uint8).reshape(len(words), a + 1)
    q, w = near_pairs(codes, np.array([len(x) for x in words]), group, end, a)
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    best = np.full(len(words), len(words))
    np.minimum.at(best, q, rank[w])
    near = np.bincount(q, minlength=len(words))
    found = np.flatnonzero(near)
    chosen = [order[i] for i in best[found]]
    arrays = [
        pa.array([words[i] for i in found], pa.string()), pa.array(near[found], pa.int64()),
        pa.array(n[chosen], pa.int64()), pa.array([words[i] for i in chosen], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "best_n", "best"])


def match_groups(rows: DataFrame) -> DataFrame:
    """``groups`` -> ``(word, n_near, best_n, best)``, a row for each word and group at most; whole
    groups in order make piles, so a task holds one pile."""
    by = ["a", "p", "s", "key"]

    def run(batches):
        pile, now, last, number = [], None, None, 0
        for batch in pieces(batches):
            for a, p, s, key, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, p, s, key) != last:
                    if pile and (len(pile) >= PILE or a != now):
                        yield match_pile(now, pile)
                        pile = []
                    last, now, number = (a, p, s, key), a, number + 1
                pile.append((number, s, word, n))
        if pile:
            yield match_pile(now, pile)

    placed = rows.select(*by, "word", "n").repartition(*by).sortWithinPartitions(*by)
    return placed.mapInArrow(run, "word string, n_near bigint, best_n bigint, best string")


def last_forms(forms: DataFrame, rounds: int = 40) -> DataFrame:
    """``(word, form)`` -> ``(word, root)``: forms followed to the last.  A round takes the form of
    the form, so a chain halves; counts at least double along a chain, so there is an end."""
    state = written(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(rounds):
        up = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = written(state.join(up, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "forms")
        state = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            return state
    raise RuntimeError(f"forms did not settle in {rounds} rounds")


def group_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 5, least: int = 3, ratio: int = 2) -> DataFrame:
    """One row for each word: ``(word, form, root, n, n_near, form_n)``.

    Words are runs of letters (:func:`runs_of`) as their documents spell them (:func:`spelled`),
    with at least ``length`` letters and ``least`` occurrences over all documents.  ``n_near``
    counts the words one insertion, deletion or replacement away; the one of largest count (ties:
    first in code-point order) is the form if it occurs ``ratio`` times as often or more.

    Null and empty texts have no words; a null key counts as the empty text; repeated rows count
    again; whole texts are read, however long, and a long run is a word like any other; further
    columns are not read.  A table without words gives no rows.
    """
    vocabulary = written(count_words(docs, text, key, length, least), "vocabulary")
    found = match_groups(groups(vocabulary, length, PILE))
    best = F.min(F.struct((-F.col("best_n")).alias("least"), F.col("best").alias("word")))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("near"))
    enough = -F.col("near.least") >= ratio * F.col("n")
    words = written(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("near.word")).alias("form"), F.when(enough, -F.col("near.least")).alias("form_n")
        ), "near_words",
    )
    roots = last_forms(words.filter("form IS NOT NULL"))
    return words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
