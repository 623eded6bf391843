"""Word shingles, and the prefixes by which similar sets of them meet.

Put the shingles of every text in one order that holds for all.  Of two texts with Jaccard
similarity t or more, each has at least ``ceil(t * n)`` of its n shingles in common with the
other, so the first ``n - ceil(t * n) + 1`` shingles of both, their prefixes, share one.  The order
has shingles that a sample finds frequent last: any order gives the same pairs, this one gives
fewer candidates.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import map_texts, scan_texts, write_side_files

SEED = 42


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of all shingles, repeats included; a shorter text is one shingle, none has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-size].tolist()]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]
    return np.array(hashes, np.uint64)


def shingles(text: str | None, size: int) -> np.ndarray:
    """The distinct ones, ascending."""
    return np.unique(shingle_hashes(text, size).view(np.int64))


def prefix(own: np.ndarray, frequent: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles in the order (count if frequent, hash)."""
    length = len(own) - math.ceil(similarity * len(own) - 1e-9) + 1 if len(own) else 0
    if not len(frequent):
        return own[:length]
    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
    return own[np.argsort(np.where(frequent[at] == own, counts[at], 0), kind="stable")[:length]]


def frequent_shingles(docs: DataFrame, size: int, share: int = 16, least: int = 4, most: int = 300_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and counts of shingles that meet in a share of the rows; only an order."""

    def make():
        return lambda texts: [[shingles(t, size) for t in texts]]

    sample = docs.filter(F.pmod(F.xxhash64("rid"), F.lit(share)) == 0)
    counted = map_texts(sample, "text", [], make, [("token", "array<bigint>")]).select(F.explode("token").alias("token")).groupBy("token").count()
    rows = counted.filter(F.col("count") >= least).orderBy(F.desc("count"), "token").limit(most).collect()
    found = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 2)
    found = found[np.argsort(found[:, 0])]
    return found[:, 0], found[:, 1]


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(cls, shingles)`` of the rows ``wanted(cls, block, rid)``."""
    folder = write_side_files(wanted, "wanted")

    def make():
        state = {"block": None, "rows": {}}

        def work(kept, texts):
            classes, sets = [], []
            for block, rid, text in zip(kept[0].to_pylist(), kept[1].to_pylist(), texts, strict=True):
                if block != state["block"]:
                    rows = folder.read(block, ["rid", "cls"])
                    state["block"], state["rows"] = block, dict(zip(*(c.to_pylist() for c in rows.columns), strict=True)) if rows is not None else {}
                if rid in state["rows"]:
                    classes.append(state["rows"][rid])
                    sets.append(shingles(text, size))
            yield [classes, sets]

        return work

    return scan_texts(docs, "text", ["block", "rid"], make, [("cls", "bigint"), ("shingles", "array<bigint>")])
