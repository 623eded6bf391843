"""SimHash fingerprints and their near copies, found by pigeonring filtering.

Split a fingerprint of 64 bits into m segments on a ring.  If two differ in at most t bits,
some segment starts a chain whose every prefix of l segments differs in at most l*t/m bits
(strong pigeonring principle).  While l*t/m < 1 those segments must be equal, so fingerprints
are joined on that equal run, for each start; longer prefixes prune what the join brings, and
only the rest gets the full Hamming check.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.common import map_texts, written
from talkloom.llm.components import connected
from talkloom.llm.shingles import SEED, frequent_shingles, prefix, shingle_hashes, shingle_sets


def majority(hashes: np.ndarray) -> int:
    """The SimHash of 64-bit hashes as a signed number: the majority of each bit."""
    counts = np.zeros(64, dtype=np.int64)
    table = hashes.astype("<u8", copy=False)
    for i in range(0, len(table), 65536):
        counts += np.unpackbits(table[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(table), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of all shingles' XXH64; zero for a text without words."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row; texts without words have the fingerprint zero."""

    def make():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return map_texts(docs, text_col, [id_col], make, [("fp", "bigint")])


class Ring:
    """Where the segments lie, and the equal run and prefix bounds that the principle gives."""

    def __init__(self, bits: int, segments: int):
        if not (0 <= bits <= 64 and 0 < segments <= 64):
            raise ValueError("64 bits have 1 to 64 segments")
        edges = [i * 64 // segments for i in range(segments + 1)]
        self.bits, self.count = bits, segments
        self.segments = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
        #: l * bits // segments is zero up to this chain length
        self.equal = max(n for n in range(segments + 1) if n * bits < segments or not n)

    def mask(self, start: int, length: int) -> int:
        value = 0
        for k in range(start, start + length):
            at, width = self.segments[k % self.count]
            value |= ((1 << width) - 1) << at
        return value - (1 << 64) if value >= 1 << 63 else value

    def keys(self, fp: Column) -> Column:
        """One (start, equal run) for each start of a chain."""
        if not self.equal:
            raise ValueError("for an equal run there must be more segments than differing bits")
        return F.array(
            *[F.struct(F.lit(i).alias("start"), fp.bitwiseAND(F.lit(self.mask(i, self.equal))).alias("run")) for i in range(self.count)]
        )

    def viable(self, start: Column, difference: Column) -> Column:
        """The chain's longer prefixes stay within their budgets, and so does the whole ring."""
        whole = F.lit(True)
        for i in range(self.count):
            chain = F.lit(True)
            for n in range(self.equal + 1, self.count):
                chain &= F.bit_count(difference.bitwiseAND(F.lit(self.mask(i, n)))) <= n * self.bits // self.count
            whole &= (start != i) | chain
        return whole & (F.bit_count(difference) <= self.bits)

    def some_chain(self, difference: Column, length: int = 3) -> Column:
        """Some chain's prefixes of up to ``length`` segments stay within their budgets, and so
        does the whole ring: for pairs that met elsewhere."""
        some = F.lit(False)
        for i in range(self.count):
            chain = F.lit(True)
            for n in range(1, length + 1):
                chain &= F.bit_count(difference.bitwiseAND(F.lit(self.mask(i, n)))) <= n * self.bits // self.count
            some |= chain
        return some & (F.bit_count(difference) <= self.bits)


def links(distinct: DataFrame, bits: int = 2, segments: int = 9, most: int = 64) -> DataFrame:
    """Edges ``(u, v)`` among distinct fingerprints ``(fp)`` that connect all pairs within ``bits``.

    Runs shared by at most ``most`` fingerprints give pairs, filtered and checked.  The
    fingerprints of larger ones (a large group of near copies) would give pairs without bound;
    these meet in the points half-way between: of two within ``bits``, one lies within
    ``bits // 2`` bits of some point and the other within the rest of it.  Whatever lies near
    that point is within ``bits`` of the least of its nearer ones, so that one gets the links.
    """
    ring = Ring(bits, segments)
    keyed = distinct.select("fp", F.explode(ring.keys(F.col("fp"))).alias("k")).select("fp", "k.start", "k.run")
    sizes = keyed.groupBy("start", "run").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = written(sizes, "runs")
    small = keyed.join(sizes.filter(F.col("n") <= most), ["start", "run"])
    other = small.select("start", "run", F.col("fp").alias("other"))
    difference = F.col("fp").bitwiseXOR(F.col("other"))
    pairs = small.join(other, ["start", "run"]).filter(F.col("fp") > F.col("other")).filter(ring.viable(F.col("start"), difference))
    edges = pairs.select(F.col("fp").alias("u"), F.col("other").alias("v"))
    if sizes.filter(F.col("n") > most).limit(1).count():
        crowded = keyed.join(sizes.filter(F.col("n") > most).select("start", "run"), ["start", "run"]).select("fp").distinct()
        near = written(crowded.select("fp", F.explode(points(F.col("fp"), (bits + 1) // 2)).alias("point")), "points")
        inner = F.when(F.bit_count(F.col("fp").bitwiseXOR(F.col("point"))) <= bits // 2, F.col("fp"))
        centre = near.groupBy("point").agg(F.min(inner).alias("centre"), F.count("*").alias("n")).filter("n > 1 AND centre IS NOT NULL")
        star = near.join(centre.drop("n"), "point").filter(F.col("fp") != F.col("centre"))
        edges = edges.unionByName(star.select(F.greatest("fp", "centre").alias("u"), F.least("fp", "centre").alias("v")))
    return edges.distinct()


def points(fp: Column, radius: int) -> Column:
    """All values within ``radius`` bits of ``fp``."""
    found, masks = {0}, {0}
    for _ in range(radius):
        masks = {m ^ (1 << i) for m in masks for i in range(64)} - found
        found |= masks
    signed = sorted(m - (1 << 64) if m >= 1 << 63 else m for m in found)
    return F.transform(F.array(*map(F.lit, signed)), lambda m: fp.bitwiseXOR(m))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    bits: int = 2,
    segments: int = 9,
    most: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, fp, component_id)`` of every row: its fingerprint and the least id it reaches.

    Null, empty and blank texts all have the fingerprint zero and are linked like any other.
    Copies meet as one fingerprint before any search, so a group of copies costs one row; rows
    with a null id keep their place but never name a component unless they are alone in it.
    Whole texts count, however long: their hashes are summed in parts.  Other columns are not
    read.  An empty table gives an empty result.
    """
    marked = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min(id_col).alias("least_id")), "classes")
    roots = connected(links(classes.select("fp"), bits, segments, most))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(id_col, "fp", "component_id")


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 26, segments: int = 8) -> DataFrame:
    """``(key, component_id)`` of every row of ``docs(key, text, block, rid)``, where ``block`` and
    ``rid`` are those of :func:`in_blocks`: the least key it reaches by pairs whose sets of
    shingles have a Jaccard similarity of ``similarity`` or more.

    Fingerprints of such pairs differ in some ten bits of 64, at which no equal run of segments
    is left to join them on.  So candidates meet in a shingle of their prefixes, where their sizes
    and places in the prefix must leave room for enough common shingles; pigeonring filtering at
    ``radius`` bits and the full Hamming check then prune them, and what is left is compared by
    the shingles themselves.  At 26 bits about one such pair in a million is lost, or fewer.

    Texts with the same shingles meet as one class before any search; those without words, null
    and empty ones too, are one class.  Of texts that share a prefix shingle all are first
    compared with the one that meets most others, and then with each other as far as that has not
    linked them, so a large group of near copies costs a row for each text and not for each pair.
    Whole texts count; repeated rows and null keys stay rows; an empty table gives an empty result.
    """
    frequent, counts = frequent_shingles(docs, shingle)
    order = docs.sparkSession.sparkContext.broadcast((frequent, counts))

    def make():
        def work(texts):
            every = [shingle_hashes(t, shingle) for t in texts]
            sets = [np.unique(h.view(np.int64)) for h in every]
            classes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            return [classes.tolist(), [len(s) for s in sets], [majority(h) for h in every], [prefix(s, *order.value, similarity) for s in sets]]

        return work

    fields = [("cls", "bigint"), ("n", "bigint"), ("fp", "bigint"), ("prefix", "array<bigint>")]
    marked = written(map_texts(docs, "text", ["key", "block", "rid"], make, fields), "prefixes")
    row = F.struct("block", "rid")
    classes = written(marked.groupBy("cls").agg(F.min("key").alias("least_key"), F.max("n").alias("n"), F.min("fp").alias("fp"), F.min(row).alias("place")), "classes")

    # one row for each class and prefix shingle that another class has too
    tokens = marked.select("cls", "n", F.posexplode("prefix").alias("at", "token"))
    several = tokens.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("token")
    met = tokens.join(several, "token").groupBy("cls", "token").agg(F.max("n").alias("n"), F.min("at").alias("at"))
    shared = written(met.join(classes.select("cls", "fp"), "cls"), "shared")
    lists = written(shared.groupBy("cls").agg(F.collect_list("token").alias("tokens")), "lists")  # at most a prefix each
    ring = Ring(radius, segments)

    def viable(a: str, b: str) -> Column:
        """Enough shingles can be common to both, from these places in their prefixes on."""
        n, m = F.col(f"{a}n"), F.col(f"{b}n")
        need = F.ceil((n + m) * (similarity / (1 + similarity)) - 1e-9)
        places = F.least(n - F.col(f"{a}at"), m - F.col(f"{b}at")) >= need
        sizes = F.least(n, m) >= F.greatest(n, m) * similarity - 1e-9
        return sizes & places & ring.some_chain(F.col(f"{a}fp").bitwiseXOR(F.col(f"{b}fp")))

    def similar(pairs: DataFrame, name: str) -> DataFrame:
        """Of ``(u, v, nu, nv)``, first those whose prefixes have enough in common: up to where
        the first prefix ends, all common shingles lie in both; after it one text has
        ``ceil(t * n) - 1`` more.  Then those whose whole sets are similar."""
        near = pairs.join(lists.select(F.col("cls").alias("u"), F.col("tokens").alias("a")), "u").join(lists.select(F.col("cls").alias("v"), F.col("tokens").alias("b")), "v")
        rest = F.ceil(F.greatest("nu", "nv") * similarity - 1e-9) - 1
        need = F.ceil((F.col("nu") + F.col("nv")) * (similarity / (1 + similarity)) - 1e-9)
        near = written(near.filter(F.size(F.array_intersect("a", "b")) + rest >= need).select("u", "v"), f"{name}-near")
        wanted = near.select(F.col("u").alias("cls")).union(near.select("v")).distinct().join(classes, "cls").select("cls", "place.*")
        sets = written(shingle_sets(docs, wanted, shingle), "sets")
        both = near.join(sets.select(F.col("cls").alias("u"), F.col("shingles").alias("a")), "u").join(sets.select(F.col("cls").alias("v"), F.col("shingles").alias("b")), "v")
        common = F.size(F.array_intersect("a", "b"))
        return written(both.filter(common >= (F.size("a") + F.size("b") - common) * similarity - 1e-9).select("u", "v"), name)

    # the class that meets most others is likeliest the one that the others were made from
    sizes = shared.groupBy("token").agg(F.count("*").alias("size"))
    weights = shared.join(sizes, "token").groupBy("cls").agg(F.sum("size").alias("weight"))
    best = F.max_by(F.struct("cls", "n", "at", "fp"), F.struct("weight", "cls")).alias("head")
    heads = shared.join(weights, "cls").groupBy("token").agg(best).select("token", *[F.col(f"head.{c}").alias(f"head_{c}") for c in ("cls", "n", "at", "fp")])
    mine = shared.select("token", *[F.col(c).alias(f"own_{c}") for c in ("cls", "n", "at", "fp")])
    first = mine.join(heads, (mine["token"] == heads["token"]) & (F.col("own_cls") != F.col("head_cls")) & viable("own_", "head_"))
    pair = [F.col("own_cls").alias("u"), F.col("head_cls").alias("v"), F.col("own_n").alias("nu"), F.col("head_n").alias("nv")]
    first = written(first.select(*pair).distinct(), "first")
    linked = similar(first, "linked")
    placed = shared.join(connected(linked).withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    placed = written(placed.join(mixed, "token"), "placed")
    mine = placed.select("token", *[F.col(c).alias(f"own_{c}") for c in ("cls", "n", "at", "fp", "root")])
    other = placed.select(F.col("token").alias("met"), *[F.col(c).alias(f"head_{c}") for c in ("cls", "n", "at", "fp", "root")])
    second = mine.join(other, (mine["token"] == other["met"]) & (F.col("own_cls") > F.col("head_cls")) & (F.col("own_root") != F.col("head_root")) & viable("own_", "head_"))
    second = second.select(*pair).distinct().join(first.select("u", "v"), ["u", "v"], "left_anti").join(first.select(F.col("v").alias("u"), F.col("u").alias("v")), ["u", "v"], "left_anti")
    second = written(second, "second")
    roots = connected(linked.unionByName(similar(second, "linked-later")))

    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "least_key", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("least_key").alias("component_id"))
    return marked.select("key", "cls").join(named.join(least, "root").select("cls", "component_id"), "cls").select("key", "component_id")
