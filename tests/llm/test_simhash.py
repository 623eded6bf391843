import random

import xxhash
from pyspark.sql import functions as F

from talkloom.llm import simhash
from talkloom.llm.components import connected


def by_hand(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams)
        out |= (2 * ones > len(grams)) << bit
    return out if grams else 0


def components(values, bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprint_equals_definition():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = " ".join(rng.choice(["Aa", "b", "çé", "dd.", "x"]) for _ in range(n))
        assert simhash.fingerprint(text) % 2**64 == by_hand(text)


def test_links_equal_brute_force_by_either_way(spark):
    rng = random.Random(7)
    values = set()
    for _ in range(30):
        seed = rng.getrandbits(64)
        for _ in range(8):
            v = seed
            for _ in range(rng.randrange(4)):
                v ^= 1 << rng.randrange(64)
            values.add(v - 2**64 if v >= 2**63 else v)
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for bits, segments, most in ((2, 9, 64), (2, 9, 1), (3, 13, 64), (3, 13, 1), (0, 2, 4)):
        want = components(values, bits)
        found = {r.node: r.root for r in connected(simhash.links(frame, bits, segments, most)).collect()}
        assert {v: found.get(v, v) for v in values} == want


def test_odd_rows(spark, odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    blank = {r.component_id for r in found if r.doc_id in (1, 2, 3)}
    assert blank == {1}
    assert {r.component_id for r in found if r.doc_id == 5} == {5}
    assert all(r.fp == 0 for r in found if r.doc_id in (1, 2, 3))
    assert simhash.near_duplicates(empty).count() == 0


def test_long_chain_settles(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in connected(edges).collect()} == {0}
