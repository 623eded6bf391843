import random
from itertools import combinations

from pyspark.sql import functions as F

import corpus_pipeline
from talkloom.llm import shingles, simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def edited(words, rng, n):
    out = list(words)
    for i in rng.sample(range(len(words)), n):
        out[i] = f"new{rng.randrange(10**6)}"
    return out


def corpus():
    """Groups of near copies by a few changed words, a chain, a shared passage, blanks, copies."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    texts, passage = [], [word() for _ in range(40)]
    for n in (30, 60, 120, 200):
        for _ in range(6):
            base = [word() for _ in range(n)]
            texts += [base, edited(base, rng, 1), edited(base, rng, max(1, n // 60)), edited(base, rng, max(2, n // 25))]
    chain = [word() for _ in range(200)]
    for _ in range(10):
        texts.append(chain)
        chain = edited(chain, rng, 3)
    base = [word() for _ in range(150)]
    texts += [edited(base, rng, rng.randrange(1, 6)) for _ in range(80)]
    texts += [[word() for _ in range(60)] + passage + [word() for _ in range(60)] for _ in range(80)]
    texts += [["one"], ["one"], ["one", "two"], [], [], texts[0]]
    return [" ".join(t) for t in texts]


def brute_force(texts):
    sets = [set(shingles.shingles(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    near = 0
    for i, j in combinations(range(len(texts)), 2):
        common, whole = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if not whole or common * 5 >= whole * 4:
            near += common < whole
            a, b = sorted((find(i), find(j)))
            root[b] = a
    assert near > 200
    return {i for i in range(len(texts)) if find(i) == i}


def test_pipeline_stage_drops_near_copies(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], COLUMNS).repartition(5)
    kept = corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(brute_force(texts))


def test_order_of_frequent_shingles_is_only_an_order(spark, monkeypatch):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string").select("key", "text", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("rid"))
    found = simhash.frequent_shingles
    monkeypatch.setattr(simhash, "frequent_shingles", lambda d, size: found(d, size, share=2, least=2))
    rows = simhash.near_copies(docs).collect()
    assert {r.key for r in rows if r.key == r.component_id} == brute_force(texts)
