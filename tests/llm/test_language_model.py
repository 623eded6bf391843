import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from talkloom.llm import language_model as lm
from talkloom.llm.common import remainder

TEXTS = ["the cat sat on the mat", "the dog sat on the rug", "a bird flew over the house", "the cat saw a dog", "A dog ran", "la casa de la luna", "el sol de la casa"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(TEXTS) for _ in range(rng.randrange(1, 6))) + f" rare{i % 90}") for i in range(120)] + [(900, None), (901, ""), (902, " \n")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_counts_and_base_equal_direct_sums(corpus):
    config = lm.LmConfig(classes=4, core=30, rounds=4)
    scored = lm.score_texts(corpus, remainder(F.col("doc_id"), 5) != 1, config).toPandas().set_index("doc_id")
    texts = {r.doc_id: lm.words_of(r.text) for r in corpus.collect()}
    counts = Counter(w for i, ws in texts.items() if scored.learn[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in texts.items():
        row = scored.loc[i]
        assert row.n_tokens == len(ws) and row.train_tokens == n
        assert row.n_known == sum(counts[w] > 0 for w in ws)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
    assert scored.score[~scored.learn].sum() > scored.base_score[~scored.learn].sum()


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    k, words = 3, 12
    counts, classes = rng.integers(1, 9, words), rng.integers(0, k, words)
    chances = rng.random((k + 1, k + 1))
    chances /= chances.sum(1, keepdims=True)
    sizes = np.array([counts[classes == c].sum() for c in range(k)], float)
    kinds = np.array([(classes == c).sum() for c in range(k)], float)
    model = lm.LmModel(int(counts.sum()), words, sizes, kinds, chances, lm.LmConfig(classes=k))
    totals, places = np.append(counts, 0), np.append(classes, -1)  # the last is never seen
    for before in range(words + 1):
        total = sum(model.chance(totals, places, np.array([before, w]))[1][1] for w in range(words + 1))
        assert total == pytest.approx(1.0)


def test_score_equals_direct_sums(spark, corpus):
    """Classes, transitions, emissions and scores recomputed by plain loops over all texts."""
    config = lm.LmConfig(classes=4, core=6, rounds=3, least=9, sweeps=2, shares=2, undo=False)
    learn = remainder(F.col("doc_id"), 5) != 1
    encoded = lm.encoded_blocks(corpus.repartition(5), "doc_id", "text", learn)
    model, placed, _ = lm.learn_model(encoded, config)
    name = {xxhash.xxh3_64_intdigest(w): w for r in corpus.collect() for w in lm.words_of(r.text)}
    numbered, texts = {}, []  # (block, number): word
    for r in encoded.collect():
        for i, h in enumerate(np.frombuffer(r.hashes, np.uint64).tolist()):
            numbered[r.block, i] = name[h]
        ends = np.cumsum(np.frombuffer(r.sizes, np.int32))
        for learned, ids in zip(r.learn, np.split(np.frombuffer(r.tokens, np.int32), ends[:-1]), strict=True):
            texts.append((learned, [numbered[r.block, i] for i in ids.tolist()]))
    assert encoded.count() > 1
    found = [{}, {}, {}]
    for classes, side in zip(found, placed, strict=True):
        for r in side.frame(spark, lm._PLACED).collect():
            word = numbered[r.place >> lm._SHIFT, r.place % (1 << lm._SHIFT)]
            assert classes.setdefault(word, r.state // lm._STATE) == r.state // lm._STATE  # one class in all blocks
    before, classes = found[0], found[0] | found[1] | found[2]
    known = [ws for learned, ws in texts if learned]
    counts = Counter(w for ws in known for w in ws)
    assert set(classes) == set(counts)
    pairs = Counter((a, b) for ws in known for a, b in zip([lm.END, *ws], ws, strict=False))

    k = config.classes
    core = sorted(counts, key=lambda w: (-counts[w], np.uint64(xxhash.xxh3_64_intdigest(w)).astype(np.int64)))[: config.core]
    assert [name[int(np.int64(h).astype(np.uint64))] for h in lm.core_words(encoded, config.core)] == core
    table = np.full((k, k), config.transition_add)
    for (a, b), n in pairs.items():
        if a in core and b in core:
            table[before[a], before[b]] += n
    to_next = np.log(table / table.sum(1, keepdims=True))
    for w in set(counts) - set(core):  # the likeliest class under its core neighbours
        score = np.log(np.bincount([before[c] for c in core], minlength=k) + 0.5)
        for (a, b), n in pairs.items():
            if b == w and a in core:
                score = score + n * to_next[before[a]]
            if a == w and b in core:
                score = score + n * to_next[:, before[b]]
        assert score[before[w]] == pytest.approx(score.max())
    assert all(counts[w] >= config.least for w in found[1] | found[2])  # only these were exchanged

    sizes, kinds, move, once = np.zeros(k), np.zeros(k), np.zeros((k + 1, k)), np.zeros(k + 1)
    for w, n in counts.items():
        sizes[classes[w]] += n
        kinds[classes[w]] += 1
    for (a, b), n in pairs.items():
        for row in (classes[a], *([k] if counts[a] == 1 else [])):
            move[row, classes[b]] += n
            once[row] += n * (counts[b] == 1)
    total, vocabulary = sum(counts.values()), len(counts)
    scored = {r.doc_id: r for r in lm.score_texts(corpus.repartition(5), learn, config).collect()}
    for r in corpus.collect():
        want, last = 0.0, lm.END
        for w in lm.words_of(r.text):
            at = classes[last] if counts[last] else k
            unseen = (once[at] + 0.5) / (move[at].sum() + 1)
            base = (counts[w] + 0.5) / (total + 0.5 * (vocabulary + 1))
            if counts[w]:
                c = classes[w]
                chance = (1 - unseen) * (move[at, c] + 0.5) / (move[at].sum() + 0.5 * k) * (counts[w] + 0.5) / (sizes[c] + 0.5 * kinds[c])
            else:
                chance = unseen
            want += math.log10(0.9 * chance + 0.1 * base)
            last = w
        assert scored[r.doc_id].score == pytest.approx(want)


def test_rounds_over_all_words_gain(corpus):
    config = lm.LmConfig(classes=4, core=6, rounds=1, least=2, sweeps=3, shares=3)
    encoded = lm.encoded_blocks(corpus.repartition(3), "doc_id", "text", F.lit(True))
    _, placed, likelihoods = lm.learn_model(encoded, config)
    assert len(placed) == 4 and likelihoods[-1] > likelihoods[0]


def test_rounds_that_harm_are_undone(corpus):
    encoded = lm.encoded_blocks(corpus.repartition(3), "doc_id", "text", F.lit(True))
    _, placed, likelihoods = lm.learn_model(encoded, lm.LmConfig(classes=4, core=6, rounds=3, least=2, sweeps=6, shares=2, gain=0.0))
    assert len(likelihoods) > len(placed) or len(placed) == 7
    assert all(b >= a for a, b in zip(likelihoods, likelihoods[1:], strict=False))


def test_best_class_gain_is_the_change_of_likelihood():
    rng = np.random.default_rng(3)
    n, k = 12, 3
    counts, classes = rng.integers(0, 5, (n, n)).astype(float), rng.integers(0, k, n)

    def likelihood(c):
        t = np.zeros((k, k))
        np.add.at(t, (c[:, None].repeat(n, 1), c[None, :].repeat(n, 0)), counts)
        return lm._xlogx(t).sum() - lm._xlogx(t.sum(1)).sum() - lm._xlogx(t.sum(0)).sum(), t

    before, table = likelihood(classes)
    for w in range(n):
        out, into, own = np.bincount(classes, counts[w], k), np.bincount(classes, counts[:, w], k), counts[w, w]
        out[classes[w]] -= own
        into[classes[w]] -= own
        place, gain = lm.best_class(out, into, own, classes[w], table)
        moved = classes.copy()
        moved[w] = place
        assert likelihood(moved)[0] - before == pytest.approx(gain, abs=1e-9)
        assert all(likelihood(np.where(np.arange(n) == w, c, classes))[0] - before <= gain + 1e-9 for c in range(k))


def test_odd_rows(odd, empty):
    learn = remainder(F.col("doc_id"), 5) != 1
    config = lm.LmConfig(classes=3, core=10, rounds=2, least=2)
    found = lm.score_texts(odd, learn, config).collect()
    assert len(found) == odd.count()
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert lm.score_texts(empty, learn, config).count() == 0
    nothing = lm.score_texts(odd, F.lit(False), config).collect()
    assert {(r.n_known, r.base_score, round(r.score, 9)) for r in nothing} == {(0, 0.0, 0.0)}


def test_core_words_are_the_most_frequent_of_all_blocks(spark):
    """Over several blocks: frequent everywhere, in one only, and ties."""
    import collections
    import random

    import xxhash

    rng = random.Random(11)
    texts = [(i, " ".join(f"w{int(rng.paretovariate(0.8))}" for _ in range(40)) + f" own{i % 8} own{i % 8}") for i in range(240)]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8)
    encoded = lm.encoded_blocks(rows, "doc_id", "text", F.lit(True))
    counts = collections.Counter(w for _, t in texts for w in lm.words_of(t))
    found = lm.core_words(encoded, 20)
    hashed = {xxhash.xxh3_64_intdigest(w): n for w, n in counts.items()}
    got = [hashed[int(h) % (1 << 64)] for h in found]
    assert got == sorted(counts.values(), reverse=True)[:20]
