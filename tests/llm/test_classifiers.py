import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.llm import language_id as li
from talkloom.llm import quality_classifier as qc
from talkloom.llm import toxicity as tx
from talkloom.llm.common import remainder

GOOD = "the quick brown fox jumps over the lazy dog and runs into a forest of tall green trees".split()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(GOOD) for _ in range(rng.randrange(30, 90))]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            words = [w + rng.choice(["%%%", "###", "$$$"]) for w in words]
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vileness", "vilest", "vilely"])
        docs.append((i, " ".join(words), "xx", "src", 1))
        if i % 10 < 8:
            labels.append((i, 0 if bad else 1, int(toxic)))
    labels += [(7, None, None), (None, 1, 0), (99999, 1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_quality_on_held_out(labelled):
    docs, labels = labelled
    found = qc.score_quality(docs, labels, lambda k: remainder(k, 5) != 0).toPandas()
    held = found[found.doc_id.isin([r.doc_id for r in docs.filter(remainder(docs.doc_id, 5) == 0).collect()])]
    right = (held.predicted == (held.doc_id % 4 != 0)).mean()
    assert right > 0.97 and found.score.between(0, 1).all()


def test_normal_equations_are_sums(labelled, spark):
    docs, _ = labelled
    stats = qc.document_statistics(docs.limit(50), ("doc_id",), "text").selectExpr("*", "CAST(doc_id % 2 AS double) AS label")
    rows = stats.toPandas()
    x = np.array(rows["stats"].tolist())
    fourier = qc.Fourier(x.mean(0), x.std(0) + 1e-6, qc.QualityConfig(features=8))
    left, right = qc.normal_equations(spark.createDataFrame(rows), fourier)
    z = fourier(x)
    assert np.allclose(left, z.T @ z) and np.allclose(right, z.T @ rows["label"].to_numpy())


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 5))
    config = qc.QualityConfig(features=20_000)
    z = qc.Fourier(np.zeros(5), np.ones(5), config)(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * 5))).max() < 0.05


def monotone_fit(means, weights):
    """The least squares non-decreasing fit, by its minimax formula."""
    mean = lambda i, j: np.average(means[i : j + 1], weights=weights[i : j + 1])
    n = len(means)
    return np.array([max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)])


def test_isotonic_is_the_least_squares_monotone_fit():
    rng = np.random.default_rng(1)
    centres, counts = np.arange(30.0), rng.integers(0, 9, 30)
    sums = rng.binomial(counts, np.clip(np.linspace(0, 1, 30) + rng.normal(0, 0.2, 30), 0, 1))
    knots, values = qc.isotonic(centres, sums, counts)
    some = counts > 0
    want = monotone_fit(sums[some] / counts[some], counts[some])
    assert np.allclose(values, np.unique(np.round(want, 12)))
    for knot, value in zip(knots, values, strict=True):  # a knot is where its block lies on average
        block = np.isclose(want, value)
        assert np.isclose(knot, np.average(centres[some][block], weights=counts[some][block]))


def test_quality_scores_equal_direct_sums(labelled):
    """Every score recomputed with plain matrices over all texts."""
    docs, labels = labelled
    config = qc.QualityConfig(features=12)
    found = {r.doc_id: r for r in qc.score_quality(docs, labels, lambda k: remainder(k, 5) != 0, config=config).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    crc = lambda text: zlib.crc32(text.encode())
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and r.doc_id in texts and crc(str(r.doc_id)) % 5}
    ids = sorted(known)
    stats = {i: np.array(qc.statistics(t)) for i, t in texts.items()}
    held = [i for i in ids if crc(f"{i}/fold") % 5 == 0]
    fitted = [i for i in ids if i not in set(held)]
    x, y = np.array([stats[i] for i in fitted]), np.array([known[i] for i in fitted], float)
    z = qc.Fourier(x.mean(0), np.maximum(x.std(0), 1e-6), config)
    left = z(x).T @ z(x)
    weights = np.linalg.solve(left + config.ridge * np.trace(left) / len(left) * np.eye(len(left)), z(x).T @ y)
    place = lambda raw: np.clip((raw + 0.5) / 2 * config.bins, 0, config.bins - 1).astype(int)
    raw = z(np.array([stats[i] for i in held])) @ weights
    counts = np.bincount(place(raw), minlength=config.bins)
    sums = np.bincount(place(raw), [known[i] for i in held], config.bins)
    some = counts > 0
    fit = monotone_fit(sums[some] / counts[some], counts[some])
    centres = ((np.arange(config.bins) + 0.5) / config.bins * 2 - 0.5)[some]
    levels = np.unique(np.round(fit, 12))
    knots = [np.average(centres[np.isclose(fit, v)], weights=counts[some][np.isclose(fit, v)]) for v in levels]
    for i, own in stats.items():
        want = float(np.interp(z(own[None]) @ weights, knots, levels)[0])
        assert found[i].score == pytest.approx(want, abs=1e-6) and found[i].predicted == int(found[i].score >= config.threshold)


def test_quality_odd_rows(labelled, odd, empty):
    _, labels = labelled
    every = lambda k: remainder(k, 5) != 0
    found = qc.score_quality(odd, labels, every).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert qc.score_quality(empty, labels, every).count() == 0
    assert {r.score for r in qc.score_quality(odd, labels.filter("false"), every).collect()} == {0.5}


def test_toxicity_on_held_out(labelled):
    docs, labels = labelled
    found = tx.score_toxicity(docs, labels, lambda k: remainder(k, 3) != 1).toPandas()
    held = found[found.doc_id.isin([r.doc_id for r in docs.filter(remainder(docs.doc_id, 3) == 1).collect()])]
    toxic = held.doc_id % 5 == 0
    assert (held.predicted[toxic] == 1).mean() > 0.95 and (held.predicted[~toxic] == 0).mean() > 0.95
    assert all(len(e) > 0 for e in held.evidence_ids[toxic])


def test_terms_are_all_words_of_the_examples(labelled):
    """Weights recomputed by plain loops: frequencies over all texts, no term left out."""
    docs, labels = labelled
    keyed, pairs = docs.selectExpr("doc_id AS key", "text"), labels.selectExpr("doc_id AS key", "toxic AS label")
    config = tx.ToxicConfig(examples=150)
    model = tx.learn_examples(keyed, pairs, lambda k: remainder(k, 3) != 1, config)
    texts = {r.key: tx.words_of(r.text) for r in keyed.collect()}
    given = {r.key: r.label for r in pairs.collect() if r.label is not None and r.key in texts}
    ids = set(map(int, model.index.ids))
    assert len(ids) <= 150 and ids <= set(given)
    assert set(model.terms.words) == {w for i in ids for w in texts[i]}
    positive = sum(given[i] for i in ids)
    for w, got in zip(model.terms.words, model.terms.weight, strict=True):
        frequency = sum(w in ws for ws in texts.values())
        pos, neg = (sum(given[i] == label and w in texts[i] for i in ids) for label in (1, 0))
        a, b = (pos + 0.5) / (positive + 1), (neg + 0.5) / (len(ids) - positive + 1)
        tie = np.log(a * (1 - b) / (b * (1 - a))) - 1.64 * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
        assert np.isclose(got, np.log1p(len(texts) / frequency) * (1 + 5 * max(tie, 0)))
    dense = {i: dict(zip(*model.terms.vector(" ".join(texts[i])), strict=True)) for i in texts}
    for i in list(texts)[::40]:  # nearest examples and votes by brute force
        cosines = {j: sum(v * dense[j].get(t, 0.0) for t, v in dense[i].items()) for j in ids}
        score, evidence, found = model.score(" ".join(texts[i]))
        assert np.allclose(found, sorted(cosines.values(), reverse=True)[:15])
        assert np.allclose([cosines[int(e)] for e in evidence], found)
    assert (np.diff(model.knots[1]) >= 0).all()


def test_repeated_ids_stay_within_the_bound(spark):
    docs = spark.createDataFrame([(1, f"word{i} same") for i in range(300)] + [(2, "other words"), (None, "none")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 1), (None, 1)], "doc_id bigint, toxic int")
    model = tx.learn_examples(docs.selectExpr("doc_id AS key", "text"), labels.selectExpr("doc_id AS key", "toxic AS label"), lambda k: k.isNotNull() | k.isNull(), tx.ToxicConfig(examples=61))
    assert len(model.index.labels) == 61
    few = tx.learn_examples(docs.selectExpr("doc_id AS key", "text"), labels.selectExpr("doc_id AS key", "toxic AS label"), lambda k: k.isNotNull(), tx.ToxicConfig(example_bytes=100))
    assert 0 < len(few.index.labels) < 12


def examples_of(spark, docs, labels, **config):
    frame = spark.createDataFrame(docs, "key bigint, text string")
    return tx.bounded_examples(frame, spark.createDataFrame(labels, "key bigint, label int"), lambda k: k.isNotNull(), tx.ToxicConfig(**config))


def test_a_long_text_is_passed_over(spark):
    docs = [(i, f"text number {i}") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    every = {r.key for r in examples_of(spark, docs, labels).collect()}
    assert every == set(range(60))
    order = [r.key for r in spark.createDataFrame([(i,) for i in range(60)], "key bigint").orderBy(F.xxhash64("key")).collect()]
    long = [(k, "word " * 6_000_000 if k == order[0] else t) for k, t in docs]  # 30 MB, first in order
    assert {r.key for r in examples_of(spark, long, labels).collect()} == every - {order[0]}
    middle = [(k, "w" * 500 if k == order[3] else t) for k, t in docs]
    assert {r.key for r in examples_of(spark, middle, labels, example_bytes=300).collect()} < every - {order[3]}
    assert order[4] in {r.key for r in examples_of(spark, middle, labels, example_bytes=300).collect()}


def test_labels_without_documents_take_no_place(spark):
    docs = [(i, f"text number {i}") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)] + [(i, 1) for i in range(1000, 7000)]
    assert examples_of(spark, docs, labels, examples=60).count() == 60


def test_classes_of_copies_are_told_apart(spark):
    docs = [(i, "you awful nasty thing") for i in range(30)] + [(i, "a fine day in spring") for i in range(30, 60)] + [(100, "you awful nasty thing"), (101, "a fine day in spring"), (102, "neither here nor there")]
    labels = [(i, int(i < 30)) for i in range(60)]
    scored = {r.doc_id: r for r in tx.score_toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), lambda k: k.isNotNull()).collect()}
    assert scored[100].predicted == 1 and scored[101].predicted == 0 and scored[101].score < scored[102].score < scored[100].score


def test_scores_recomputed_from_the_examples(spark):
    """Votes, calibration on groups of copies and final scores by plain loops."""
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(30)]
    text = lambda toxic: " ".join(rng.choice(words[10 * toxic : 10 * toxic + 20], rng.integers(1, 9)))
    docs = [(i, text(i % 2)) for i in range(50)]
    docs += [(100 + i, docs[i % 4][1]) for i in range(12)] + [(200 + i, text(i % 2)) for i in range(20)] + [(300, ""), (301, None)]
    labels = [(k, (k + (k == 101)) % 2) for k, _ in docs if k < 200]
    config = tx.ToxicConfig(neighbours=5)
    keyed = spark.createDataFrame(docs, "key bigint, text string")
    model = tx.learn_examples(keyed, spark.createDataFrame(labels, "key bigint, label int"), lambda k: k.isNotNull(), config)
    given, body = dict(labels), dict(docs)
    unit = {k: dict(zip(*model.terms.vector(t), strict=True)) for k, t in docs}
    ids = [int(i) for i in model.index.ids]  # in the order in which ties come
    base = (sum(given.values()) + 0.5) / (len(given) + 1)

    def vote(cosines):
        best = sorted((-c, i) for i, c in enumerate(cosines) if c > 0)[:5]
        weights = [c * c for c, _ in best]
        return (sum(w * given[ids[i]] for w, (_, i) in zip(weights, best, strict=True)) + 0.2 * base) / (sum(weights) + 0.2)

    cosine = lambda a, b: sum(v * unit[b].get(t, 0.0) for t, v in unit[a].items())
    samples = []
    for k in given:
        found = [cosine(k, j) for j in ids]
        same = [c > 0.999 for c in found]
        samples.append((vote([0.0 if s else c for c, s in zip(found, same, strict=True)]), given[k], 1 / sum(same)))
        if sum(same) > 1:
            own = next(i for i, s in enumerate(same) if s and given[ids[i]] == given[k])
            samples.append((vote([0.0 if i == own else c for i, c in enumerate(found)]), given[k], 1 / sum(same)))
    merged = {}
    for v, y, w in samples:
        at = next((m for m in merged if abs(m - v) < 1e-12), v)
        s, n = merged.get(at, (0.0, 0.0))
        merged[at] = (s + w * y, n + w)
    blocks = []
    for v in sorted(merged):
        s, n = merged[v]
        blocks.append([v * n, s, n])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2] - 1e-12:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    xs, ys = [b[0] / b[2] for b in blocks], [b[1] / b[2] for b in blocks]
    for k, t in docs:
        want = base if not unit[k] else float(np.interp(vote([cosine(k, j) for j in ids]), xs, ys))
        assert abs(model.score(t)[0] - want) < 1e-6, (k, body[k])


def test_block_max_search_is_exact():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(300):
        at = np.sort(rng.choice(40, rng.integers(1, 8), replace=False))
        v = rng.random(len(at))
        vectors.append((at, v / np.linalg.norm(v)))
    index = tx.BlockMaxIndex(vectors, [0] * 300, list(range(300)), 40, 16)
    dense = np.zeros((300, 40))
    for i, (at, v) in enumerate(vectors):
        dense[i, at] = v
    for at, v in vectors[::7]:
        _, cosines = index.nearest(at, v, 10)
        query = np.zeros(40)
        query[at] = v
        want = np.sort(dense @ query)[::-1][:10]
        assert np.allclose(cosines, want[want > 0])


def test_toxicity_odd_rows(labelled, odd, empty):
    _, labels = labelled
    every = lambda k: remainder(k, 3) != 1
    found = tx.score_toxicity(odd, labels, every).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert tx.score_toxicity(empty, labels, every).count() == 0
    assert {r.score for r in tx.score_toxicity(odd, labels.filter("false"), every).collect()} == {0.0}


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(6)
    words = {"en": "the house and garden with water".split(), "de": "das haus und der garten mit wasser".split(), "fr": "la maison et le jardin avec eau".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(12)), lang) for i, lang in enumerate(["en", "de", "fr"] * 40)]
    rows += [(1000, "gartenhaus", None), (1001, None, "en"), (1002, "123 !!!", "de"), (1003, "WASSER und MIT", "de")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_languages(spoken):
    found = li.identify_languages(spoken, remainder(spoken.doc_id, 3) != 1).toPandas().set_index("doc_id")
    truth = {r.doc_id: r.lang for r in spoken.collect()}
    assert all(found.lang_pred[i] == truth[i] for i in range(120))
    assert found.lang_pred[1000] == "de"  # unseen word, by its n-grams
    assert found.lang_pred[1001] == found.lang_pred[1002] == "und"
    assert found.lang_pred[1003] == "de" and found.score.between(0, 1).all()


def test_language_scores_equal_direct_sums(spark, spoken, monkeypatch):
    """Every prediction and score recomputed by plain loops, with several small blocks."""
    monkeypatch.setattr(li, "_LISTED", 7)
    rows = spoken.unionByName(spark.createDataFrame([(2000, "xgartenx half ½ 漢 garten garten", None), (None, "zz qq", "de"), (2001, "12 _ ½", "en"), (2002, "the ab b", "fr")], spoken.schema)).repartition(5)
    learn, config = remainder(F.col("doc_id"), 3) != 1, li.LangConfig(longest=4)
    found = {r.doc_id: r for r in li.identify_languages(rows, learn, config).collect()}
    texts = rows.withColumn("learn", learn).collect()
    train = [r for r in texts if r.learn and r.lang is not None and r.text is not None]
    langs = sorted({r.lang for r in train})
    words = {x: Counter(w for r in train if r.lang == x for w in li.words_of(r.text)) for x in langs}
    grams = [{x: Counter() for x in langs} for _ in range(5)]
    for x in langs:
        for w, n in words[x].items():
            for size in range(1, 5):
                for g in li.grams_of(w, size):
                    grams[size][x][g] += n

    def logs(table, item):
        kinds = max(len(c) for c in table.values())
        return np.array([math.log((table[x][item] + 0.5) / (sum(table[x].values()) + 0.5 * (kinds + 1))) for x in langs])

    def of_word(w):
        if any(words[x][w] for x in langs):
            return logs(words, w)
        for size in range(4, 0, -1):
            known = [g for g in li.grams_of(w, size) if any(grams[size][x][g] for x in langs)]
            if known:
                return np.mean([logs(grams[size], g) for g in known], axis=0)
        return np.zeros(len(langs))

    unseen = 0
    for r in texts:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (found[r.doc_id].lang_pred, found[r.doc_id].score) == ("und", 0.0)
            continue
        total = np.log([sum(t.lang == x for t in train) / len(train) for x in langs])
        for w in li.words_of(r.text):
            unseen += not any(words[x][w] for x in langs)
            total = total + of_word(w)
        assert found[r.doc_id].lang_pred == langs[int(np.argmax(total))]
        assert found[r.doc_id].score == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-4)
    assert unseen > 3


def test_language_odd_rows(odd, empty):
    learn = remainder(odd.doc_id, 3) != 1
    found = li.identify_languages(odd, learn).collect()
    assert len(found) == odd.count() and {r.lang_pred for r in found} == {"und"}
    assert li.identify_languages(empty, learn).count() == 0


def test_a_bounded_sample_is_fitted(labelled):
    docs, labels = labelled
    config = qc.QualityConfig(most_rows=100, features=32)
    found = qc.score_quality(docs, labels, lambda k: remainder(k, 5) != 0, config=config).toPandas()
    assert (found.predicted == (found.doc_id % 4 != 0)).mean() > 0.9
