import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.llm import suffix_dedup as sd


def by_hand(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                hit[i : i + length] = True
        out.append((len(t), int(hit.sum()), int((np.diff(np.append(0, hit.astype(int))) == 1).sum()), np.frombuffer(t, np.uint8)[~hit].tobytes()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß ") for _ in range(rng.randrange(2, 9)))
    base = [" ".join(word() for _ in range(120)) for _ in range(6)]
    texts = []
    for _ in range(40):
        a = rng.choice(base)
        i = rng.randrange(len(a))
        texts.append(" ".join(word() for _ in range(rng.randrange(30))) + a[i : i + rng.randrange(50, 500)] + " ".join(word() for _ in range(rng.randrange(30))))
    return [*texts, texts[3], texts[3], base[0] + base[0], "z" * 700, "ab" * 300, "", "short"]


@pytest.mark.parametrize("length", [160, 250])
def test_sorting_a_bucket_equals_brute_force(length):
    texts = [t.encode() for t in corpus(length)]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t, flags in zip(texts, sd.repeated_starts(texts, length), strict=True):
        assert flags.tolist() == [counts[t[i : i + length]] > 1 for i in range(max(0, len(t) - length + 1))]


def test_cover_has_every_difference():
    assert {(a - b) % sd.MODULUS for a in sd.COVER for b in sd.COVER} == set(range(sd.MODULUS))


@pytest.mark.parametrize("most", [2048, 1])
def test_removal_equals_brute_force(spark, most):
    texts = corpus(9)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in sd.remove_repeats(rows, sd.DedupConfig(length=160, most=most, bucket_bytes=4000)).collect()}
    for i, want in enumerate(by_hand([t.encode() for t in texts], 160)):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want


def test_long_texts_go_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sd, "_CHUNK", 1000)
    texts = [t.encode() for t in corpus(4)]
    texts.append(texts[0] + bytes(random.Random(1).randrange(97, 123) for _ in range(5000)) + texts[0])
    config = sd.DedupConfig(length=160)
    runs = [r for part in sd.Anchors(config).runs(texts) for r in zip(*part, strict=True)]
    covered = {(int(i), int(a) + k) for i, a, n, *_ in runs for k in range(n)}
    assert covered == {(i, k) for i, t in enumerate(texts) for k in range(len(t) - 159)}
    anchors = {}
    for i, a, n, anchor, *_ in runs:
        for k in range(a, a + n):
            assert anchors.setdefault(texts[i][k : k + 160], anchor) == anchor


def test_periodic_and_very_long_texts(spark):
    """A repeated character is one run, not one for each byte; texts of a megabyte are whole."""
    rng = random.Random(8)
    letters = bytes(rng.randrange(97, 123) for _ in range(1_200_000))
    texts = [b"z" * 200_000, letters, letters[700_000:700_300] + b"#ail", b"ab" * 400 + letters[:100]]
    config = sd.DedupConfig()
    runs = [r for part in sd.Anchors(config).runs(texts) for r in zip(*part, strict=True)]
    assert sum(r[0] == 0 for r in runs) == 1
    rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(2)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in sd.remove_repeats(rows, sd.DedupConfig(length=160)).collect()}
    assert found == {0: (200_000, 200_000, 1), 1: (1_200_000, 300, 1), 2: (304, 300, 1), 3: (900, 800, 1)}


def test_odd_rows(odd, empty):
    found = sd.remove_repeats(odd, sd.DedupConfig(length=160)).collect()
    assert len(found) == odd.count()
    removed = {r.doc_id: r.n_removed for r in found}
    assert removed[9] == 3000 and removed[1] == removed[2] == removed[5] == 0
    assert sd.remove_repeats(empty).count() == 0
    text = sd.remove_repeats(odd, sd.DedupConfig(length=160), keep=("doc_id", "word"), as_text=True).filter("doc_id = 6").first()
    assert text.kept == "ÄÖ ß é ñ 漢字" and text.word == "word"


def test_a_content_has_one_row_in_a_block(spark):
    """However many parts of it repeat."""
    from talkloom.llm import common, suffix_dedup

    texts = [(i, "".join(f"{i} {j} unlike anything {i * j} " + "same words here and there " * 20 for j in range(6))) for i in range(12)]
    rows = common.in_blocks(spark.createDataFrame(texts, "doc_id bigint, text string"), ["doc_id", "text"], "few")
    _, repeats = suffix_dedup.repeated_runs(rows, suffix_dedup.DedupConfig(length=160))
    found = spark.read.parquet(repeats.path).select("block", "anchor", "content")
    assert found.count() == found.distinct().count() > 0


@pytest.mark.parametrize("size", [399, 400])
def test_the_query_counts_bytes_not_words(spark, tmp_path, size):
    """A passage of over fifty words stays below 400 bytes; with the pipeline's 250 it goes."""
    from talkloom.llm.queries import op2_suffix_dedup

    rng = random.Random(400)
    passage = "".join(" " if i % 7 == 6 else rng.choice("abcdefgh") for i in range(size))
    assert len(passage.split()) > 50
    rows = spark.createDataFrame([(0, f"1{passage}2"), (1, f"3{passage}4")], "doc_id bigint, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    removed = {r.doc_id: r.n_removed for r in op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert removed == dict.fromkeys((0, 1), size if size >= 400 else 0)
    shorter = sd.remove_repeats(rows, sd.DedupConfig(length=250)).collect()
    assert [r.n_removed for r in shorter] == [size, size]


@pytest.mark.parametrize("most", [2048, 3])
def test_periodic_texts_of_many_lengths_fill_no_bucket(spark, monkeypatch, most):
    """Runs of one anchor, each of another length: a bucket gets their distinct parts, not their sum."""
    rng = random.Random(12)
    units = ["z", "ab-", "-=-=-=*", "lorem ipsum dolor. "]
    texts = [f"{rng.random()}" + units[i % 4] * ((20_000 + 97 * i) // len(units[i % 4])) + f"{rng.random()}" for i in range(60)]
    texts += [units[0] * (640 + 159 + i) for i in range(3)] + [units[1] * 300 + units[0] * 2000, "short"]
    filled = []
    sort = sd.sort_buckets

    def seen(stretches, buckets, length):
        filled.extend(r.size for r in stretches.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size")).collect())
        return sort(stretches, buckets, length)

    monkeypatch.setattr(sd, "sort_buckets", seen)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r for r in sd.remove_repeats(rows, sd.DedupConfig(length=160, most=most)).collect()}
    assert max(filled) < 60_000 < sum(map(len, texts)) / 20
    for i, want in enumerate(by_hand([t.encode() for t in texts], 160)):
        r = found[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want
