import random
import zlib
from collections import Counter

import numpy as np
import pytest

from talkloom.llm import spelling


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(docs, length=5, least=3, ratio=2):
    """Straight from the definition; regular expressions instead of tables, all pairs."""
    import regex

    counts = Counter()
    for key, text in docs:
        for run in regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def found(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts_of(rng, letters, words, count):
    base = ["".join(rng.choices(letters, k=rng.randrange(4, 11))) for _ in range(words)]

    def slip(w):
        i, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w + c, w])

    return [(i, " ".join(slip(rng.choice(base)).title() if rng.random() < 0.3 else rng.choice(base[: 1 + i % len(base)]) for _ in range(60)) + ".漢÷ß×") for i in range(count)]


@pytest.mark.parametrize(("letters", "pile"), [("ab", 8), ("abcé", 50), ("aeiouàßÿtr", 2048)])
def test_variants_equal_definition(spark, monkeypatch, letters, pile):
    monkeypatch.setattr(spelling, "PILE", pile)
    docs = texts_of(random.Random(len(letters)), letters, 40, 60)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    vocabulary = spelling.count_words(frame)
    assert found(spelling.group_variants(frame)) == by_hand(docs)
    rows = spelling.groups(vocabulary, 5, most=pile)
    sizes = rows.groupBy("a", "p", "s", "key").count().collect()
    assert all(r["count"] <= pile or r.a - r.p - r.s <= 1 for r in sizes)
    assert max(r.p + r.s for r in sizes) > 5 or pile > 8  # the small pile makes groups be dealt again


def test_one_prefix_for_a_third_of_all_words(spark):
    """A hot beginning is dealt again by what follows, and nothing is lost."""
    rng = random.Random(2)
    hot = ["common" + "".join(rng.choices("abcdef", k=6)) for _ in range(700)]
    docs = [(i, " ".join(rng.choices(hot, k=400)) + " " + " ".join("".join(rng.choices("ghij", k=5)) for _ in range(200))) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    vocabulary = spelling.count_words(frame)
    sizes = [r["count"] for r in spelling.groups(vocabulary, 5, most=60).groupBy("a", "p", "s", "key").count().collect()]
    assert max(sizes) <= 60 < vocabulary.filter("word LIKE 'common%'").count()
    assert found(spelling.group_variants(frame)) == by_hand(docs)


def test_index_follows_shifted_positions():
    words = ["abcde", "abcd", "bcde", "xabcde", "abcdex", "abxcde", "abxde", "edcba", "abcde"]
    a = 5
    codes = np.frombuffer(b"".join(w.encode().ljust(a + 2, b"\0") for w in words), np.uint8).reshape(len(words), -1)
    index, lengths = spelling.PositionIndex(codes), np.array([len(w) for w in words])
    bits = index.one_error(codes[:1], a, index.packed((lengths == a)[None, :]), index.packed((lengths == a + 1)[None, :]))
    replaced, inserted = ([words[i] for i in spelling.set_bits(b)[1]] for b in bits)
    assert replaced == ["abxde"] and inserted == ["xabcde", "abcdex", "abxcde"]


def test_odd_rows_and_long_texts(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(spelling.group_variants(odd)) == by_hand(rows)
    assert spelling.group_variants(empty).count() == 0
    long = [(1, "letter lettre " * 100_000 + "z" * 20_000), (2, "z" * 20_000 + " letters"), (3, "z" * 19_999), (None, "z" * 20_000), (4, "z" * 19_999 + "Y"), (5, "z" * 19_999 + "y z" + "z" * 19_999)]
    frame = spark.createDataFrame(long, "doc_id bigint, text string")
    got = found(spelling.group_variants(frame, least=2))
    assert got == by_hand(long, least=2)
    assert ("letter", None, "letter", 100_000, 0, None) in got and sum(len(r[0]) == 20_000 and r[4] > 0 for r in got) == 2
