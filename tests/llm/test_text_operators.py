import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from talkloom.llm import decontaminate as dc
from talkloom.llm import packing, quality_rules, tokens
from talkloom.llm.queries import QUERIES

WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
STRANGE = [
    "", " ", "\n", " a", "a ", "a  b", "a\n\nb", "it's don't we'll 'tis", "x\x01y z", "tab\there", "a \n b", "İstanbul Σίσυφος ΣΑΣ", "é e ́x", "<|endoftext|> hi",
    "日本 語。テスト，a.", "a. b, c., d.. e,,", "\U0001f600 smile\U0001f600.", "a\n", "1,2.3 x1, y2.", "nbsp\xa0here two.",
]


def encoded(path, text):
    t = Tokenizer.from_file(path)
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_tokenizer(path):
    rng = random.Random(3)
    t = Tokenizer.from_file(path)
    mine = tokens.TextEncoder(path, "I")
    texts = STRANGE + ["".join(rng.choice(["a", "B", " ", ",", ".", "'s", "\n", "é", "1", "-", "́", "ß", "word"]) for _ in range(60)) for _ in range(200)]
    letters = [chr(c) for c in range(32, 592) if chr(c).isprintable()]
    texts += [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(20)) for _ in range(300)]
    texts += ["\n".join("".join(rng.choices("aàâçéèêëîïôûùüÿñæœßÀÉÜ×÷bcdefg", k=rng.randrange(1, 12))) for _ in range(20)) for _ in range(100)]
    for text in texts * 2:
        assert np.frombuffer(mine(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_on_given_texts_and_a_megabyte(path, data):
    import duckdb

    t, mine = Tokenizer.from_file(path), tokens.TextEncoder(path, "I")
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{data}/documents.parquet'").fetchall()]
    texts += [" ".join(x for x in texts if x) * 3, "x" * 20_000]
    assert len(texts[-2]) > 1_000_000
    for text in texts:
        assert np.frombuffer(mine(text), "<u4").tolist() == t.encode(text or "", add_special_tokens=False).ids


def test_records_round_trip(spark, odd, empty):
    index = tokens.write_records(odd, WORDS, end_id=1, file_bytes=2000)
    found = sorted(tokens.read_records(index).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (key, text) in zip(found, rows, strict=True):
        want = [*encoded(WORDS, text), 1]
        assert (row.doc_id, row.start) == (key, at) and np.frombuffer(row.ids, "<u4").tolist() == want
        at += len(want)
    assert tokens.read_records(tokens.write_records(empty, WORDS)).count() == 0


def test_broken_records_are_found():
    record = tokens.frame(b"payload")
    assert tokens.unframe(record) == b"payload"
    for i in range(len(record)):
        with pytest.raises(ValueError):
            tokens.unframe(record[:i] + bytes([record[i] ^ 1]) + record[i + 1 :])
    with pytest.raises(ValueError):
        tokens.unframe(record[:-1])


def contamination(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = dc.words_of(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for text in docs:
        w, hit, found = dc.words_of(text), set(), set()
        for g, own in windows.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    found |= own
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("bits", [1 << 28, 1 << 15])
def test_contamination_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(dc, "MOST_BITS", bits)
    rng = random.Random(8)
    word = lambda: rng.choice("the a of cat dog Été x1 in on it".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 9, 10, 14])))) for i in range(12)] + [(50, None), (51, " ...!"), (52, "solo"), (10, "the cat")]
    docs = [" ".join(word() for _ in range(rng.randrange(60))) + " " + rng.choice(items[:12])[1] + ", solo!" * (i % 5 == 0) for i in range(40)] + [None, "", "THE CAT"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted(dc.find_contamination(frame.repartition(3), bench).collect(), key=lambda r: r.doc_id)
    for row, (n, hit, own) in zip(found, contamination(docs, items), strict=True):
        assert (row.n_words, row.n_hit, row.item_ids) == (n, hit, own)
        assert sum(row.ends) - sum(row.starts) == hit


def test_bit_table_of_chosen_places(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
    table = dc.bit_table(spark.createDataFrame([(int(v),) for v in values], "h bigint"), 3000)
    assert len(table) * 8 == 1 << 18 and dc.has_bit(table, values.view(np.uint64)).all()
    assert dc.has_bit(table, rng.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.03


def test_contamination_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, "two words")], "item_id bigint, text string")
    found = dc.find_contamination(odd, bench).collect()
    assert len(found) == odd.count() and [r.n_hit for r in found if r.doc_id == 5] == [2, 2]
    assert dc.find_contamination(empty, bench).count() == 0
    assert {r.n_hit for r in dc.find_contamination(odd, bench.filter("false")).collect()} == {0}


def counts_by_hand(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.strip(quality_rules.SPACES)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(hit)


def test_rule_counts_equal_brute_force():
    rng = random.Random(2)
    for _ in range(80):
        text = "".join(rng.choice(["a ", "b ", "é#", "\n", "c\t", "x y z ", "  ", "|"]) for _ in range(rng.randrange(60)))
        assert quality_rules.text_counts(text) == counts_by_hand(text)
    assert quality_rules.text_counts(None) == (0,) * 6


def test_bad_hosts_are_dropped(spark):
    good, bad = " ".join(f"word{i}" for i in range(80)), " ".join(f"w{i}%%%" for i in range(80))
    rows = [(i, good, "clean") for i in range(200)] + [(1000 + i, bad, "dirty") for i in range(200)] + [(5000, bad, "tiny"), (5001, good, None)]
    kept = {r.doc_id: r.kept for r in quality_rules.apply_host_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[1000 + i] for i in range(200))
    assert kept[5001]


def test_rules_odd_rows(odd, empty):
    found = quality_rules.apply_host_rules(odd).collect()
    assert len(found) == odd.count() and not any(r.kept for r in found if r.doc_id in (1, 2, 3, 4))
    assert quality_rules.apply_host_rules(empty).count() == 0


@pytest.mark.parametrize("size", [32, 1024])
def test_packing_is_whole_and_tight(spark, size):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "Xyz"]) for _ in range(rng.randrange(90)))) for i in range(300)] + [(900, None), (901, ""), (902, "word " * 700)]
    pieces = packing.pack_documents(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), BYTES, size=size).toPandas()
    for key, text in docs:
        ids = np.array([*encoded(BYTES, text), 2], "<u4")
        own = pieces[pieces.doc_id == key].sort_values("piece")
        assert own.length.sum() == len(ids) and own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.piece.tolist() == list(range(len(own))) and (own.length.iloc[1:] == size).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for _, group in pieces.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]] and group.length.sum() <= size
    assert pieces.sequence_id.nunique() <= 1.05 * np.ceil(pieces.length.sum() / size) + 1


def test_plan_covers_any_histogram():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 16, 64):
        for _ in range(5):
            histogram = np.append(0, rng.integers(0, 40, size) * (rng.random(size) < 0.6))
            used = np.zeros(size + 1, int)
            for lengths, n in packing.make_plan(histogram, size):
                assert sum(lengths) <= size and n > 0
                for a in lengths:
                    used[a] += n
            assert (used == histogram).all()


def test_fit_solves_the_least_squares():
    patterns = packing.patterns_of(12)
    truth = np.zeros(len(patterns))
    truth[[3, 9, -1]] = 10, 20, 30
    histogram = np.bincount(patterns.ravel(), weights=np.repeat(truth, 3), minlength=13)
    histogram[0] = 0
    x = packing.fit_counts(patterns, histogram, 2000)
    again = np.bincount(patterns.ravel(), weights=np.repeat(x, 3), minlength=13)
    assert (x >= 0).all() and np.abs(again[1:] - histogram[1:]).max() < 0.1


def test_packing_odd_rows(odd, empty):
    assert packing.pack_documents(odd, BYTES).select("doc_id").count() >= odd.count()
    assert packing.pack_documents(empty, BYTES).count() == 0


def test_all_ten_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
