import math
import random

import numpy as np
import pytest
import regex

from talkloom.llm import lexical_search as ls

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def by_hand(docs, items, most=20):
    """Every document scored for every item, straight from the definition, in whole numbers."""
    parsed = [(key, terms_of(text)) for key, text in docs]
    total, length = sum(1 for _, t in parsed if t), sum(len(t) for _, t in parsed)
    df = {}
    for _, t in parsed:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for key, own in parsed:
            score = 0
            for t in terms_of(text):
                tf = own.count(t)
                if tf:
                    m = 100 - 25 + 25 * len(own) * total // length
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, i + 1, key, -score) for i, (score, _, key) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:most])]
    return sorted(out, key=str)


def found(frame):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()], key=str)


def corpus(rng, count, words=300):
    vocabulary = [f"w{i}" for i in range(words)] + ["Été", "漢字", "don't", "A1-b2"]
    topics = [rng.sample(vocabulary, 25) for _ in range(12)]
    return [(i, " ".join(rng.choices(topics[rng.randrange(12)], k=rng.randrange(1, 60)) + rng.choices(vocabulary[:20], k=rng.randrange(20)))) for i in range(count)]


@pytest.mark.parametrize(("docs", "postings", "block"), [(2048, 1 << 19, 64), (40, 1 << 19, 4), (2048, 300, 3)])
def test_ranking_equals_definition(spark, monkeypatch, docs, postings, block):
    monkeypatch.setattr(ls, "DOCS", docs)
    monkeypatch.setattr(ls, "POSTINGS", postings)
    monkeypatch.setattr(ls, "BLOCK", block)
    rng = random.Random(block)
    rows = corpus(rng, 500)
    rows += [(i, rows[7][1]) for i in range(900, 960)] + [(1000, None), (1001, ""), (1002, "...")]  # copies tie
    items = [(i, " ".join(rng.choices(rows[rng.randrange(500)][1].split(), k=rng.choice([1, 2, 8, 20])))) for i in range(20)]
    items += [(30, rows[7][1]), (31, None), (32, "unseen words"), (33, "W1 w1 w1, été")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(ls.rank_documents(frame, bench)) == by_hand(rows, items)


def test_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(ls, "BLOCK", 8)
    rng = random.Random(9)
    rows = corpus(rng, 2500)
    items = [(i, rows[i][1]) for i in range(12)]
    got = ls.rank_documents(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), spark.createDataFrame(items, "item_id bigint, text string"), most=3)
    assert found(got) == by_hand(rows, items, 3)
    met, opened = (sum(r[c] for r in got.collect()) for c in ("met", "opened"))
    assert 0 < opened < met / 3


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ls, "TERMS", 30)
    rng = random.Random(4)
    rows = corpus(rng, 80)
    items = [(i, rows[i][1]) for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(ls.rank_documents(frame, spark.createDataFrame(items, "item_id bigint, text string"), most=5)) == by_hand(rows, items, 5)


def test_summaries_bound_every_document():
    """No member of a block scores more than its block's summary, over its own and commoner terms."""
    rng = np.random.default_rng(3)
    docs = [np.sort(rng.choice(50, rng.integers(1, 20), replace=False)) for _ in range(200)]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    impacts = rng.integers(1, 1000, starts[-1])
    made = ls.build_shard(starts, np.concatenate(docs), impacts, np.arange(50, 0, -1), 8)
    weights = rng.integers(0, 100, 50)
    covered = set()
    for t in range(len(made["lists"])):
        for b in range(made["list_blocks"][t], made["list_blocks"][t + 1]):
            part = slice(made["block_summary"][b], made["block_summary"][b + 1])
            bound = (weights[made["lists"][made["summary_terms"][part]]] * made["summary_impacts"][part]).sum()
            members = made["members"][made["block_members"][b] : made["block_members"][b + 1]]
            assert 0 < len(members) <= 16
            for d in members:
                own = slice(starts[d], starts[d + 1])
                mine = docs[d] >= made["lists"][t]
                assert (weights[docs[d]] * impacts[own])[mine].sum() <= bound
                covered.add((int(d), int(made["lists"][t])))
    assert covered == {(i, int(t)) for i, d in enumerate(docs) for t in d}


def test_odd_rows_and_long_texts(spark, odd, empty):
    items = [(1, "two words"), (None, "No ID"), (3, None), (1, "two words")]
    bench = spark.createDataFrame([(i, t, 0, 0, "x") for i, t in items], "item_id bigint, text string, doc_id int, score int, rank string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(ls.rank_documents(odd, bench)) == by_hand(rows, items)
    assert ls.rank_documents(empty, bench).count() == 0 == ls.rank_documents(odd, bench.filter("false")).count()
    long = [(1, "lorem ipsum " * 120_000), (2, "ipsum"), (3, "y" * 1_500_000)]
    asked = [(1, "ipsum lorem " * 50_000), (2, "y" * 1_500_000)]
    assert len(long[0][1]) > 1_000_000
    got = ls.rank_documents(spark.createDataFrame(long, "doc_id bigint, text string"), spark.createDataFrame(asked, "item_id bigint, text string"))
    small = by_hand(long, [(1, "ipsum lorem"), asked[1]])
    assert found(got) == sorted([(i, r, d, s * (50_000 if i == 1 else 1)) for i, r, d, s in small], key=str)
