import random

import pytest

import corpus_pipeline
from talkloom.llm.common import written


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted copies, a shared passage, a benchmark leak and junk."""
    rng = random.Random(12)
    syllables = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n)) + "."
    passage, item = text(90), text(14)
    rows = [(i, text(rng.randrange(120, 200))) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, rows[1][1])]
    rows += [(110 + i, f"{text(80)} {passage} {text(80)}") for i in range(3)]
    rows += [(120, f"{text(60)} {item} {text(60)}")]
    rows += [(200 + i, " ".join(w + "%%%" for w in text(120).split())) for i in range(40)]
    rows += [(300, None), (301, "")]
    place = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or ""), "extra") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, block string")
    docs.write.parquet(f"{place}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i, _ in rows if i < 300]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{place}/benchmark.parquet")
    return place, passage


def test_stages(spark, folder):
    place, passage = folder
    docs, kept = spark.read.parquet(f"{place}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, place), name)
        kept.append(docs)
        if name != "pack":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert not any(200 <= i < 300 for i in ids[0]) and set(range(60)) <= ids[0]
    assert ids[1] & {0, 1, 100, 101, 102} == {0, 1} and set(range(60)) <= ids[1]
    texts = {r.doc_id: r.text for r in kept[2].collect()}
    assert all(passage[20:-20] not in texts[110 + i] and len(texts[110 + i]) > 300 for i in range(3))
    before = {r.doc_id: r.text for r in kept[1].collect()}
    assert all(texts[i] == before[i] for i in range(60))
    assert 120 not in ids[3] and set(range(60)) <= ids[3]
    assert ids[4] == ids[3]


def test_run_and_empty(spark, folder, tmp_path):
    place, _ = folder
    assert corpus_pipeline.run(spark, place).count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{place}/{name}.parquet").filter("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_equals_brute_force(spark, folder):
    """Near copies, cuts, leaks and pieces of a whole run recomputed from the classifier's choice."""
    import zlib
    from collections import Counter
    from itertools import combinations

    import numpy as np
    from tokenizers import Tokenizer

    from talkloom.llm.decontaminate import words_of
    from talkloom.llm.queries import tokenizer

    place, _ = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    kept = {r.doc_id: r.text or "" for r in corpus_pipeline.quality(spark, docs, place).collect()}
    grams = lambda ws, n: {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} or ({tuple(ws)} if ws else set())
    sets = {i: grams(t.encode().lower().split(), 5) for i, t in kept.items()}
    root = {i: i for i in kept}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in combinations(sorted(kept), 2):
        whole = len(sets[i] | sets[j])
        if not whole or len(sets[i] & sets[j]) * 5 >= whole * 4:
            root[max(find(i), find(j))] = min(find(i), find(j))
    texts = {i: kept[i].encode() for i in kept if find(i) == i}
    starts = Counter(t[i : i + 250] for t in texts.values() for i in range(len(t) - 249))
    cut = {}
    for key, t in texts.items():
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - 249):
            if starts[t[i : i + 250]] > 1:
                hit[i : i + 250] = True
        cut[key] = np.frombuffer(t, np.uint8)[~hit].tobytes().decode("utf-8", "ignore")
    items = [words_of(r.text) for r in spark.read.parquet(f"{place}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(1, len(w) - 9))}
    clean = {i: t for i, t in cut.items() if not windows & {tuple(words_of(t)[j : j + 10]) for j in range(len(words_of(t)))}}
    assert len(texts) < len(kept) and len(clean) < len(texts) and cut != {i: t.decode() for i, t in texts.items()}
    encoder = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    want = {}
    for i, t in clean.items():
        ids = np.array([*encoder.encode(t, add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want |= {(i, p): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))}
    rows = corpus_pipeline.run(spark, place).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024
