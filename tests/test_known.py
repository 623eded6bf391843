import hashlib
import json
import random

import pandas as pd
from pyspark.sql import functions as F

from talkloom.operators import media
from talkloom.plans import known


def sha(text):
    return hashlib.sha256(str(text).encode()).hexdigest()


def rows(spark, items):
    return spark.createDataFrame([(s, n, sha(t) if t is not None else None) for s, n, t in items], "source string, n bigint, fp string")


def test_duplicates_of_earlier_versions_are_found(spark, tmp_path):
    rng = random.Random(3)
    seen = known.KnownRecords(spark, str(tmp_path))
    committed, n = set(), 0
    for version in range(5):
        items = [(rng.choice("qw"), n + i, rng.randrange(400)) for i in range(150)] + [("q", n + 500 + i, "hot") for i in range(300)] + [("q", n + 900, None), (None, n + 901, 5)]
        frame = rows(spark, items)
        new = {(r.source, r.n) for r in seen.new_records(frame, ["n"]).collect()}
        first = {}
        for s, k, t in items:
            if t is not None and s is not None and (s, sha(t)) not in committed:
                first.setdefault((s, sha(t)), (s, k))
        assert new == set(first.values())
        assert {tuple(r) for r in seen.known(frame).collect()} == committed & {(s, sha(t)) for s, _, t in items if t is not None}
        seen.add(frame.filter("fp IS NOT NULL AND source IS NOT NULL"))
        committed |= set(first)
        n += 1000
        if version == 3:
            seen.merge(fan=2)
            assert len(seen.log.latest().parts) < 4
    assert len(committed) > 400


def test_filters_let_few_others_pass(spark, tmp_path):
    fps = pd.Series([sha(i) for i in range(3000)])
    stored = known.make_filter(fps)
    assert known.passing(fps, stored).all() and known.passing(pd.Series([sha(i) for i in range(10_000, 20_000)]), stored).mean() < 0.02
    assert known.passing(pd.Series([], dtype=object), stored).tolist() == []
    seen = known.KnownRecords(spark, str(tmp_path))
    assert seen.known(rows(spark, [("q", 1, 1)])).count() == 0
    seen.add(rows(spark, [("q", i, i) for i in range(2000)]))
    passed = seen.candidates(rows(spark, [("q", i, i) for i in range(1990, 6000)])).count()
    assert 10 <= passed < 300  # what the exact check still has to look up


def by_hand(value, path=""):
    if isinstance(value, dict):
        if value.get("kind", value.get("kind_name")) in media.MEDIA_KINDS:
            yield path, value
        else:
            for k, v in value.items():
                yield from by_hand(v, f"{path}/{k.replace('~', '~0').replace('/', '~1')}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from by_hand(v, f"{path}/{i}")


def nested(rng, depth):
    kind = rng.choice([None, "image", "voice", "text", 5, "reply"])
    if depth == 0 or rng.random() < 0.2:
        return rng.choice([1, "x", None, True, {}, [], {"kind": "image"}, {"kind": None, "kind_name": "video"}, {"kind_name": "sticker"}])
    if rng.random() < 0.4:
        return [nested(rng, depth - 1) for _ in range(rng.randrange(4))]
    made = {k: nested(rng, depth - 1) for k in rng.sample(["a", "b/c", "d~", "é f", "kinds"], rng.randrange(4))}
    return made | ({} if kind is None or rng.random() < 0.5 else {"kind": kind})


def test_media_nodes_at_any_depth(spark):
    rng = random.Random(9)
    values = [nested(rng, 6) for _ in range(120)] + [{"kind": "image", "in": {"kind": "video"}}]
    texts = [json.dumps(v) for v in values] + [None, "", "{broken", "5", '"image"']
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    got = {(r.id, r.media_ref, r.kind): json.loads(r.node) for r in media.media_nodes(frame, "body", ("id",)).collect()}
    want = {(i, path, node.get("kind", node.get("kind_name"))): node for i, v in enumerate(values) for path, node in by_hand(v)}
    assert got == want and max(path.count("/") for _, path, _ in want) >= 4
    deep = '{"a":' * 70 + "{}" + "}" * 70
    try:
        media.media_nodes(spark.createDataFrame([(1, deep)], "id int, body string"), "body", ("id",), most=3)
        raise AssertionError("too deep")
    except ValueError:
        pass
    assert media.media_nodes(frame.filter(F.lit(False)), "body", ("id",)).count() == 0
