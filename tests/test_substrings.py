import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from talkloom.operators import identity, substrings


def by_hand(queries, texts):
    return {(q, i, q == t) for q in set(queries) - {"", None} for i, t in texts if t is not None and q in t}


def found(spark, queries, texts, stored=None):
    frame = spark.createDataFrame([(q,) for q in queries], "query string")
    rows = substrings.find(frame, spark.createDataFrame(texts, "id bigint, text string"), stored).collect()
    assert len(rows) == len({(r.query, r.id) for r in rows})
    return {tuple(r) for r in rows}


SHORT = st.text("aab%_\\漢😀é", max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(SHORT | st.none(), max_size=6), st.lists(SHORT | st.none(), max_size=12))
def test_find_equals_every_pair(spark, queries, texts):
    rows = list(enumerate(texts))
    assert found(spark, queries, rows) == by_hand(queries, rows)


def test_two_thousand_queries_of_one_to_nine_characters(spark, tmp_path):
    rng = random.Random(7)
    texts = [(i, "".join(rng.choices("abcdefgh 漢é😀", k=rng.randrange(0, 40)))) for i in range(400)] + [(1000, None), (1001, "漢字")]
    queries = [t[1][a : a + rng.randrange(1, 10)] for t in rng.choices(texts[:400], k=1500) if len(t[1]) > 3 for a in [rng.randrange(len(t[1]) - 2)]]
    queries += ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 6))) for _ in range(500)] + ["漢字", "字", "😀a", "", None, "nowhere at all"]
    want = by_hand(queries, texts)
    assert len(set(queries)) > 1000 and {len(q) for q, _, _ in want} >= set(range(1, 9))
    assert found(spark, queries, texts) == want
    substrings.write_postings(spark.createDataFrame(texts, "id bigint, text string"), str(tmp_path / "grams"))
    assert found(spark, queries, texts, substrings.read_postings(spark, str(tmp_path / "grams"))) == want


def test_candidates_come_by_the_rarest_substring(spark):
    """A query whose substrings are frequent apart from one meets the texts of that one only."""
    texts = [(i, f"common words {i}") for i in range(500)] + [(900, "common words zq")]
    frame = spark.createDataFrame([("words zq",)], "query string")
    rows = substrings.find(frame, spark.createDataFrame(texts, "id bigint, text string"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert [r.id for r in rows.collect()] == [900] and "Join Inner" in plan and "Cartesian" not in plan and "Join Cross" not in plan


def test_discovery_ranks_without_a_bound_on_queries(spark):
    rng = random.Random(8)
    people = [(f"u_{i}", str(10_000 + i), rng.choice(["ann", "bo", "an_n", None]), f"nick {i % 50}") for i in range(300)] + [("u_1", "10001", "twice", "nick")]
    contacts = spark.createDataFrame(people, "uid string, uin string, remark string, nick string")
    asked = [str(10_000 + i) for i in range(1200)] + ["ann", "_", "nick 4", "u_1", " ", "k", None]
    got = identity.discover(spark.createDataFrame([(q,) for q in asked], "query string"), contacts, 7).collect()

    def score(q, uid, uin, remark, nick):
        values = [remark or "", nick or "", uin, uid]
        return 0 if q in values else 1 if any(q in v for v in values[:2]) else 2 if any(q in v for v in values) else None

    for q in ("ann", "_", "nick 4", "u_1", "k", "10007", "11100"):
        best = {}
        for p in people:
            s, shown = score(q, *p), p[2] or p[3]
            if s is not None:
                best[p[0]] = min(best.get(p[0], (9, "")), (s, shown))
        want = sorted((s, shown, uid) for uid, (s, shown) in best.items())
        own = sorted((r for r in got if r.query == q), key=lambda r: r["rank"])
        assert [(r.score, r.display_name, r.id) for r in own] == want[:7]
        assert all(r.complete == (len(want) <= 7) for r in own)
    assert not [r for r in got if r.query == " "]
    with pytest.raises(ValueError):
        identity.discover(contacts.select("uid"), contacts, 0)


def test_texts_of_one_task_are_listed_by_several(spark):
    """A file that one task reads holds many substrings: texts are dealt before they are listed."""
    texts = spark.range(0, 400, numPartitions=1).selectExpr("id", "concat('text ', id) AS text")
    listed = []
    plain = substrings.postings

    def seen(rows, *args, **more):
        listed.append(rows)
        return plain(rows, *args, **more)

    substrings.postings = seen
    try:
        assert found(spark, ["xt 39"], texts.collect()) == by_hand(["xt 39"], [tuple(r) for r in texts.collect()])
        assert substrings.find(spark.createDataFrame([("xt 39",)], "query string"), texts).count() == 11
    finally:
        substrings.postings = plain
    assert listed[2].selectExpr("spark_partition_id() AS p").distinct().count() > 1


def test_candidates_grow_with_the_queries_not_their_square(spark):
    """Numbers sought among numbers: by three characters each would meet hundreds of the others."""
    texts = [(i, f"{i * 7919 % 1_000_000:09d}") for i in range(3000)]
    asked = spark.createDataFrame([(t,) for _, t in texts], "query string")
    rows = spark.createDataFrame(texts, "id bigint, text string")
    met = []
    plain = substrings._checked

    def counted(candidates, *args):
        met.append(candidates.count())
        return plain(candidates, *args)

    substrings._checked = counted
    try:
        assert sorted(r.id for r in substrings.find(asked, rows).filter("exact").collect()) == list(range(3000))
    finally:
        substrings._checked = plain
    assert met[0] <= 2 * len(texts)


def test_a_text_of_many_rows_is_compared_once(spark):
    texts = spark.range(5000).selectExpr("concat('said ', id % 3) AS text")
    got = substrings.find_bodies(spark.createDataFrame([("said",), ("d 1",)], "query string"), texts).collect()
    assert sorted(map(tuple, got)) == [("d 1", "said 1", False), *[("said", f"said {i}", False) for i in range(3)]]


def test_candidates_of_saturated_substrings(spark):
    """Where all strings of six letters are in use, nine letters sought by six would each meet many texts."""
    texts = [(i, "".join("ab"[i >> j & 1] for j in range(9))) for i in range(512)]
    asked = spark.createDataFrame([(t,) for _, t in texts], "query string")
    met = []
    plain = substrings._checked

    def counted(candidates, *args):
        met.append(candidates.count())
        return plain(candidates, *args)

    substrings._checked = counted
    try:
        found = substrings.find(asked, spark.createDataFrame(texts, "id bigint, text string")).count()
    finally:
        substrings._checked = plain
    assert found == met[0] == 512


def test_tasks_list_only_what_is_sought(spark):
    texts = spark.range(3000).selectExpr("id", "concat('some words and ', id) AS text")
    asked = spark.createDataFrame([("and 17",), ("words and 2999",)], "query string")
    listed = substrings.postings(texts, (6, 12), sought=asked)
    want = spark.createDataFrame([(1, "and 17"), (2, "words and 29"), (2, "ords and 299"), (2, "rds and 2999")], "id long, text string")
    grams = {r.gram for r in substrings.postings(want, (6, 12), greatest=True).collect()}
    assert len(grams) == 4 and grams <= {r.gram for r in listed.collect()}
    assert listed.count() < 300 < substrings.postings(texts, (6, 12)).count()


def test_hashes_of_a_text_are_its_own_whatever_lies_around_it(spark):
    rows = [(0, "ab漢😀cdefghijklmnop"), (1, ""), (2, "b漢😀c"), (3, "x" * 60)]
    together = substrings.postings(spark.createDataFrame(rows, "id long, text string").coalesce(1), substrings.SIZES).collect()
    alone = [r for row in rows for r in substrings.postings(spark.createDataFrame([row], "id long, text string"), substrings.SIZES).collect()]
    assert sorted(map(tuple, together)) == sorted(map(tuple, alone))
    for i, text in rows:
        assert sum(r.id == i for r in together) == len({text[a : a + n] for n in substrings.SIZES for a in range(len(text) - n + 1)})
