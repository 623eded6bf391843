import random

import pytest
from pyspark.sql import functions as F

from talkloom.operators import paging
from talkloom.plans.commits import CommitLog, Part, merge_levels
from talkloom.plans.page_store import PageStore

SCHEMA = "source string, chat_id string, message_id string, record_id string, timestamp bigint, seq bigint, text string"


def messages(spark, rng, count, chats=6, start=0):
    rows = [(rng.choice("qw"), f"c{rng.randrange(chats)}", str(i), f"r{i}", rng.randrange(2000), rng.randrange(3), "x" * 20) for i in range(start, start + count)]
    return spark.createDataFrame(rows, SCHEMA)


def files_read(frame):
    """What the scans of a query that has not run before say they have opened."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame.collect()
    seen, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        found = node.metrics().get("numFiles")
        seen += found.get().value() if found.isDefined() else 0
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return seen


def same(a, b):
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.select(*a.columns).collect()]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = messages(spark, random.Random(1), 12_000).cache()
    store = PageStore(spark, str(tmp_path_factory.mktemp("store")), file_rows=300)
    store.append(rows)
    return rows, store


@pytest.mark.parametrize("descending", [False, True])
def test_a_page_opens_two_files_at_any_depth(stored, descending):
    rows, store = stored
    order = paging.order_columns(paging.ORDER, descending)
    for depth in (0, 1, 299, 300, 6123, 11_900, 11_999):
        at = list(rows.orderBy(*order).offset(depth).limit(1).select(*paging.ORDER).first())
        page = store.page_rows(100, at, descending)
        assert 1 <= files_read(page) <= 2 or depth == 11_999
        same(page, paging.keyset_rows(rows, 100, at, descending=descending))
    same(store.page_rows(40, descending=descending), rows.orderBy(*order).limit(40))
    assert files_read(store.page_rows(1000, None, descending)) <= 6  # as many as a long page needs


def test_pages_walk_the_whole_store(spark, tmp_path):
    rng = random.Random(2)
    parts = [messages(spark, rng, n, start=k) for n, k in ((700, 0), (300, 1000), (250, 2000), (1, 3000), (40, 4000))]
    store = PageStore(spark, str(tmp_path), file_rows=60)
    assert store.rows() is None and store.log.latest().version == 0
    for part in parts:
        store.append(part)
    every = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).union(parts[4]).orderBy(*paging.ORDER)
    want = [tuple(r) for r in every.collect()]

    def walk(descending):
        found, cursor = [], None
        while True:
            page = store.page(97, cursor, descending, who="me")
            found += [tuple(r) for r in page.rows.collect()]
            cursor = page.next_cursor
            if not page.has_more:
                return found

    assert walk(False) == want
    store.merge(fan=2)
    assert len(store.log.latest().parts) <= 3 and walk(True) == want[::-1]
    assert len(store.log.clean(older=-60)) >= 2 and walk(False) == want
    with pytest.raises(ValueError):
        store.page(97, store.page(97, who="me").next_cursor, who="you")


def test_pages_of_one_chat(spark, tmp_path):
    rows = messages(spark, random.Random(3), 4000, chats=25)
    store = PageStore(spark, str(tmp_path), ("chat_id", *paging.ORDER), file_rows=150)
    store.append(rows)
    store.append(messages(spark, random.Random(4), 500, chats=3, start=9000))
    every = store.rows().cache()
    for chat in ("c0", "c7", "c24", "none"):
        for descending in (False, True):
            own = every.filter(F.col("chat_id") == chat)
            page = store.page_rows(30, None, descending, prefix=(chat,))
            assert files_read(page) <= 4  # two in each part
            same(page, own.orderBy(*paging.order_columns(paging.ORDER, descending)).limit(30))
            if chat == "c7":
                at = list(own.orderBy(*paging.order_columns(paging.ORDER, descending)).offset(50).limit(1).select("chat_id", *paging.ORDER).first())
                same(store.page_rows(500, at, descending, prefix=(chat,)), own.filter(paging.after_key(paging.ORDER, at[1:], descending)).orderBy(*paging.order_columns(paging.ORDER, descending)))


def test_keys_are_whole_and_stores_keep_their_columns(spark, tmp_path):
    store = PageStore(spark, str(tmp_path))
    with pytest.raises(ValueError):
        store.append(spark.createDataFrame([("q", "c", "1", "r", None, 1, "x")], SCHEMA))
    store.append(messages(spark, random.Random(5), 3))
    with pytest.raises(ValueError):
        store.append(messages(spark, random.Random(5), 3).withColumn("more", F.lit(1)))
    store.append(messages(spark, random.Random(5), 3).filter("false"))
    assert store.page(5).rows.count() == 3


# -- commits -----------------------------------------------------------------------------------------


def test_one_of_two_writers_commits(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    base = one.latest()
    assert one.commit(base, (Part("a"),)).version == 1 and two.commit(base, (Part("b"),)) is None
    assert two.update(lambda c: ((*c.parts, Part("b")), {})).version == 2
    assert [p.name for p in one.latest().parts] == ["a", "b"] and one.versions() == [1, 2]
    with pytest.raises(RuntimeError):  # someone else is always first
        one.update(lambda c: (two.commit(c, c.parts), ((), {}))[1], attempts=3)
    assert not [n for n in one._listed(one.log) if n.startswith(".") and not n.endswith(".crc")]


def test_readers_during_merges_see_one_state(spark, tmp_path):
    """Whatever is added or merged, a reader that holds a commit reads the same rows."""
    log = CommitLog(spark, str(tmp_path))
    merge = lambda old, *place: log.write(log.frame(old), *place)
    total = 0
    for i in range(30):
        part = log.write(spark.range(i, i + 1), 0, i, i)
        log.update(lambda c, part=part: ((*c.parts, part), {}))
        total += i
        held = log.latest()
        before = log.frame(held.parts)
        if i % 3 == 0:
            late = log.write(spark.range(0), 0, i, i)

            def slow(old, *place, late=late):  # another writer adds a part while this one merges
                new = merge(old, *place)
                log.update(lambda c: ((*c.parts, late), {}))
                return new

            merge_levels(log, slow, fan=3)
            assert before.agg(F.sum("id")).first()[0] == total
        assert log.frame(log.latest().parts).agg(F.sum("id")).first()[0] == total
    assert len(log.latest().parts) <= 2 * 4 + 3
    live = {p.name for p in log.latest().parts}
    assert log.clean(older=3600) == []  # too young
    assert set(log.clean(older=-60)).isdisjoint(live) and log.frame(log.latest().parts).agg(F.sum("id")).first()[0] == total


def test_commits_on_a_store_that_renames(spark, tmp_path):
    """Where there are no links, a rename that must not overwrite takes their place."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.commits.link./in", f"file://{tmp_path}")
    one, two = (CommitLog(spark, "viewfs://commits/in/set") for _ in range(2))
    base = one.latest()
    part = one.write(spark.range(3))
    assert one.commit(base, (part,)).version == 1 and two.commit(base, ()) is None
    assert two.update(lambda c: (c.parts, {"by": "two"})).version == 2 and one.latest().facts == {"by": "two"}
    assert one.frame(one.latest().parts).count() == 3 and one.clean(older=-60) == [] and one.versions() == [1, 2]


def test_what_is_appended_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = messages(spark, random.Random(4), 300)
    store = PageStore(spark, str(tmp_path / "s"), file_rows=100)
    store.append(rows.mapInArrow(passed, rows.schema))
    assert seen.value == 300 and store.rows().count() == 300
