import random

import pytest
from pyspark.sql import functions as F

from talkloom.plans.commits import CommitLog
from talkloom.plans.reader_store import ReaderStore

SCHEMA = "source string, record_id string, timestamp bigint, seq bigint, text string"


def rows_of(rng, count):
    return [(rng.choice("qw"), f"r{i}", rng.randrange(5000), rng.randrange(4), f"t{i}") for i in range(count)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[2], r[0], r[3], r[1]))


def contents(store):
    """Items by chunk, in the order of the index; each chunk read by itself must say the same."""
    index = sorted(store.index().collect(), key=lambda r: r.chunk_id)
    assert [r.chunk_id for r in index] == list(range(1, len(index) + 1))
    assert all(r.prev == (r.chunk_id - 1 or None) and r.next == (r.chunk_id + 1 if r.chunk_id < len(index) else None) for r in index)
    every = [tuple(r[c] for c in ("source", "record_id", "timestamp", "seq", "text", "chunk_id")) for r in store.items().collect()]
    chunks = {}
    for row in in_order(every):
        chunks.setdefault(row[-1], []).append(row[:-1])
    assert {r.chunk_id: (r.n, r.first_time, r.last_time) for r in index} == {k: (len(v), v[0][2], v[-1][2]) for k, v in chunks.items()}
    return index, chunks


def test_a_change_writes_one_or_two_chunks(spark, tmp_path):
    rng = random.Random(4)
    rows = rows_of(rng, 3000)
    frame = lambda: spark.createDataFrame(rows, SCHEMA).repartition(3)
    store = ReaderStore(spark, str(tmp_path), size=40)
    assert store.update(frame()) == store.index().count() > 40
    assert store.update(frame()) == 0 and store.log.latest().version == 1
    changes = [
        lambda: rows.insert(0, ("q", "early", 0, 0, "new")), lambda: rows.remove(in_order(rows)[1500]), lambda: rows.__setitem__(7, (*rows[7][:4], "edited")),
        lambda: rows.append(("w", "late", 9999, 0, "new")),
    ]
    for change in changes:
        change()
        assert 1 <= store.update(frame()) <= 2
        index, chunks = contents(store)
        assert [r for k in sorted(chunks) for r in chunks[k]] == in_order(rows)
    assert len(store.log.latest().parts) == 5
    middle = len(index) // 2
    assert [tuple(r) for r in store.chunk(middle).collect()] == chunks[middle]
    store.compact()
    assert len(store.log.latest().parts) == 1 and contents(store)[1] == chunks and store.update(frame()) == 0
    assert len(store.log.clean(older=-60)) == 5 and contents(store)[1] == chunks
    fresh = ReaderStore(spark, f"{tmp_path}/fresh", size=40)  # the way there does not matter
    fresh.update(frame())
    assert [(r.chunk, r.digest) for r in contents(fresh)[0]] == [(r.chunk, r.digest) for r in contents(store)[0]]


def test_a_bound_that_goes_merges_its_chunks(spark, tmp_path):
    rows = rows_of(random.Random(5), 600)
    store = ReaderStore(spark, str(tmp_path), size=20)
    store.update(spark.createDataFrame(rows, SCHEMA))
    index, chunks = contents(store)
    gone = chunks[5][0]  # it begins chunk 5
    rows.remove(gone)
    assert store.update(spark.createDataFrame(rows, SCHEMA)) == 1
    after, now = contents(store)
    assert len(after) == len(index) - 1 and now[4] == chunks[4] + chunks[5][1:]
    rows.append(gone)
    assert store.update(spark.createDataFrame(rows, SCHEMA)) == 2 and contents(store)[1] == chunks


def test_two_updates_at_once_and_odd_stores(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(rows_of(random.Random(6), 50), SCHEMA)
    one, two = ReaderStore(spark, str(tmp_path), size=10), ReaderStore(spark, str(tmp_path), size=10)
    one.update(rows)
    write = CommitLog.write

    def slow(self, *args, **how):
        monkeypatch.setattr(CommitLog, "write", write)
        two.update(rows.filter("timestamp < 2500"))
        return write(self, *args, **how)

    monkeypatch.setattr(CommitLog, "write", slow)
    with pytest.raises(RuntimeError, match="first"):
        one.update(rows.filter("timestamp > 2500"))
    assert one.items().count() == rows.filter("timestamp < 2500").count()
    one.update(rows.filter("false"))
    assert one.items().count() == 0 == one.index().count() and one.chunk(1).count() == 0
    single = ReaderStore(spark, f"{tmp_path}/one", size=1)
    single.update(rows)
    assert single.index().agg(F.max("n")).first()[0] == 1
    with pytest.raises(ValueError):
        ReaderStore(spark, str(tmp_path), size=0)


def test_records_are_named_as_they_are_dealt(spark, tmp_path):
    """Chunk names need no second deal of the records and no window over a part."""
    rows = rows_of(random.Random(3), 500)
    store = ReaderStore(spark, str(tmp_path / "s"), 7)
    found = store._chunked(spark.createDataFrame(rows, SCHEMA))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning(__part" not in plan
    assert found.count() == 500 and found.select("chunk").distinct().count() > 20
