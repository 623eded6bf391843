import random

import pytest
from pyspark.sql import functions as F

from talkloom.operators import observe
from talkloom.streaming import upserts as stream

SCHEMA = "chat_id string, msg_id int, observed_at bigint, recoverable boolean, text string, kind string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    """A session of its own, whose streams keep their state in RocksDB."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    own.conf.set("spark.sql.shuffle.partitions", "2")
    return own


def run(session, rows, folder, files, **how):
    """The rows in files of their own, one file a batch, in the order given."""
    for i in range(files):
        part = session.createDataFrame(rows[i * len(rows) // files : (i + 1) * len(rows) // files], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    read = session.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = stream.stream_upserts(read, f"{folder}/out", f"{folder}/cp", **how)
    query.processAllAvailable()
    query.stop()
    return stream.read_upserts(session, f"{folder}/out")


def rows_of(rng, count, late):
    """Observations in the order of arrival, each up to ``late`` seconds behind its time."""
    rows = [(f"c{rng.randrange(2)}", rng.randrange(6), 10_000 + 3 * i // 4, rng.random() < 0.4, rng.choice(["a", "b", None]), rng.choice(["k", None])) for i in range(count)]
    return sorted(rows, key=lambda r: r[2] + rng.randrange(late))


END = ("end", 0, 10_000_000, True, "x", "k")


def test_stream_equals_batch_under_reordered_input(rocks, tmp_path):
    rows = rows_of(random.Random(3), 160, late=50)
    counts = run(rocks, [*rows, END, END], tmp_path, 5, late="60 seconds", fan=2)
    want = observe.upsert_counts(rocks.createDataFrame(rows, SCHEMA))
    got = {(r.chat_id, r.added, r.updated, r.preserved) for r in counts.filter("chat_id <> 'end'").collect()}
    assert got == {(r.chat_id, r.added, r.updated, r.preserved) for r in want.collect()} and len(got) == 2
    total = counts.filter("chat_id <> 'end'").agg(F.sum(F.col("added") + F.col("updated") + F.col("preserved") + F.col("same"))).first()[0]
    assert total == len(rows)
    by_batch = stream.read_upserts(rocks, f"{tmp_path}/out", "batch")
    assert by_batch.select("batch").distinct().count() > 1


def test_what_is_too_late_is_dropped_and_the_rest_counts(rocks, tmp_path):
    first = [("c", 1, 1000, True, "a", "k"), ("c", 2, 5000, True, "a", "k")]
    late = [("c", 1, 900, True, "z", "k"), ("c", 2, 4990, False, "b", "k")]
    counts = run(rocks, [*first, *first[1:], *first[1:], *late, END, END], tmp_path, 4, late="100 seconds")
    found = {r.chat_id: (r.added, r.updated, r.preserved, r.same) for r in counts.collect()}
    # 1 at 1000; 2 at 4990 (b), 5000 (a), twice more the same; 900 comes after the watermark of 4900
    assert found["c"] == (2, 1, 0, 2)


def test_a_record_is_forgotten(rocks, tmp_path):
    rows = [("c", 1, 1000, True, "a", "k"), ("c", 1, 1010, True, "a", "k"), ("c", 9, 3000, True, "a", "k"), ("c", 9, 3001, True, "a", "k"), ("c", 1, 5000, True, "b", "k"), ("c", 9, 6000, True, "a", "k"), END, END]
    counts = run(rocks, rows, tmp_path, 4, late="1 seconds", forget=1500)
    found = {r.chat_id: (r.added, r.updated, r.preserved, r.same) for r in counts.collect()}
    assert found["c"] == (4, 0, 0, 2)


def test_steps_equal_replay():
    """One record by steps against the rule on whole histories."""
    rng = random.Random(5)
    for _ in range(200):
        rows = sorted(((rng.randrange(4), rng.random() < 0.5, rng.choice(["a", "b", None])) for _ in range(rng.randrange(1, 8))), key=lambda r: stream.nulls_first(*r))
        counts, record = dict.fromkeys(stream.STATES, 0), None
        for row in rows:
            record = stream.UpsertCounter.step(record, row, counts)
        want = dict.fromkeys(stream.STATES, 0)
        for i, row in enumerate(rows):
            earlier = rows[:i]
            kept = max(earlier, key=lambda r: stream.nulls_first(r[1], r[0], r[2]), default=None)
            state = "added" if kept is None else "preserved" if any(r[1] for r in earlier) and not row[1] else "updated" if row[2] != kept[2] else "same"
            want[state] += 1
        assert counts == want


def test_the_state_store_is_named(spark):
    with pytest.raises(ValueError, match="RocksDB"):
        stream.upserts(spark.createDataFrame([], SCHEMA), "1 hour")
