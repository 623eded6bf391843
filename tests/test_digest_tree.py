import pytest
from pyspark.sql import functions as F

from talkloom.operators import snapshot
from talkloom.plans import digest_tree as dt


def records(spark, rows, other="0"):
    key = F.col("id").cast("string")
    return spark.range(rows).select(F.lit("s").alias("source"), key.alias("record_id"), F.sha2(F.concat(key, F.lit(other)), 256).alias("fp"))


def rows_scanned(frame):
    """Rows that the scan of a query hands on before its filter."""
    plan = frame._jdf.queryExecution().executedPlan()
    count = len(frame.collect())
    todo, rows = [plan], 0
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            rows += node.metrics().get("numOutputRows").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return count, rows


def test_one_change_in_a_million_reads_one_leaf(spark, tmp_path):
    rows = records(spark, 1_000_000)
    old = dt.DigestTree.write(rows, f"{tmp_path}/old", leaf_rows=1000)
    new = dt.DigestTree.write(rows.withColumn("fp", F.when(F.col("record_id") == "777777", F.sha2(F.lit("x"), 256)).otherwise(F.col("fp"))), f"{tmp_path}/new", depth=old.depth())
    assert old.depth() == 3
    leaves = dt.differing_leaves(old, new)
    assert leaves.count() == 1
    count, scanned = rows_scanned(dt.records_of(old, leaves))
    assert 100 < count < 1000 and scanned < 5000  # a page or two of a million rows
    assert [tuple(r) for r in dt.changed_records(old, new).collect()] == [("s", "777777", "changed")]


@pytest.mark.parametrize("listed", [1000, 2])
def test_changes_equal_a_whole_comparison(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(dt, "LISTED", listed)
    a = records(spark, 3000).filter("record_id % 50 <> 3")
    b = records(spark, 3100).filter("record_id % 70 <> 9").withColumn("fp", F.when(F.col("record_id") % 211 == 0, F.lit("f" * 64)).otherwise(F.col("fp")))
    old = dt.DigestTree.write(a, f"{tmp_path}/a", leaf_rows=20)
    new = dt.DigestTree.write(b, f"{tmp_path}/b", depth=old.depth())
    assert sorted(dt.changed_records(old, new).collect()) == sorted(snapshot.compare_snapshots(a, b).collect())
    assert dt.differing_leaves(old, old).count() == 0


def test_odd_trees(spark, tmp_path):
    none = dt.DigestTree.write(records(spark, 0), f"{tmp_path}/none")
    one = dt.DigestTree.write(records(spark, 1), f"{tmp_path}/one")
    assert [r.change for r in dt.changed_records(none, one).collect()] == ["inserted"]
    deep = dt.DigestTree.write(records(spark, 50), f"{tmp_path}/deep", depth=2)
    with pytest.raises(ValueError):
        dt.differing_leaves(one, deep)
    # keys that swap their contents, and a record that is there twice, are seen
    swapped = records(spark, 2).withColumn("fp", F.when(F.col("record_id") == "0", F.sha2(F.lit("10"), 256)).otherwise(F.sha2(F.lit("00"), 256)))
    pair = dt.DigestTree.write(records(spark, 2), f"{tmp_path}/pair", depth=0)
    assert dt.differing_leaves(pair, dt.DigestTree.write(swapped, f"{tmp_path}/swapped", depth=0)).count() == 1
    assert dt.differing_leaves(pair, dt.DigestTree.write(records(spark, 2).union(records(spark, 1)), f"{tmp_path}/twice", depth=0)).count() == 1
