"""Digests of a record set as a tree, so that two versions are compared without reading them.

Records are dealt by the hash of their key into 16 ** depth leaves, which stay what they are
however records come and go.  A leaf's digest is the sum of its records' hashes, a node's that of its
sixteen children; all are one aggregation, which tasks do on their own rows first.  Two trees differ
below the nodes whose digests differ: the comparison goes down from the root and reads, in the end,
only the leaves that differ.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators.snapshot import compare_snapshots
from talkloom.sources.scratch import kept

#: Bits of a step of the tree: sixteen children.
STEP = 4
LANES = 4


def leaf_of(keys: tuple[str, ...], depth: int) -> Column:
    # the hash is moved to its first bits without a sign; no depth, one leaf
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - STEP * depth) if depth else F.lit(0).cast("bigint")


def depth_for(rows: int, leaf_rows: int) -> int:
    """Enough leaves for about ``leaf_rows`` each; 16 ** 7 at most."""
    depth = 0
    while depth < 7 and rows > leaf_rows * (1 << STEP * depth):
        depth += 1
    return depth


@dataclass(frozen=True)
class DigestTree:
    """A record set (keys, fp) below ``path``, sorted by leaf, and the digests of its tree."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ("source", "record_id")

    @staticmethod
    def write(records: DataFrame, path: str, keys: tuple[str, ...] = ("source", "record_id"), leaf_rows: int = 10_000, depth: int | None = None) -> DigestTree:
        """Write records and tree.  A version that is to be compared with another takes its ``depth``."""
        spark = records.sparkSession
        depth = depth_for(records.count(), leaf_rows) if depth is None else depth
        dealt = records.withColumn("leaf", leaf_of(keys, depth))
        # a page of a file holds a leaf or a few, and the file says which
        ordered = dealt.repartitionByRange("leaf").sortWithinPartitions("leaf", *keys)
        ordered.write.option("compression", "zstd").option("parquet.page.row.count.limit", str(leaf_rows)).parquet(f"{path}/records")
        one = F.sha2(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys], F.col("fp")), 256)
        lanes = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"l{i}") for i in range(LANES)]
        sums = [F.sum(f"l{i}").alias(f"l{i}") for i in range(LANES)]
        stored = spark.read.schema(ordered.schema).parquet(f"{path}/records")
        leaves = stored.withColumn("h", one).select("leaf", F.lit(1).alias("n"), *lanes).groupBy("leaf").agg(F.sum("n").alias("n"), *sums)
        nodes = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("leaf", STEP * (depth - k)).alias("node")) for k in range(depth + 1)]))
        tree = leaves.withColumn("x", nodes).groupBy("x.level", "x.node").agg(F.sum("n").alias("n"), *sums)
        digest = F.sha2(F.concat_ws("-", F.col("n").cast("string"), *[F.col(f"l{i}").cast("string") for i in range(LANES)]), 256)
        tree.select("level", "node", "n", digest.alias("digest")).repartitionByRange("level", "node").sortWithinPartitions("level", "node").write.parquet(f"{path}/tree")
        return DigestTree(spark, path, tuple(keys))

    def nodes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/tree")

    def records(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/records")

    def depth(self) -> int:
        return self.nodes().agg(F.max("level")).first()[0] or 0


def differing_leaves(old: DigestTree, new: DigestTree) -> DataFrame:
    """Leaves (leaf) whose records differ, found from the root down; ValueError for trees of
    different depths.  A level costs the children of the nodes that differ above it."""
    depth = max(old.depth(), new.depth())
    if min(old.depth(), new.depth()) != depth and old.nodes().limit(1).count() and new.nodes().limit(1).count():
        raise ValueError("the trees have different depths")
    wanted = None
    for level in range(depth + 1):
        side = lambda tree, name: tree.nodes().filter(F.col("level") == level).select("node", F.col("digest").alias(name))  # noqa: B023, E731
        a, b = side(old, "a"), side(new, "b")
        if wanted is not None:
            child = F.explode(F.transform(F.sequence(F.lit(0), F.lit((1 << STEP) - 1)), lambda i: F.shiftleft("node", STEP) + i)).alias("node")
            children = wanted.select(child)
            a, b = a.join(children, "node", "left_semi"), b.join(children, "node", "left_semi")
        wanted = kept(a.join(b, "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node"), "nodes")
    return wanted.withColumnRenamed("node", "leaf")


#: Leaves that are asked for by number; more of them are joined.
LISTED = 1000


def records_of(tree: DigestTree, leaves: DataFrame) -> DataFrame:
    """Records of the leaves given.  A few are named in the scan, which skips all pages without them."""
    few = [r[0] for r in leaves.limit(LISTED + 1).collect()]
    rows = tree.records()
    return rows.filter(F.col("leaf").isin(few)) if len(few) <= LISTED else rows.join(leaves, "leaf", "left_semi")


def changed_records(old: DigestTree, new: DigestTree) -> DataFrame:
    """Records inserted, deleted or changed (keys, change) between two versions, from the leaves that
    differ alone; what :func:`talkloom.operators.snapshot.compare_snapshots` finds in all records."""
    leaves = differing_leaves(old, new)
    return compare_snapshots(records_of(old, leaves), records_of(new, leaves), old.keys)
