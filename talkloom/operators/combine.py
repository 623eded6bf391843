"""The primary table and its text index as one: the primary has authority."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions.times import TimeRange

KEYS = ["chat_id", "msg_id"]


def merge_primary_index(primary: DataFrame, index: DataFrame) -> DataFrame:
    """All messages of either table by (chat, id).

    Columns of both tables take the primary's value if the primary has the row, even a null
    one; the index gives ``text`` and ``aux_text``, whatever its own time says.  Rows of the
    index alone are marked ``fts_only``.
    """
    shared = [c for c in index.columns if c in primary.columns and c not in KEYS]
    main = primary.withColumn("__main", F.lit(True))
    side = index.withColumnsRenamed({c: f"__index_{c}" for c in shared})
    # with a filter on texts Spark makes this an outer join of one side and would broadcast the other by its small files
    both = main.join(side.hint("merge"), KEYS, "full_outer")
    known = F.coalesce(F.col("__main"), F.lit(False))
    merged = both.withColumns({c: F.when(known, F.col(c)).otherwise(F.col(f"__index_{c}")) for c in shared})
    return merged.withColumn("fts_only", ~known).drop("__main", *[f"__index_{c}" for c in shared])


def index_orphans(primary: DataFrame, index: DataFrame) -> DataFrame:
    return index.join(primary.select(*KEYS), KEYS, "left_anti")


def live_ids(primary: DataFrame, index: DataFrame) -> DataFrame:
    return primary.select(*KEYS).unionByName(index.select(*KEYS)).distinct()


def merge_in_range(primary: DataFrame, index: DataFrame, time: TimeRange) -> DataFrame:
    """The merged messages of a time range, with the range at both scans.

    A filter on the merged time cannot pass the outer join, for the time may come from either
    side.  Here the primary is cut first and takes its texts from the index whatever their time;
    of the index alone only rows in the range are looked up among the primary's keys.
    """
    inside = primary.filter(time.holds(F.col("timestamp")))
    matched = index.join(inside.select(*KEYS), KEYS, "left_semi")
    orphans = index_orphans(primary, index.filter(time.holds(F.col("timestamp"))))
    return merge_primary_index(inside, matched.unionByName(orphans))
