"""All registered queries over the driver tables, with the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkloom.catalog import media, people, reads, rules, shown, snapshots, stores

_PARTS = (reads, people, snapshots, media, rules, stores, shown)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest page of the merged timeline."""
    return reads.timeline_page(spark, sf_dir)
