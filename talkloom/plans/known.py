"""Which records earlier versions have: Bloom filters of their fingerprints, then an exact check.

Fingerprints are dealt into a fixed number of buckets by their first digits, so filters of all versions
line up.  New fingerprints meet the filters of their bucket, not the fingerprints of every version; the
few that pass are looked up, each in the version whose filter let it pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators.snapshot import without_duplicates
from talkloom.plans.commits import CommitLog, Part, merge_levels

#: Hexadecimal digits of a fingerprint that give its bucket.
DIGITS = 3
#: Bits of a filter for each fingerprint (rounded up to a power of two in all) and hashes of it.
BITS, HASHES = 10, 7


def places(fps: pd.Series, bits: int) -> np.ndarray:
    """The bits of fingerprints (rows) by hash (columns), from digits that the bucket does not use."""
    one, two = (np.array([int(f[a : a + 15], 16) for f in fps], np.uint64) for a in (8, 24))
    steps = np.arange(HASHES, dtype=np.uint64)
    return (one[:, None] + steps * (two | np.uint64(1))[:, None]) % np.uint64(bits)


def make_filter(fps: pd.Series) -> bytes:
    bits = 1 << max(6, int(BITS * len(fps) - 1).bit_length())
    table = np.zeros(bits, bool)
    table[places(fps, bits).ravel().astype(np.int64)] = True
    return np.packbits(table, bitorder="little").tobytes()


def passing(fps: pd.Series, stored: bytes) -> np.ndarray:
    table = np.unpackbits(np.frombuffer(stored, np.uint8), bitorder="little").view(bool)
    return table[places(fps, len(table)).astype(np.int64)].all(axis=1) if len(fps) else np.zeros(0, bool)


def _bucket():
    return F.substring("fp", 1, DIGITS).alias("bucket")


class KnownRecords:
    """Fingerprints (hexadecimal SHA-256, by source) of what has been committed below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, CommitLog(spark, path, ("filters",))

    def _write(self, records: DataFrame, level: int = 0, first: int = 0, last: int = 0) -> Part:
        fps = records.select("source", "fp").distinct().withColumn("bucket", _bucket())
        part = self.log.write(fps.repartitionByRange("bucket", "fp").sortWithinPartitions("bucket", "fp"), level, first, last)

        def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame([[*key, make_filter(group["fp"]), len(group)]], columns=["source", "bucket", "filter", "n"])

        stored = self.spark.read.schema(fps.schema).parquet(self.log.folder(part))
        made = stored.groupBy("source", "bucket").applyInPandas(build, "source string, bucket string, filter binary, n bigint")
        made.write.parquet(f"{self.log.path}/filters/{part.name}")
        return part

    def add(self, records: DataFrame) -> None:
        """Commit the fingerprints of ``records`` (source, fp, ...) as a version."""
        part = self._write(records)

        def append(commit):
            turn = max((p.last for p in commit.parts), default=0) + 1
            return (*commit.parts, Part(part.name, 0, turn, turn)), commit.facts

        self.log.update(append)

    def merge(self, fan: int = 8) -> None:
        """Merge versions by level, so that a fingerprint meets few filters."""
        merge_levels(self.log, lambda old, *place: self._write(self.log.frame(old), *place), fan)

    def candidates(self, records: DataFrame) -> DataFrame:
        """``(source, fp, part)``: fingerprints that the filter of a part lets pass.

        Fingerprints are made distinct first, which tasks do on their own rows, so one that a third
        of all rows have costs a row a task; buckets are even, as fingerprints are hashes.
        """
        parts = self.log.latest().parts
        fps = records.select("source", "fp").distinct().withColumn("bucket", _bucket())
        if not parts:
            return fps.select("source", "fp", F.lit("").alias("part")).limit(0)
        filters = self.spark.read.schema("source string, bucket string, filter binary, n bigint").parquet(*[f"{self.log.path}/filters/{p.name}" for p in parts])
        filters = filters.withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), "/filters/([0-9a-f]+)/", 1))

        def probe(key: tuple, new: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            hits = [new.loc[passing(new["fp"], f), ["source", "fp"]].assign(part=p) for f, p in zip(held["filter"], held["part"], strict=True)] if len(new) else []
            return pd.concat(hits) if hits else pd.DataFrame([], columns=["source", "fp", "part"])

        return fps.groupBy("source", "bucket").cogroup(filters.groupBy("source", "bucket")).applyInPandas(probe, "source string, fp string, part string")

    def known(self, records: DataFrame) -> DataFrame:
        """``(source, fp)``: fingerprints that have been committed before, exactly."""
        parts = self.log.latest().parts
        passed = self.candidates(records)
        if not parts:
            return passed.select("source", "fp")
        stored = self.log.frame(parts).withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), "/parts/([0-9a-f]+)/", 1))
        return passed.join(stored.select("source", "fp", "part"), ["source", "fp", "part"], "left_semi").select("source", "fp").distinct()

    def new_records(self, records: DataFrame, order: list[str]) -> DataFrame:
        """The first record of each fingerprint that no version has had: duplicates within ``records``
        go first, then those of earlier versions.  Records without a fingerprint stay out."""
        first = without_duplicates(records.filter("fp IS NOT NULL AND source IS NOT NULL"), order)
        return first.join(self.known(records.filter("fp IS NOT NULL AND source IS NOT NULL")), ["source", "fp"], "left_anti").select(*records.columns)
