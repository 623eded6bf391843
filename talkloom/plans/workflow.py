"""Three steps over immutable versions: snapshot, enrichment, reader."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions import texts, times
from talkloom.operators import enrich, snapshot
from talkloom.operators.paging import scope_hash
from talkloom.plans.commits import Commit, CommitLog, Part
from talkloom.sources.scratch import kept
from talkloom.sources.sinks import write_chunks, write_manifest


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def _log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, path, ("digests",))


def snapshot_records(spark: SparkSession, path: str, commit: Commit | None = None) -> DataFrame:
    """All records of the last commit, or of the one given; what a broken run left behind is not read."""
    log = _log(spark, path)
    commit = commit or log.latest()
    if not commit.version:
        raise ValueError("nothing has been exported yet")
    schema = T.StructType.fromJson(json.loads(commit.facts["schema"]))
    return _records(log, schema, commit.parts)


def _records(log: CommitLog, schema: T.StructType, parts: tuple[Part, ...] | list[Part]) -> DataFrame:
    found = log.spark.read.schema(schema).option("basePath", f"{log.path}/parts").parquet(*map(log.folder, parts))
    return found.select(*schema.names)


def _digests(log: CommitLog, commit: Commit) -> DataFrame:
    """The digests of all buckets as of a commit; those of its last part hold for the whole."""
    return log.spark.read.schema("chat_id string, day string, n bigint, digest string").parquet(f"{log.path}/digests/{commit.facts['digests']}")


def _write_part(log: CommitLog, new: DataFrame, digests: DataFrame) -> Part:
    part = Part(f"part={uuid.uuid4().hex}")
    new.write.partitionBy("day").parquet(log.folder(part))
    digests.write.parquet(f"{log.path}/digests/{part.name}")
    return part


def _rebased(log: CommitLog, part: Part, schema: T.StructType, base: Commit, latest: Commit) -> Part:
    """``part`` as it must be after what others have committed since ``base``: without records that
    they have added too, with ids of its own where theirs are the same, and digests over both."""
    bucket = ["chat_id", "day"]
    theirs = _records(log, schema, [p for p in latest.parts if p not in base.parts])
    mine = _records(log, schema, [part]).join(theirs.select("source", "fp"), ["source", "fp"], "left_anti")
    taken = theirs.select("source", "record_id", F.lit(True).alias("__taken")).distinct()
    clash = F.col("__taken").isNotNull() & F.col("base_record_id").isNull()
    mine = mine.join(taken, ["source", "record_id"], "left").withColumns({
        "base_record_id": F.when(clash, F.col("record_id")).otherwise(F.col("base_record_id")),
        "record_id": F.when(clash, F.concat_ws(":sha256:", "record_id", "fp")).otherwise(F.col("record_id")),
    })
    mine = kept(mine.select(*schema.names), "rebased")
    touched = mine.select(*bucket).distinct()
    both = _records(log, schema, latest.parts).unionByName(mine).join(touched, bucket, "left_semi")
    digests = _digests(log, latest).join(touched, bucket, "left_anti").unionByName(snapshot.bucket_digests(both))
    return _write_part(log, mine, digests)


def export_snapshot(messages: DataFrame, path: str, until: int | None = None, **scope) -> DataFrame:
    """Write the records that a snapshot of this scope lacks; returns the verdict on each bucket
    (chat, local day): same, added or grown.

    Records before ``until`` (seconds) are read, all of them if it is None.  Whole buckets are
    compared by digest; of those that differ, records are compared one by one: new ones are
    added, so a last day may grow, but a record that is gone or no longer the same is changed
    history and refused (ValueError), and so is a scope other than the snapshot's own.

    A run writes its records and the digests of all buckets as a part of its own and publishes both by
    one commit.  A run that breaks off before it leaves nothing that is read.  Several runs may be
    under way: the one that comes second puts its part on top of what has been committed meanwhile
    (:func:`_rebased`) and tries again, so each record is there once and none is lost.
    :func:`clean_snapshot` removes parts that were never committed.
    """
    spark, log = messages.sparkSession, _log(messages.sparkSession, path)
    own, base = scope_hash(**scope), log.latest()
    given = messages if until is None else messages.filter(F.col("timestamp") < until)
    rows = given.withColumn("day", times.local_day(F.col("timestamp"))).withColumn("fp", texts.fingerprint(*given.columns))
    rows = snapshot.resolve_collisions(snapshot.without_duplicates(rows, ["timestamp", "seq", "record_id"]))
    digests = kept(snapshot.bucket_digests(rows), "digests")
    bucket, one = ["chat_id", "day"], ["chat_id", "day", "source", "fp"]
    if not base.version:
        new, verdicts = rows, digests.select(*bucket, F.lit("added").alias("verdict"))
    else:
        if base.facts["scope"] != own:
            raise ValueError("the snapshot has another scope")
        verdicts = kept(snapshot.compare_digests(_digests(log, base), digests).replace("changed", "grown", "verdict"), "verdicts")
        grown = verdicts.filter("verdict = 'grown'").select(*bucket)
        before = snapshot_records(spark, path, base).join(grown, bucket, "left_semi").select(*one)
        lost = before.join(rows.select(*one), one, "left_anti")
        if verdicts.filter("verdict = 'removed'").limit(1).count() or lost.limit(1).count():
            raise ValueError("history has changed under the snapshot")
        new = rows.join(verdicts.filter("verdict IN ('added', 'grown')").select(*bucket), bucket, "left_semi").join(before, one, "left_anti")
    schema = new.schema
    part = _write_part(log, new, digests)
    for _ in range(20):
        counts = _records(log, schema, (*base.parts, part)).groupBy("source").agg(
            F.count("*").alias("rows"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"), F.lit(True).alias("complete")
        )
        facts = {"scope": own, "digests": part.name, "schema": schema.json(), "sources": [r.asDict() for r in counts.collect()]}  # a row a source
        if log.commit(base, (*base.parts, part), facts):
            return verdicts
        latest = log.latest()
        if latest.facts["scope"] != own:
            raise ValueError("the snapshot has another scope")
        part, base = _rebased(log, part, schema, base, latest), latest
    raise RuntimeError("other runs were always first")


def clean_snapshot(spark: SparkSession, path: str, older: float = 24 * 3600) -> list[str]:
    """Remove parts that no commit lists and that have not changed for ``older`` seconds."""
    log = _log(spark, path)
    return log.clean(keep=len(log.versions()), older=older)


def media_inventory(records: DataFrame, path: str, kinds: tuple[str, ...], before: int, resume: bool = False, **scope) -> DataFrame:
    """Metadata of records of some kinds before a time (exclusive), one part for each kind:
    returns the manifest (kind, rows, first_time, last_time).

    ``records`` (source, record_id, kind, timestamp, ...); repeated identities are one row.  A
    fresh inventory needs a fresh place.  With ``resume`` the scope and the time must be those of
    the saved one (further kinds may follow), every saved part must have as many rows as its
    manifest says and only rows of its kind, and complete parts are not written again.
    """
    spark, own = records.sparkSession, scope_hash(before=before, **scope)
    exists = _exists(spark, f"{path}/manifest")
    if exists != resume:
        raise ValueError("nothing to resume here" if resume else "choose a fresh place for the inventory")
    schema = "kind string, rows bigint, first_time bigint, last_time bigint, scope string"
    saved = {r["kind"]: r for r in spark.read.schema(schema).parquet(f"{path}/manifest").collect()} if resume else {}  # a row for each kind
    if any(r["scope"] != own for r in saved.values()) or set(saved) - set(kinds):
        raise ValueError("the saved inventory has another scope")
    if saved:
        found = spark.read.parquet(f"{path}/parts").groupBy("part").agg(F.count("*").alias("n"), F.count_if(~F.col("kind").eqNullSafe(F.col("part"))).alias("foreign"))
        sizes = {r["part"]: r for r in found.collect()}
        if any((sizes[k]["n"], sizes[k]["foreign"]) != (r["rows"], 0) if k in sizes else r["rows"] for k, r in saved.items()):
            raise ValueError("a saved part does not match its manifest")
    missing = [k for k in kinds if k not in saved]
    wanted = records.filter(F.col("kind").isin(*missing) & (F.col("timestamp") < before)).dropDuplicates(["source", "record_id", "kind", "timestamp"])
    wanted.withColumn("part", F.col("kind")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{path}/parts")
    if missing:
        written = spark.read.schema(wanted.schema.add("part", "string")).parquet(f"{path}/parts").filter(F.col("part").isin(*missing))
        counts = written.groupBy("part").agg(F.count("*").alias("rows"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))
        all_kinds = spark.createDataFrame([(k,) for k in missing], "part string").join(counts, "part", "left")
        state = all_kinds.select(F.col("part").alias("kind"), F.coalesce("rows", F.lit(0)).alias("rows"), "first_time", "last_time", F.lit(own).alias("scope"))
        state.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return spark.read.schema(schema).parquet(f"{path}/manifest").drop("scope")


def run_stages(candidates: DataFrame, ledger_path: str, stages: dict[str, Callable[[DataFrame], DataFrame]], recorded_at: int, **options) -> DataFrame:
    """Run each stage on what the ledger lacks, in order, and append the outcome.

    ``candidates`` (source, record_id, stage, version); a stage maps its candidates to (source,
    record_id, status).
    """
    spark = candidates.sparkSession
    schema = "source string, record_id string, stage string, version string, status string, recorded_at bigint"
    for name, run in stages.items():
        ledger = spark.read.schema(schema).parquet(ledger_path) if _exists(spark, ledger_path) else spark.createDataFrame([], schema)
        work = enrich.work_set(candidates.filter(F.col("stage") == name), ledger, **options)
        done = work.join(run(work), ["source", "record_id"], "left").select(
            "source", "record_id", "stage", "version", enrich.stage_status(F.col("status")).alias("status"), F.lit(recorded_at).cast("bigint").alias("recorded_at")
        )
        done.write.mode("append").parquet(ledger_path)
    return enrich.ledger_summary(enrich.ledger_latest(spark.read.schema(schema).parquet(ledger_path)))


def build_reader(records: DataFrame, path: str, size: int = 2000) -> bool:
    """Chunked reader data, built again only if any content of the records or an option has
    changed; returns whether it was."""
    spark = records.sparkSession
    contents = records.agg(snapshot.set_digest(texts.fingerprint(*records.columns))).first()[0]
    digest = scope_hash(contents=contents, columns=sorted(records.columns), size=size)
    if _exists(spark, f"{path}/input") and spark.read.parquet(f"{path}/input").first()["digest"] == digest:
        return False
    write_chunks(records, f"{path}/reader", ["timestamp", "source", "seq", "record_id"], size, overwrite=True)
    write_manifest(spark.createDataFrame([(digest,)], "digest string"), f"{path}/input")
    return True
