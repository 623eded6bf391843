"""Enrichment: updates merged under proof of identity, and a ledger of stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ("source", "chat_id", "message_id", "local_id", "timestamp", "account_id")
IMMUTABLE = ("chat_type", "sender_id", "direction", "kind", "time")


def contradicts(a: Column, b: Column) -> Column:
    """Both known, and different."""
    return F.coalesce(a.cast("string") != b.cast("string"), F.lit(False))


def conflicting_updates(updates: DataFrame, keys: tuple[str, ...] = ("source", "record_id")) -> DataFrame:
    """Updates with their ``status``: identical ones collapse, differing ones for a key are refused.

    ``updates`` has a text column ``patch``, canonical JSON.
    """
    counted = updates.groupBy(*keys).agg(F.count("*").alias("given"), F.count_distinct("patch").alias("kinds"), F.min("patch").alias("patch"))
    return counted.select(*keys, "given", F.when(F.col("kinds") > 1, "conflict").otherwise("ok").alias("status"), F.when(F.col("kinds") == 1, F.col("patch")).alias("patch"))


def merge_updates(base: DataFrame, updates: DataFrame, derived: tuple[str, ...], keys: tuple[str, ...] = ("source", "record_id")) -> DataFrame:
    """Derived columns patched where an update has them; source facts never change.

    ``updates`` may repeat immutable columns; an update that contradicts one is refused as a
    whole (``update_status``: none, merged, refused).  Warnings are added, not replaced.  An
    update's column that is null leaves the base as it is.
    """
    claims = [c for c in (*IDENTITY, *IMMUTABLE) if c in base.columns and c in updates.columns and c not in keys]
    renamed = updates.withColumnsRenamed({c: f"__u_{c}" for c in updates.columns if c not in keys}).withColumn("__given", F.lit(True))
    both = base.join(renamed, list(keys), "left")
    refused = F.lit(False)
    for c in claims:
        refused = refused | contradicts(F.col(c), F.col(f"__u_{c}"))
    given = F.coalesce(F.col("__given"), F.lit(False))
    taken = given & ~refused
    out = both.withColumn("update_status", F.when(~given, "none").when(refused, "refused").otherwise("merged"))
    for c in derived:
        new = F.col(f"__u_{c}")
        out = out.withColumn(c, F.when(taken & new.isNotNull(), new).otherwise(F.col(c) if c in base.columns else F.lit(None)))
    if "warnings" in base.columns and "warnings" in updates.columns:
        old = F.coalesce("warnings", F.array().cast("array<string>"))
        new = F.coalesce(F.col("__u_warnings"), F.array().cast("array<string>"))
        out = out.withColumn("warnings", F.when(taken, F.array_distinct(F.concat(old, new))).otherwise(F.col("warnings")))
    return out.drop("__given", *[c for c in renamed.columns if c.startswith("__u_")])


def match_identities(patches: DataFrame, messages: DataFrame) -> DataFrame:
    """Patches (patch_id and identity columns) to messages by chat, time and a native id.

    Any known field that differs vetoes; patches without chat, time or id are skipped; more
    than one match is ambiguous.  An equality join for each native id, with chat and time; a
    message that a patch has met by one id is not met again by the next.
    """
    have = [c for c in IDENTITY if c in patches.columns and c in messages.columns]
    full = F.col("chat_id").isNotNull() & F.col("timestamp").isNotNull() & (F.col("message_id").isNotNull() | F.col("local_id").isNotNull())
    asked = patches.select("patch_id", full.alias("full"), *have)
    p, m = asked.filter("full").alias("p"), messages.select("record_id", *have).alias("m")
    consistent, met, found = F.lit(True), F.lit(False), None
    for c in have:
        if c not in ("chat_id", "timestamp"):
            consistent = consistent & ~contradicts(F.col(f"p.{c}"), F.col(f"m.{c}"))
    for c in (c for c in ("message_id", "local_id") if c in have):
        same = [F.col(f"p.{k}") == F.col(f"m.{k}") for k in ("chat_id", "timestamp", c)]
        part = p.join(m, same).filter(consistent & ~met).select("p.patch_id", "m.record_id")
        met = met | F.coalesce(F.col(f"p.{c}") == F.col(f"m.{c}"), F.lit(False))
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("patch_id").agg(F.count("*").alias("matches"), F.min("record_id").alias("record_id"))
    out = asked.select("patch_id", "full").join(hits, "patch_id", "left")
    n = F.coalesce("matches", F.lit(0))
    status = F.when(~F.col("full"), "skipped").when(n == 0, "not_found").when(n > 1, "ambiguous").otherwise("matched")
    return out.select("patch_id", status.alias("status"), F.when(status == "matched", F.col("record_id")).alias("record_id"))


def work_set(candidates: DataFrame, ledger: DataFrame, refresh: bool = False, retry_failed: bool = False) -> DataFrame:
    """What is left to do: candidates (source, record_id, stage, version) that the ledger
    (the same and status, recorded_at) does not have in this version.

    The latest entry of a key counts; with ``retry_failed`` only ``ok`` ones are done.
    """
    if refresh:
        return candidates
    keys = ["source", "record_id", "stage"]
    latest = ledger.groupBy(*keys).agg(F.max_by(F.struct("version", "status"), "recorded_at").alias("l")).select(*keys, "l.version", "l.status")
    done = latest.filter("status = 'ok'") if retry_failed else latest
    return candidates.join(done.select(*keys, "version"), [*keys, "version"], "left_anti")


def stage_status(status: Column) -> Column:
    """Outcome of a stage as the ledger keeps it."""
    word = F.lower(F.coalesce(status, F.lit("")))
    return F.when(word.isin("ok", "no_text", "available", "cached"), "ok").when(word.isin("unsupported", "not_applicable"), "unsupported").otherwise("failed")


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Counts by stage and status, and whether all stages ended without errors."""
    counts = ledger.groupBy("stage", "status").agg(F.count("*").alias("n"))
    errors = ledger.agg(F.coalesce(F.count_if(F.col("status") == "failed"), F.lit(0)).alias("errors"))  # one row
    return counts.crossJoin(F.broadcast(errors)).select("stage", "status", "n", F.when(F.col("errors") > 0, "complete_with_errors").otherwise("complete").alias("state"))


def missing_assets(metadata: DataFrame, missing: DataFrame) -> DataFrame:
    """Assets to fetch: metadata (digest, identity, url, created) of identities known to be
    missing, one row a digest with its identities and the newest usable address."""
    own = metadata.join(missing.select("identity").distinct(), "identity", "left_semi")
    usable = F.col("url").rlike("^https?://")
    return own.groupBy("digest").agg(
        F.array_sort(F.collect_set("identity")).alias("identities"), F.max_by("url", F.when(usable, F.struct("created", "url"))).alias("url"), F.count("*").alias("uses")
    )


def new_groups(groups: DataFrame, attempts: DataFrame) -> DataFrame:
    """Groups never attempted; earlier attempts, also failed ones, are not repeated."""
    return groups.join(attempts.select("digest").distinct(), "digest", "left_anti")


def asset_summary(references: DataFrame) -> DataFrame:
    return references.agg(
        F.count("*").alias("references"), F.count_distinct("digest").alias("digests"), F.count_if("available").alias("available_references"),
        F.count_distinct(F.when(F.col("available"), F.col("digest"))).alias("available_files"),
    )


def order_agrees(full: DataFrame, view: DataFrame, identity: str) -> DataFrame:
    """Two views of the same rows by position: how many places disagree."""
    both = full.select("position", F.col(identity).alias("a")).join(view.select("position", F.col(identity).alias("b")), "position", "full_outer")
    return both.agg(F.count("*").alias("places"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("mismatches"))


def ledger_latest(ledger: DataFrame) -> DataFrame:
    order = Window.partitionBy("source", "record_id", "stage").orderBy(F.desc("recorded_at"))
    return ledger.withColumn("__r", F.row_number().over(order)).filter("__r = 1").drop("__r")
