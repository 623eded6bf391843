"""Media references: files found, variants chosen, results reused by content."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions import texts
from talkloom.sources.scratch import kept

#: Folders of image files, best first.
FAMILIES = ("Ori", "OriTemp", "Thumb", "ThumbTemp")
HASH_NAME = r"(?i)^[a-f0-9]{16,64}\.(jpg|jpeg|png|gif|webp)$"
ENGINES = ("beam5", "beam1", "ctc")


def resolve_images(messages: DataFrame, files: DataFrame) -> DataFrame:
    """Image hints of messages (msg_id, month, hints) in an inventory (name, month, family, sha256,
    readable, path).

    Names that are hashes are looked up in every month, others in the message's own.  Files are
    summed up by name (and month) first, so a hint meets one row however many files share it.  The first
    family with a readable file counts; differing contents within it are ambiguous.  One row for
    each occurrence of a hint, repeated ones included: (msg_id, occurrence, hint, status, sha256,
    variant, matched_files).
    """
    hints = messages.select("msg_id", "month", F.posexplode("hints").alias("occurrence", "hint"))
    hashed = hints.withColumn("hashed", F.col("hint").rlike(HASH_NAME)).withColumn("key", F.lower("hint"))
    place = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family"))
    known = files.select(F.lower("name").alias("key"), F.col("month").alias("file_month"), place.alias("place"), F.when(F.col("readable"), F.col("sha256")).alias("sha256")).filter("place > 0")

    def verdicts(keys: list[str]) -> DataFrame:
        """One row for each name (and month): files in all, and the contents of its best family."""
        by_family = known.groupBy(*keys, "place").agg(F.count("*").alias("files"), F.min("sha256").alias("sha256"), F.max("sha256").alias("other"))
        best = F.min(F.when(F.col("sha256").isNotNull(), F.struct("place", (F.col("sha256") != F.col("other")).alias("several"), "sha256")))
        return by_family.groupBy(*keys).agg(best.alias("best"), F.sum("files").alias("matched_files"))

    anywhere = hashed.filter("hashed").join(verdicts(["key"]), "key", "left")
    same_month = hashed.filter("NOT hashed OR hashed IS NULL").join(verdicts(["key", "file_month"]).withColumnRenamed("file_month", "month"), ["key", "month"], "left")
    out = anywhere.unionByName(same_month)
    status = (
        F.when(F.col("matched_files").isNull(), "not_found").when(F.col("best").isNull(), "unreadable")
        .when(F.col("best.several"), "ambiguous_cache_files").otherwise("available")
    )
    ok = status == "available"
    return out.select(
        "msg_id", "occurrence", "hint", status.alias("status"), F.when(ok, F.col("best.sha256")).alias("sha256"),
        F.when(ok, F.when(F.col("best.place") >= 3, "thumbnail").otherwise("original")).alias("variant"), F.coalesce("matched_files", F.lit(0)).alias("matched_files"),
    )


def resolution_status(resolved: DataFrame) -> DataFrame:
    """By message: ok, partial or unavailable."""
    good = F.count_if(F.col("status") == "available")
    return resolved.groupBy("msg_id").agg(F.count("*").alias("hints"), good.alias("available"), F.when(good == F.count("*"), "ok").when(good > 0, "partial").otherwise("unavailable").alias("status"))


def best_variants(references: DataFrame) -> DataFrame:
    """One reference of each variant group (msg_id, variant_group): with a path, then most
    pixels, then no thumbnail, then the least reference."""
    pixels = F.coalesce(F.col("width"), F.lit(0)).cast("bigint") * F.coalesce(F.col("height"), F.lit(0))
    order = Window.partitionBy("msg_id", "variant_group").orderBy(
        F.col("path").isNotNull().desc(), pixels.desc(), (~F.col("variant").isin("thumbnail", "thumb")).desc(), "media_ref"
    )
    return references.withColumn("__r", F.row_number().over(order)).filter("__r = 1").drop("__r")


def image_references(records: DataFrame) -> DataFrame:
    """One row for each image of each record, with a stable reference path."""
    return records.select("source", "record_id", F.posexplode("images").alias("position", "image")).withColumn("media_ref", F.concat(F.lit("/images/"), "position"))


#: Kinds of nodes that are media.
MEDIA_KINDS = ("image", "sticker", "emoji", "voice", "video")


def media_nodes(records: DataFrame, payload: str, keys: tuple[str, ...], kinds: tuple[str, ...] = MEDIA_KINDS, most: int = 64) -> DataFrame:
    """Media nodes at any depth of JSON records: ``(keys, media_ref, depth, kind, node)``.

    A node is an object whose ``kind``, or ``kind_name`` if it has no ``kind``, says so; what is inside
    one is its own and not looked into.  ``media_ref`` is the node's path (``/a/0/b``, with ``~1`` for a
    slash and ``~0`` for a tilde in a name).  Records are walked level by level as variants; a level
    costs a job over what is left, and over ``most`` levels are an error (ValueError).  Null payloads
    and texts that are no JSON have no nodes.
    """
    spark = records.sparkSession
    left = records.select(*keys, F.lit("").alias("media_ref"), F.try_parse_json(F.col(payload).cast("string")).alias("node")).filter("node IS NOT NULL")
    own = F.variant_get("node", "$.kind", "variant")
    kind = F.when(own.isNotNull(), F.try_variant_get("node", "$.kind", "string")).otherwise(F.try_variant_get("node", "$.kind_name", "string"))
    is_object = F.schema_of_variant("node").startswith("OBJECT")
    out = None
    for depth in range(most + 1):
        # variants are written as text between levels, parsed once each
        level = left.withColumn("kind", F.when(is_object, kind))
        is_media = F.coalesce(F.col("kind").isin(*kinds), F.lit(False))
        found = level.filter(is_media).select(*keys, "media_ref", F.lit(depth).alias("depth"), "kind", F.to_json("node").alias("node"))
        out = found if out is None else out.unionByName(found)
        inner = level.filter(~is_media).lateralJoin(spark.tvf.variant_explode(F.col("node").outer()))
        name = F.coalesce(F.replace(F.replace(F.col("key"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")), F.col("pos").cast("string"))
        children = inner.select(*[level[k] for k in keys], F.concat("media_ref", F.lit("/"), name).alias("media_ref"), F.to_json("value").alias("text"))
        children = kept(children.filter(F.substring("text", 1, 1).isin("{", "[")), "nodes")
        if not children.limit(1).count():
            return out
        left = children.select(*keys, "media_ref", F.parse_json("text").alias("node"))
    raise ValueError(f"records are nested over {most} levels deep")


def match_name_variants(hints: DataFrame, files: DataFrame, most: int | None = None) -> DataFrame:
    """Hints (hint) to files (name, bytes) by stem, whatever the size suffix or case: originals
    first, then larger files; with ``most``, the best of each hint only.

    Files are ranked once for their stem, before hints meet them.
    """
    stem = lambda c: F.lower(F.regexp_replace(F.regexp_replace(c, r"\.[^.]*$", ""), "(_0|_720)$", ""))
    original = ~F.lower(F.col("name")).rlike(r"(_720|_thumb|thumb)")
    order = Window.partitionBy("stem").orderBy(F.desc("original"), F.desc("bytes"), "name")
    ranked = files.select("name", "bytes", stem(F.col("name")).alias("stem"), original.alias("original")).withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    return hints.select("hint", stem(F.col("hint")).alias("stem")).distinct().join(ranked, "stem").select("hint", "name", "bytes", "original", "rank")


def match_resources(messages: DataFrame, resources: DataFrame, extra: tuple[str, ...] = ("digest",)) -> DataFrame:
    """Resources to messages on (chat, server id or '0', local id, time); differing digests make
    the identity ambiguous."""
    keys = ["chat_id", "server_id", "local_id", "timestamp"]
    clean = lambda df: df.withColumns({"server_id": F.coalesce(F.nullif(F.col("server_id").cast("string"), F.lit("")), F.lit("0")), "local_id": F.col("local_id").cast("string")})
    found = clean(resources).groupBy(*keys).agg(F.count_distinct(*extra).alias("contents"), *[F.min(c).alias(c) for c in extra])
    joined = clean(messages).join(found, keys, "left")
    status = F.when(F.col("contents").isNull(), "not_found").when(F.col("contents") > 1, "identity_ambiguous").otherwise("ok")
    return joined.withColumn("status", status).withColumns({c: F.when(F.col("status") == "ok", F.col(c)) for c in extra}).drop("contents")


def match_digests(wanted: DataFrame, files: DataFrame, links: DataFrame) -> DataFrame:
    """Stickers and images (ref_id, md5, resource_id) to files (md5, path, bytes): equal content,
    else files linked (resource_id, path) to the resource; the largest first.

    The best file of each content and of each resource is taken before any reference meets it, so a
    reference costs two rows, however many files share its content.
    """
    largest = F.min(F.struct((-F.coalesce(F.col("bytes"), F.lit(-1))).alias("order"), "path"))["path"]
    by_content = files.groupBy("md5").agg(largest.alias("same"))
    paths = files.groupBy("path").agg(F.max("bytes").alias("bytes"))
    by_link = links.join(paths, "path").groupBy("resource_id").agg(largest.alias("linked"))
    both = wanted.distinct().join(by_content, "md5", "left").join(by_link, "resource_id", "left")
    evidence = F.when(F.col("same").isNotNull(), "content").otherwise("resource")
    return both.select("ref_id", F.coalesce("same", "linked").alias("path"), evidence.alias("evidence")).filter("path IS NOT NULL")


def match_videos(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Videos (ref_id, resource_id, month) to files (resource_id, month, path, is_cover): that of
    the month before that of the latest other; a cover is no video and is given beside it.

    Files are summed up by resource and month first, so a resource with many files costs a row.
    """
    own = lambda cover: F.min(F.when(F.col("is_cover") == cover, F.col("path")))
    of_month = files.groupBy("resource_id", "month").agg(own(False).alias("video"), own(True).alias("cover"))
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("month"))).alias(f"any_{c}")
    of_any = of_month.groupBy("resource_id").agg(latest("video"), latest("cover"))
    joined = wanted.join(of_any, "resource_id").join(of_month, ["resource_id", "month"], "left")
    return joined.select("ref_id", F.coalesce("video", "any_video").alias("video"), F.coalesce("cover", "any_cover").alias("cover"))


AUDIO_NAME = r"^([0-9a-f]{32})_(\d+)_(\d+)_(\d+)(?:_([A-Za-z0-9]+))?\.[a-z0-9]+$"
#: Fixed value: endings of audio files, the most trusted first.
AUDIO_ENDINGS = (".wav", ".flac", ".silk", ".mp3", ".ogg", ".m4a", ".amr", ".opus", ".aac")
_IDENTITY = ("chat_md5", "local_id", "timestamp", "server_id")


def named_audio(files: DataFrame) -> DataFrame:
    """Columns of ``files`` (name, ...) with the identity that an audio name of the cache says; null
    for other names."""
    part = lambda i: F.nullif(F.regexp_extract("name", AUDIO_NAME, i), F.lit(""))
    return files.withColumns({"chat_md5": part(1), "local_id": part(2), "timestamp": part(3).cast("bigint"), "server_id": part(4)})


def _identified(messages: DataFrame) -> DataFrame:
    text = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    return messages.select("msg_ref", F.md5(text("chat_id")).alias("chat_md5"), text("local_id").alias("local_id"), F.col("timestamp").cast("bigint").alias("timestamp"), text("server_id").alias("server_id"))


def match_audio(messages: DataFrame, files: DataFrame) -> DataFrame:
    """Voice messages (msg_ref, chat_id, server_id, local_id, timestamp) to cached audio (name,
    sha256) whose name says ``md5(chat)_local_time_server[_account].ext``; differing contents
    are ambiguous."""
    parsed = named_audio(files.select("name", "sha256")).filter("chat_md5 IS NOT NULL")
    found = _identified(messages).join(parsed, list(_IDENTITY), "left").groupBy("msg_ref").agg(F.count_distinct("sha256").alias("n"), F.min("sha256").alias("sha256"))
    return found.select("msg_ref", F.when(F.col("n") == 0, "not_found").when(F.col("n") > 1, "ambiguous").otherwise("ok").alias("status"), F.when(F.col("n") == 1, F.col("sha256")).alias("sha256"))


def resolve_audio(messages: DataFrame, paths: DataFrame, files: DataFrame) -> DataFrame:
    """The audio of voice messages (msg_ref, chat_id, server_id, local_id, timestamp): a path that the
    message itself names (``paths``: msg_ref, path, rank), else the cache by its exact name.

    ``files`` (path, sha256) are those that can be read.  A named path counts if it is local, has an
    audio ending and is one of them; a name of the cache must say the message's own identity, whole.
    Of the paths of the least rank those with the most trusted ending count; they must have one
    content.  One row a message: (msg_ref, status, path, sha256, evidence, reason) with status ok,
    ambiguous, identity_unavailable (nothing named, and an identity with gaps) or not_found; the
    shortest path of the content is given.
    """
    who = _identified(messages)
    whole = F.lit(True)
    for c in _IDENTITY:
        whole = whole & F.col(c).isNotNull()
    ending = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    usable = (texts.path_kind(F.col("path")) == "local") & ending.isin(*AUDIO_ENDINGS)
    known = named_audio(files.dropDuplicates(["path"]).withColumn("name", F.regexp_extract("path", r"([^/\\]+)$", 1)))
    place = F.array_position(F.array(*map(F.lit, AUDIO_ENDINGS)), ending)
    said = [F.col(c).alias(f"file_{c}") for c in _IDENTITY]
    # what messages name themselves: equal on the path, a few rows a message
    tried = paths.select("msg_ref", "path", "rank").filter(usable).distinct().join(known.select("path", "sha256", *said), "path").join(who, "msg_ref")
    matches = F.lit(True)
    for c in _IDENTITY:
        matches = matches & (F.col(c) == F.col(f"file_{c}"))
    cached = F.col("file_chat_md5").isNotNull()
    reason = F.when(cached & ~whole, "cache_identity_incomplete").when(cached & ~F.coalesce(matches, F.lit(False)), "cache_identity_mismatch")
    judged = tried.withColumn("reason", reason).withColumn("place", place)
    shortest = F.min(F.struct(F.length("path").alias("size"), "path"))["path"].alias("path")
    content = [F.min("sha256").alias("sha256"), F.max("sha256").alias("other"), shortest]
    named = judged.filter("reason IS NULL").groupBy("msg_ref", "rank", "place").agg(*content)
    named = named.groupBy("msg_ref").agg(F.min(F.struct("rank", "place", "sha256", "other", "path")).alias("named"))
    refused = judged.filter("reason IS NOT NULL").groupBy("msg_ref").agg(F.min("reason").alias("refused"))
    by_name = known.filter("chat_md5 IS NOT NULL").groupBy(*_IDENTITY).agg(*content).select(*_IDENTITY, F.struct("sha256", "other", "path").alias("cache"))
    found = who.join(named, "msg_ref", "left").join(refused, "msg_ref", "left").join(by_name, list(_IDENTITY), "left")
    one = lambda side: F.struct(F.col(f"{side}.sha256"), F.col(f"{side}.other"), F.col(f"{side}.path"), F.lit("message" if side == "named" else "cache").alias("evidence"))
    found = found.withColumn("best", F.when(F.col("named").isNotNull(), one("named")).when(F.col("cache").isNotNull(), one("cache"))).withColumn("whole", whole)
    status = F.when(F.col("best").isNotNull(), F.when(F.col("best.sha256") == F.col("best.other"), "ok").otherwise("ambiguous")).when(~F.col("whole"), "identity_unavailable").otherwise("not_found")
    ok = F.col("status") == "ok"
    return found.withColumn("status", status).select(
        "msg_ref", "status", F.when(ok, F.col("best.path")).alias("path"), F.when(ok, F.col("best.sha256")).alias("sha256"), F.when(ok, F.col("best.evidence")).alias("evidence"),
        F.when(F.col("best").isNull(), F.col("refused")).alias("reason"),
    )


def reuse_transcripts(audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    """The stored transcript of each recording (audio_sha256, model_rev), best engine first."""
    place = F.array_position(F.array(*map(F.lit, ENGINES)), F.col("engine"))
    order = Window.partitionBy("audio_sha256", "model_rev").orderBy(place, "text")
    stored = transcripts.filter((F.col("status") == "ok") & (place > 0)).withColumn("__r", F.row_number().over(order)).filter("__r = 1").drop("__r", "status")
    return audio.distinct().join(stored, ["audio_sha256", "model_rev"], "left").withColumn("cached", F.col("engine").isNotNull())


def stitch_tiles(tiles: DataFrame, most: int = 10) -> DataFrame:
    """Text of an image from its tiles (image, index, x0, y0, x1, y1, raw_text).

    Between vertical neighbours the longest run of whole lines (at most ``most``) that ends one
    and begins the other is dropped from the second.
    """
    order = Window.partitionBy("image").orderBy("index")
    rows = tiles.withColumn("lines", F.split(F.coalesce("raw_text", F.lit("")), r"\r?\n"))
    for c in ("x0", "x1", "y0", "y1", "lines"):
        rows = rows.withColumn(f"p_{c}", F.lag(c).over(order))
    near = (F.col("x0") == F.col("p_x0")) & (F.col("x1") == F.col("p_x1")) & (F.col("p_y0") < F.col("y0")) & (F.col("y0") < F.col("p_y1"))
    bare = lambda c: F.transform(c, lambda x: F.trim(x))
    before, after = bare(F.col("p_lines")), bare(F.col("lines"))
    room = F.least(F.lit(most), F.size("p_lines"), F.size("lines"))
    match = F.filter(
        F.sequence(F.lit(1), F.greatest(room, F.lit(1))),
        lambda n: (n <= room) & (F.slice(before, F.size(before) - n + 1, n) == F.slice(after, F.lit(1), n)) & F.exists(F.slice(after, F.lit(1), n), lambda x: x != ""),
    )
    overlap = F.when(F.coalesce(near, F.lit(False)), F.coalesce(F.array_max(match), F.lit(0))).otherwise(0)
    cut = rows.withColumn("overlap", overlap).withColumn("kept", F.slice("lines", F.col("overlap") + 1, F.greatest(F.size("lines"), F.lit(1))))
    merged = cut.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("index", "kept"))).alias("parts"), F.sum("overlap").alias("removed"))
    return merged.select("image", F.array_join(F.flatten(F.transform("parts", lambda p: p["kept"])), "\n").alias("text"), "removed")


def by_content(items: DataFrame, cache: DataFrame, engine: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, key: str = "sha256") -> DataFrame:
    """Run ``engine`` once for each distinct content that the cache (key, status, ...) lacks.

    Only successes of the cache count.  The engine is any function on batches: a decoder, text
    or speech recognition.  Returns the new results; append them to the cache.
    """
    good = cache.filter(F.col("status").isin("ok", "no_text")).select(key)
    work = items.dropDuplicates([key]).join(good, key, "left_anti")
    return work.mapInPandas(engine, schema)


def second_hearing(results: DataFrame, suspicious, engine, schema: str) -> DataFrame:
    """A second engine for results that a rule finds suspicious; the others stay."""
    again = results.filter(suspicious).mapInPandas(engine, schema)
    return results.filter(~F.coalesce(suspicious, F.lit(False))).unionByName(again, allowMissingColumns=True)


def safe_references(messages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """References (record_id, media_ref, path) whose file failed (path, verdict) lose their path."""
    joined = messages.join(verdicts, "path", "left")
    bad = F.coalesce(F.col("verdict") != "available", F.lit(True))
    return joined.select(
        "record_id", "media_ref", F.when(~bad, F.col("path")).alias("path"), F.when(bad, F.concat(F.lit("unavailable_"), F.coalesce("verdict", F.lit("unchecked")))).alias("unavailable")
    )


def jobs(requests: DataFrame, key: str = "audio_sha256") -> DataFrame:
    """One job for each content, however many requests ask for it."""
    return requests.groupBy(key).agg(F.count("*").alias("requests"), F.min("request_id").alias("first_request"))


def refresh_missing(messages: DataFrame, have: DataFrame, resources: DataFrame) -> DataFrame:
    """Resources for those messages (record_id, identity columns) that have no media yet."""
    return match_resources(messages.join(have.select("record_id").distinct(), "record_id", "left_anti"), resources)
