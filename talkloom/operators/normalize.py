"""From source rows to one message schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions import texts, times

#: The core schema of a message, in order.
MESSAGE_COLUMNS = (
    "source", "chat_id", "message_id", "record_id", "time", "timestamp", "seq", "sender_id", "sender_name", "direction",
    "identity_status", "kind", "text",
)
CONFLICT = "sender_identity_conflict"


def select_or_null(df: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Columns renamed and cast, ``{name: (source column, type)}``; those that are absent are null."""
    return df.select(
        *[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(name) for name, (c, t) in wanted.items()]
    )


def _sealed(df: DataFrame, source: str, parts: dict[str, Column], reported: Column, warnings: Column) -> DataFrame:
    """The conflict rule, then the core columns."""
    conflict = F.coalesce(F.exists(warnings, lambda w: w.contains(CONFLICT)), F.lit(False))
    status = F.coalesce(reported, F.when(texts.filled(parts["sender_id"]).isNull(), "unknown").otherwise("reported"))
    parts |= {
        "source": F.lit(source),
        "sender_id": F.when(~conflict, parts["sender_id"]),
        "sender_name": F.when(conflict, "unknown").otherwise(parts["sender_name"]),
        "direction": F.when(conflict, "unknown").otherwise(parts["direction"]),
        "identity_status": F.when(conflict, "conflict").otherwise(status),
        "text": F.coalesce(parts["text"], F.lit("")),
        "time": F.coalesce(parts["time"], times.local_time(parts["timestamp"])),
    }
    return df.select(*[parts[c].alias(c) for c in MESSAGE_COLUMNS])


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def normalize_nested(df: DataFrame, source: str = "w") -> DataFrame:
    """Rows with ``id{server_id_str, local_id}, chat_id, create_time, sender_wxid, sender,
    is_from_me, kind, text`` and, if there, ``warnings``, ``time_iso``, ``identity_status``."""
    local = F.col("id.local_id").cast("string")
    message = F.coalesce(F.nullif(F.col("id.server_id_str"), F.lit("")), F.nullif(local, F.lit("0")), F.lit(""))
    sender = F.nullif(F.col("sender_wxid").cast("string"), F.lit(""))
    direction = F.when(F.col("is_from_me"), "outgoing").when(~F.col("is_from_me"), "incoming").otherwise("unknown")
    parts = {
        "chat_id": F.col("chat_id").cast("string"), "message_id": message,
        "record_id": F.concat_ws(":", F.col("chat_id").cast("string"), message, F.coalesce(local, F.lit("")), F.coalesce(F.col("create_time").cast("string"), F.lit("None")), F.coalesce("kind", F.lit(""))),
        "time": _or_null(df, "time_iso", "string"), "timestamp": F.col("create_time").cast("bigint"), "seq": F.col("id.local_id").cast("bigint"),
        "sender_id": sender, "sender_name": F.col("sender").cast("string"), "kind": F.col("kind"), "text": F.col("text"),
        "direction": F.when(sender.isNull() & (F.col("kind") == "system"), "system").otherwise(direction),
    }
    return _sealed(df, source, parts, _or_null(df, "identity_status", "string"), _or_null(df, "warnings", "array<string>"))


def normalize_flat(df: DataFrame, source: str = "q") -> DataFrame:
    """Decoded rows with ``chat_id, msg_id, timestamp, seq, sender_uid, sender_uin, sender,
    direction, kind, text`` and, if there, ``warnings``, ``time``, ``identity_status``."""
    message = F.coalesce(F.col("msg_id").cast("string"), F.lit(""))
    direction = F.when(F.col("direction") == "from_me", "outgoing").when(F.col("direction").isin("from_contact", "from_member"), "incoming")
    parts = {
        "chat_id": F.col("chat_id").cast("string"), "message_id": message, "record_id": F.concat_ws(":", F.col("chat_id").cast("string"), message),
        "time": _or_null(df, "time", "string"), "timestamp": F.col("timestamp").cast("bigint"), "seq": F.col("seq").cast("bigint"),
        "sender_id": F.coalesce(F.nullif(F.col("sender_uid").cast("string"), F.lit("")), F.nullif(F.col("sender_uin").cast("string"), F.lit(""))),
        "sender_name": F.col("sender"), "kind": F.col("kind"), "text": F.col("text"), "direction": F.coalesce(direction, F.lit("unknown")),
    }
    return _sealed(df, source, parts, _or_null(df, "identity_status", "string"), _or_null(df, "warnings", "array<string>"))


def resolved_text(index: Column, aux: Column, payload: Column, prompt: Column) -> tuple[Column, Column]:
    """Text by the first source that has any, and the name of that source."""
    steps = [("fts", texts.compact_text(index)), ("fts_aux", texts.compact_text(aux)), ("payload.45101", payload), ("recall.prompt", prompt)]
    found, source = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, column in reversed(steps):
        has = F.coalesce(column, F.lit("")) != ""
        found, source = F.when(has, column).otherwise(found), F.when(has, name).otherwise(source)
    return F.coalesce(found, F.lit("")), source


def contact_name(remark: Column, nick: Column, uin: Column, uid: Column) -> Column:
    return F.coalesce(texts.first_filled(remark, nick, uin, uid), F.lit(""))


def member_name(card: Column, nick: Column, alias: Column, uid: Column, uin: Column) -> Column:
    return texts.first_filled(card, nick, alias, uid, uin)


def canonical_chat_id(kind: Column, uid: Column, group_id: Column, discuss_id: Column, other: Column) -> Column:
    """A private chat has its uid or none at all; other chats fall back on another id."""
    return (
        F.when(kind == "private", texts.filled(uid)).when(kind == "group", texts.first_filled(group_id, other))
        .when(kind == "discuss", texts.first_filled(discuss_id, other)).otherwise(texts.filled(other))
    )


def source_facts(df: DataFrame, derived: tuple[str, ...], voice_text: str = "original_voice_text") -> DataFrame:
    """Only what the source said: derived columns and warnings dropped, spoken text as it came."""
    if voice_text in df.columns:
        df = df.withColumn("text", F.coalesce(voice_text, "text"))
    return df.drop(*derived, "warnings", voice_text)


def attach_transcripts(messages: DataFrame, transcripts: DataFrame, label: str = "[voice] ") -> DataFrame:
    """``transcripts`` (record_id, status, transcript): those that are ok become the text, with a
    label; the original text is kept aside and warnings about a missing transcript go."""
    joined = messages.join(transcripts.select("record_id", "status", "transcript"), "record_id", "left")
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    out = joined.withColumn("original_voice_text", F.when(ok, F.col("text"))).withColumn(
        "text", F.when(ok, F.concat(F.lit(label), F.col("transcript"))).otherwise(F.col("text"))
    )
    if "warnings" in messages.columns:
        out = out.withColumn("warnings", F.when(ok, F.filter("warnings", lambda w: ~w.contains("transcript"))).otherwise(F.col("warnings")))
    return out.drop("status", "transcript")


def stages_for(category: Column, references: Column) -> Column:
    """Enrichment stages that apply to a row."""
    return F.array_compact(
        F.array(
            F.when(~category.isin("voice", "video"), F.lit("media")), F.when(category == "voice", F.lit("voice")),
            F.when(category == "video", F.lit("video")), F.when(references > 0, F.lit("ocr")),
        )
    )


def bound_scope(outer: Column, nested: Column) -> tuple[Column, Column]:
    """The nested value with gaps filled from the outer one, and whether they contradict."""
    return F.coalesce(nested, outer), F.coalesce(outer != nested, F.lit(False))


def allowed_columns(df: DataFrame, allowed: tuple[str, ...], media: bool = True) -> DataFrame:
    """Only columns that may be shown, and media only on request."""
    return df.select(*[c for c in allowed if c in df.columns and (media or c != "media")])


def reader_items(rows: DataFrame) -> DataFrame:
    """What a reader shows of rows (record_id, kind, text, transcript, image_texts, images, videos,
    stickers, available): category, displayed text, text found in images, and whether any file is
    there."""
    from talkloom.functions.media import category

    kind = category(F.col("kind"), F.col("images"), F.col("videos"), F.col("stickers"))
    found = F.array_join(F.filter("image_texts", lambda t: F.trim(t) != ""), "\n")
    shown = F.when(kind == "voice", texts.first_filled(F.col("transcript"), F.col("text"))).otherwise(texts.first_filled(F.col("text"), F.col("transcript")))
    return rows.select(
        "record_id", kind.alias("category"), F.coalesce(shown, F.concat(F.lit("["), "kind", F.lit("]"))).alias("shown"), found.alias("image_text"),
        F.coalesce("available", F.lit(False)).alias("available"),
    )


def reader_totals(items: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("records"), F.count_if(F.col("category") != "text").alias("media_records"), F.count_if("available").alias("with_files"))


def recall_info(fields: Column, values: Column) -> Column:
    """What a withdrawal notice says, of decoded payload fields and their texts: the prompt, who
    withdrew what of whom, and everybody's names, each once."""
    pick = lambda number: F.try_element_at(F.map_from_entries(F.arrays_zip(F.array_distinct(fields), F.transform(F.array_distinct(fields), lambda f: F.get(values, F.array_position(fields, f).cast("int") - 1)))), F.lit(number))
    names = [pick(n) for n in (47706, 47705, 47715, 47714)]
    return F.struct(
        pick(47713).alias("prompt"), pick(47703).alias("actor_uid"), pick(47704).alias("target_uid"),
        F.array_distinct(F.array_compact(F.array(*[texts.filled(n) for n in names]))).alias("participants"),
    )


def ordered_distinct(*lists: Column) -> Column:
    """All values in order of first appearance, across lists that may be null."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(x, empty) for x in lists]))
