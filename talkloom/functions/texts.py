"""Column expressions on texts, codes, names and record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted words for a chat type.
CHAT_TYPES = {
    "private": "private", "friend": "private", "c2c": "private", "person": "private", "私聊": "private",
    "group": "group", "groups": "group", "群": "group", "群聊": "group",
    "discuss": "discuss", "discussion": "discuss", "讨论组": "discuss",
}
#: Fixed value: the word of a withdrawal notice.
RECALL_WORD = "撤回"
#: Endings of images and of files, starts of addresses, punctuation inside a chunk.
IMAGE_ENDINGS = ("jpg", "jpeg", "png", "gif", "webp")
FILE_ENDINGS = ("doc", "docx", "ppt", "pptx", "xls", "xlsx", "pdf", "zip", "rar", "7z", "txt", "mp4", "mp3")
URL_STARTS = ("http://", "https://", "/download?")
HAN_PUNCTUATION = "，。！？、；：,.!?()（）/-"
HASH = "[a-f0-9]{64}"


def compact_text(column: Column) -> Column:
    """Without NUL; control characters are blanks; runs of white space are one blank; trimmed."""
    bare = F.translate(column, "\x00", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "[\x01-\x08\x0b\x0c\x0e-\x1f]+", " "), r"\s+", " "))


def filled(column: Column) -> Column:
    """Null if blank."""
    text = F.trim(column.cast("string"))
    return F.when(text != "", text)


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*map(filled, columns))


def chat_type(column: Column) -> Column:
    """Canonical chat type; null and blank are private, unknown words null."""
    word = F.lower(F.coalesce(filled(column), F.lit("private")))
    table = F.create_map(*[F.lit(x) for pair in CHAT_TYPES.items() for x in pair])
    return F.try_element_at(table, word)


def message_kind(kind: Column, sub: Column) -> Column:
    """Kind from two numeric codes."""
    t = F.coalesce(kind.cast("string").try_cast("int"), F.lit(-1))
    s = F.coalesce(sub.cast("string").try_cast("int"), F.lit(-1))
    return (
        F.when(t == 1, "text").when(t == 2, "image").when(t == 3, "mixed/text-image")
        .when((t == 4) & (s == 5), "recall/system").when(t == 17, "reply/quote")
        .when((t == 33) | (s == 33), "forward/structured").otherwise(F.concat(F.lit("type_"), t))
    )


def refined_kind(kind: Column, text: Column, images: Column) -> Column:
    """With image names: text turns mixed, anything else an image, or mixed if it has text."""
    return F.when(F.coalesce(F.size(images), F.lit(0)) < 1, kind).when((kind != "text") & filled(text).isNull(), "image").otherwise("mixed/text-image")


def canonical_json(*columns: Column | str) -> Column:
    """Object text with sorted keys, also in nested objects, and nulls kept."""
    return F.to_json(F.parse_json(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))


def fingerprint(*columns: Column | str) -> Column:
    return F.sha2(canonical_json(*columns), 256)


def extended_id(base: Column, digest: Column) -> Column:
    return F.concat_ws(":sha256:", base, digest)


def split_id(record: Column, chat: Column, native_parts: Column | int) -> Column:
    """``struct(base, digest)``; null for a foreign chat or a malformed id.

    The digest follows ``:sha256:``; older ids have it as one part more than the native ones.
    """
    parts = F.lit(native_parts) if isinstance(native_parts, int) else native_parts
    rest = F.substring(record, F.length(chat) + 2, F.length(record))
    marked = F.regexp_extract(record, f"^(.*):sha256:({HASH})$", 2)
    old = F.when(F.size(F.split(rest, ":")) == parts + 1, F.regexp_extract(rest, f":({HASH})$", 1))
    base = (
        F.when(marked != "", F.regexp_extract(record, f"^(.*):sha256:({HASH})$", 1))
        .when(F.coalesce(old, F.lit("")) != "", F.regexp_replace(record, f":{HASH}$", ""))
        .otherwise(record)
    )
    native = F.substring(base, F.length(chat) + 2, F.length(base))
    good = record.startswith(F.concat(chat, F.lit(":"))) & (F.size(F.split(native, ":")) == parts)
    digest = F.coalesce(F.when(marked != "", marked), F.when(old != "", old))
    return F.when(good, F.struct(base.alias("base"), digest.alias("digest")))


def in_order(found: Column) -> Column:
    """Each once, in order of its characters; nulls are left out."""
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def image_names(column: Column, endings: tuple[str, ...] = IMAGE_ENDINGS) -> Column:
    """File names of 16 to 64 hexadecimal digits with an image ending.

    The text is cut at its dots: a name is the digits that end one part (the last 64 of a longer
    run) with the ending that the next part begins with.
    """
    parts = F.split(column, "[.]")

    def ending(part: Column) -> Column:
        return F.coalesce(*[F.when(part.startswith(e), e) for e in endings])

    def digits(part: Column) -> Column:
        run = F.substring(part, F.length(F.regexp_replace(part, r"\p{XDigit}+$", "")) + 1, F.length(part))
        return F.when(F.length(run) >= 16, F.right(run, F.lit(64)))

    def name(part: Column, i: Column) -> Column:
        # an ending that completes the name before is no part of this one
        taken = F.when((i > 0) & digits(F.get(parts, i - 1)).isNotNull(), F.length(ending(part)))
        own = F.substring(part, F.coalesce(taken, F.lit(0)) + 1, F.length(part))
        return F.concat_ws(".", digits(own), ending(F.get(parts, i + 1)))

    return in_order(F.filter(F.transform(parts, name), lambda x: x.contains(".")))


def file_names(column: Column, endings: tuple[str, ...] = FILE_ENDINGS) -> Column:
    """Names of up to 120 letters and digits of any script, blanks, and the signs ``_ ( ) . -``."""
    listed = "|".join(sorted(endings, key=lambda e: (-len(e), e)))  # longer ones first
    return in_order(F.regexp_extract_all(column, F.lit(rf"(?i)([\p{{L}}\p{{N}}_(). -]{{1,120}}[.](?:{listed}))"), 1))


def urls(column: Column, most: int = 6, starts: tuple[str, ...] = URL_STARTS) -> Column:
    """Web addresses and download paths: the text is cut at blanks, quotes and angle brackets, and
    of each piece what follows the first start in it, with that start, is one."""
    pieces = F.split(column, r"[\s\"'<>]+")

    def address(piece: Column) -> Column:
        places = [F.struct(F.nullif(F.locate(s, piece), F.lit(0)).alias("at"), F.lit(len(s)).alias("size")) for s in starts]
        first = F.array_min(F.filter(F.array(*places), lambda x: x["at"].isNotNull()))
        found = F.substring(piece, first["at"], F.length(piece))
        return F.when(F.length(found) > first["size"], found)

    return F.slice(in_order(F.transform(pieces, address)), 1, most)


def cjk_chunks(column: Column, most: int = 5) -> Column:
    """Runs of up to 121 characters that begin with a Han character: Han, ASCII letters and
    digits, blanks and common punctuation; in order, without repeats."""
    run = rf"(\p{{IsHan}}[\p{{IsHan}}\p{{Alnum}} {HAN_PUNCTUATION}]{{1,120}})"
    chunks = F.transform(F.regexp_extract_all(column, F.lit(run), 1), compact_text)
    return F.slice(F.array_distinct(F.filter(chunks, lambda x: F.length(x) >= 2)), 1, most)


def safe_name(column: Column) -> Column:
    """Usable as a file or partition name."""
    cleaned = F.regexp_replace(F.coalesce(filled(column), F.lit("unknown")), "[^A-Za-z0-9_.-]+", "_")
    bare = F.substring(F.btrim(cleaned, F.lit("._")), 1, 96)
    return F.when(bare != "", bare).otherwise("unknown")


def partition_key(kind: Column, identity: Column) -> Column:
    return F.concat_ws("_", chat_type(kind), safe_name(identity))


def path_kind(column: Column) -> Column:
    """``remote`` (a scheme or a network share), ``local`` or null for nothing."""
    text = filled(column)
    far = text.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]+://|//|\\\\)") & ~F.lower(text).startswith("file:///")
    return F.when(text.isNotNull(), F.when(far, "remote").otherwise("local"))


def without_cjk_gaps(column: Column) -> Column:
    """Blanks between CJK characters, as recognised text has them, go."""
    return F.regexp_replace(column, r"(?<=[㐀-鿿])[ \t]+(?=[㐀-鿿])", "")


def revision_key(*columns: Column | str) -> Column:
    """Key of a cached result: everything that it depends on."""
    return F.sha2(F.concat_ws("|", *columns), 256)


def node_attributes(column: Column, node: str, names: list[str]) -> Column:
    """Attributes of a markup element; null for document types, entities and oversized text."""
    safe = (F.length(column) <= 2_000_000) & ~F.upper(column).rlike("<!(DOCTYPE|ENTITY)") & column.rlike(rf"<{node}\b")
    found = [F.nullif(F.regexp_extract(column, rf"<{node}\b[^>]*?\s{name}\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit("")).alias(name) for name in names]
    return F.when(safe, F.struct(*found))
