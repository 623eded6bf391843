"""Binary payloads: a walk over length-delimited fields, a level of a whole batch at a time."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.functions.texts import IMAGE_ENDINGS

#: The field that holds text; bytes of values that have a fixed size, by wire type.
TEXT_FIELD = 45101
FIXED_SIZE = {1: 8, 5: 4}
_IMAGE = re.compile(rf"[0-9a-f]{{16,64}}[.](?:{'|'.join(IMAGE_ENDINGS)})", re.IGNORECASE)
_NUMBER = re.compile(rb"[\x80-\xff]{0,9}[\x00-\x7f]")


def fields_of(data: bytes, most: int) -> tuple[list[tuple[int, bytes | None]], bool]:
    """The fields of one message, at most ``most`` and one more: (field, bytes), None for values
    that are not length-delimited; and whether the message is sound as far as it was read."""
    found, at, end = [], 0, len(data)

    def number() -> int:
        nonlocal at
        token = _NUMBER.match(data, at)
        if token is None:
            raise ValueError("no whole number")
        at = token.end()
        return sum((byte & 0x7F) << 7 * i for i, byte in enumerate(token[0]))

    try:
        while at < end and len(found) <= most:
            field, wire = divmod(number(), 8)
            if not field or wire not in (0, 1, 2, 5):
                raise ValueError("no such field or type")
            size = number() if wire in (0, 2) else FIXED_SIZE[wire]
            start, at = at, at + (size if wire else 0)
            if at > end:
                raise ValueError("the value is cut short")
            found.append((field, data[start:at] if wire == 2 else None))
    except ValueError:
        return found, False
    return found, True


def shown(value: bytes | None) -> str | None:
    """The value as text, if it is one: not empty, UTF-8, printable but for tabs and line ends."""
    if not value:
        return None
    try:
        text = value.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text.translate({9: " ", 10: " ", 13: " "}).isprintable() else None


def read_payloads(payloads: list[bytes | None], wanted: frozenset[int] = frozenset({TEXT_FIELD}), most_fields: int = 2048, most_depth: int = 8) -> list[dict]:
    """For each payload the texts of the wanted fields with their fields, image names, fields of
    no use, and whether it is malformed or was cut at ``most_fields`` or ``most_depth``.

    All payloads are read level by level.  A field's place is the path of positions down to it,
    so sorting by place restores the order in which fields stand in the payload.
    """
    read = [fields_of(p, most_fields) if p else ([], True) for p in payloads]
    seen: list[list[tuple]] = [[] for _ in payloads]
    level = [(row, (), fields) for row, (fields, _) in enumerate(read)]
    for depth in range(most_depth + 1):
        below = []
        for row, path, fields in level:
            for i, (field, value) in enumerate(fields):
                place, text = (*path, i), shown(value)
                if text is not None:
                    kind = "text" if field in wanted else "image" if _IMAGE.fullmatch(text) else "other"
                elif not value:
                    kind = "other"
                elif depth == most_depth:
                    kind = "deep"
                else:
                    inner, sound = fields_of(value, most_fields)
                    kind = "message" if sound else "other"
                    if sound:
                        below.append((row, place, inner))
                seen[row].append((place, kind, field, text))
        level = below
    out = []
    for own, (_, sound) in zip(seen, read, strict=True):
        own.sort(key=lambda x: x[0])
        cut, own = len(own) > most_fields, own[:most_fields]
        kinds = [kind for _, kind, _, _ in own]
        texts = [(text, field) for _, kind, field, text in own if kind == "text"]
        out.append({
            "texts": [t for t, _ in texts], "fields": [f for _, f in texts], "images": [text for _, kind, _, text in own if kind == "image"],
            "unknown": kinds.count("other") + kinds.count("image"), "malformed": not sound and not cut, "truncated": cut or "deep" in kinds,
        })
    return out


def walk(data: bytes | None, **limits) -> dict:
    """The same for one payload."""
    return read_payloads([data], **limits)[0]


def decode_payloads(df: DataFrame, payload: str = "payload", wanted: frozenset[int] = frozenset({TEXT_FIELD})) -> DataFrame:
    """All columns but the payload, and ``texts, fields, images, unknown, malformed, truncated,
    bytes, payload_sha256``.  A null payload has no fields and no digest."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != payload)
    made = "texts array<string>, fields array<int>, images array<string>, unknown int, malformed boolean, truncated boolean, bytes bigint, payload_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = read_payloads([bytes(x) if x is not None else None for x in rows[payload]], wanted)
            out = rows.drop(columns=[payload])
            for name in ("texts", "fields", "images", "unknown", "malformed", "truncated"):
                out[name] = [f[name] for f in found]
            out["bytes"] = [len(x) if x is not None else 0 for x in rows[payload]]
            out["payload_sha256"] = [hashlib.sha256(bytes(x)).hexdigest() if x is not None and len(x) else None for x in rows[payload]]
            yield out

    return df.mapInPandas(run, f"{schema}, {made}")


def decode_missing(df: DataFrame, text: str = "index_text") -> DataFrame:
    """Payloads are only walked where the index has no text."""
    has = F.coalesce(F.trim(F.col(text)), F.lit("")) != ""
    cheap = df.filter(has).select(*[c for c in df.columns if c != "payload"], F.col(text).alias("text"))
    walked = decode_payloads(df.filter(~has)).select(*[c for c in df.columns if c != "payload"], F.array_join("texts", " ").alias("text"))
    return cheap.unionByName(walked)
