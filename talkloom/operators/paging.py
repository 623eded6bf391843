"""Total order, keyset and offset pages, and the merged timeline."""

from __future__ import annotations

import base64
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions.times import TimeRange

ORDER = ("timestamp", "source", "seq", "message_id", "record_id")


def order_columns(keys: tuple[str, ...], descending: bool) -> list[Column]:
    return [F.col(k).desc() if descending else F.col(k).asc() for k in keys]


def after_key(keys: tuple[str, ...], position: list, descending: bool = False, strict: bool = True) -> Column:
    """Rows strictly after a position (or at it, if not ``strict``), in the expanded form that
    reaches the Parquet scan."""
    found = None
    for key, value in reversed(list(zip(keys, position, strict=True))):
        beyond = F.col(key) < value if descending else F.col(key) > value
        if found is None:
            found = beyond if strict else beyond | (F.col(key) == value)
        else:
            found = beyond | ((F.col(key) == value) & found)
    # the leading key alone bounds the scan
    lead = F.col(keys[0]) <= position[0] if descending else F.col(keys[0]) >= position[0]
    return lead & found


def scope_hash(**scope) -> str:
    return hashlib.sha256(json.dumps(scope, sort_keys=True, default=str).encode()).hexdigest()


def encode_cursor(position: list, scope: str) -> str:
    return base64.urlsafe_b64encode(json.dumps({"p": position, "s": scope}).encode()).decode()


def decode_cursor(cursor: str, scope: str) -> list:
    """The position; ValueError if the cursor is malformed or belongs to another query."""
    try:
        found = json.loads(base64.urlsafe_b64decode(cursor.encode()))
        position, own = found["p"], found["s"]
    except Exception as error:
        raise ValueError("malformed cursor") from error
    if own != scope:
        raise ValueError("the cursor belongs to another query")
    return position


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    has_more: bool
    next_cursor: str | None


def keyset_rows(
    messages: DataFrame, limit: int, position: list | None = None, keys: tuple[str, ...] = ORDER, descending: bool = False
) -> DataFrame:
    """The next ``limit`` rows after a position: a top-k, whatever the depth of the page."""
    rows = messages.filter(after_key(keys, position, descending)) if position else messages
    return rows.orderBy(*order_columns(keys, descending)).limit(limit)


def keyset_page(
    messages: DataFrame, limit: int, cursor: str | None = None, offset: int = 0, keys: tuple[str, ...] = ORDER, descending: bool = False,
    display_descending: bool | None = None, **scope,
) -> Page:
    """One page and the cursor of the next.  Looks one row ahead; the rows of the page come to the
    driver, so that they are read once."""
    if not 1 <= limit <= 5000:
        raise ValueError("limit must be between 1 and 5000")
    if cursor and offset:
        raise ValueError("either a cursor or an offset")
    own = scope_hash(keys=keys, descending=descending, **scope)
    position = decode_cursor(cursor, own) if cursor else None
    ahead = keyset_rows(messages, limit + 1 + offset, position, keys, descending).offset(offset)
    found = ahead.collect()
    rows = messages.sparkSession.createDataFrame(found[:limit], messages.schema)
    if display_descending is not None and display_descending != descending:
        rows = rows.orderBy(*order_columns(keys, display_descending))
    more = len(found) > limit
    return Page(rows, more, encode_cursor([found[limit - 1][k] for k in keys], own) if more else None)


def clamped(value: object, default: int, least: int, most: int) -> int:
    """A bound of a native read: within its range, the default where it is no number."""
    try:
        number = int(value)
    except (TypeError, ValueError):
        number = default
    return min(max(number, least), most)


@dataclass(frozen=True)
class OffsetPage:
    rows: DataFrame
    total: int
    next_offset: int | None


def offset_rows(messages: DataFrame, limit: int, offset: int, keys: tuple[str, ...] = ORDER, descending: bool = False) -> DataFrame:
    return messages.orderBy(*order_columns(keys, descending)).offset(offset).limit(limit)


def offset_page(
    messages: DataFrame, limit: object = 50, offset: object = 0, keys: tuple[str, ...] = ORDER, descending: bool = False, display_descending: bool | None = None
) -> OffsetPage:
    """Rows from ``offset`` on, the exact total, and the next page's offset (None after the last).

    Limit and offset are clamped to 1..1,000 and 0..1,000,000,000; rows are shown in the order of
    the query unless another is asked for.
    """
    limit, offset = clamped(limit, 50, 1, 1000), clamped(offset, 0, 0, 1_000_000_000)
    total = messages.count()
    rows = offset_rows(messages, limit, offset, keys, descending)
    if display_descending is not None and display_descending != descending:
        rows = rows.orderBy(*order_columns(keys, display_descending))
    return OffsetPage(rows, total, offset + limit if offset + limit < total else None)


def merge_sources(*sources: DataFrame) -> DataFrame:
    """All sources under one schema; the source column tells them apart, nothing is dropped."""
    out = sources[0]
    for other in sources[1:]:
        out = out.unionByName(other)
    return out


def merged_timeline(
    sources: list[DataFrame], time: TimeRange, limit: int, snapshot: int | None = None, position: list | None = None, descending: bool = True
) -> DataFrame:
    """A page of all sources in one order, as of the snapshot."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    scope = time if snapshot is None else time.clipped(snapshot)
    rows = merge_sources(*sources).filter(scope.holds(F.col("timestamp")))
    return keyset_rows(rows, limit, position, descending=descending)
