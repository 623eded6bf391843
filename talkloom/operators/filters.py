"""Scopes and predicates."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions import texts
from talkloom.functions.times import TimeRange

_SENDER = {"uid": "sender_uid", "uin": "sender_uin", "name": "sender_name", "direction": "direction"}
#: A selector says its namespace by a prefix, or else by its shape, the first that fits.
_SELECTOR = re.compile(
    r"(?P<prefix>uid|uin|name|direction):(?P<value>.*)"
    r"|(?P<uin>\d+)|(?P<uid>u_.*)|(?P<direction>from_me|from_contact|from_member|unknown)|(?P<name>.+)",
    re.DOTALL,
)


def sender_selector(selector: str = "", **named: str) -> tuple[str, str] | None:
    """(column, value) of a selector, or None for none; only one namespace at a time.

    ``uid: uin: name: direction:`` prefixes say which, and so do arguments of these names; else
    digits are a uin, ``u_`` begins a uid, a direction word is one, and anything else is an exact
    name.
    """
    unknown = set(named) - set(_SENDER)
    asked = [(selector or "").strip(), *(f"{k}:{v}" for k, v in named.items() if v not in (None, "") and k in _SENDER)]
    asked = [x for x in asked if x]
    if unknown or len(asked) > 1:
        raise ValueError("one sender namespace at a time, of uid, uin, name and direction")
    if not asked:
        return None
    found = _SELECTOR.fullmatch(asked[0])
    namespace, value = (found["prefix"], found["value"]) if found["prefix"] else (found.lastgroup, asked[0])
    if not value.strip():
        raise ValueError("an empty sender selector")
    return _SENDER[namespace], value.strip()


def select_senders(messages: DataFrame, selectors: DataFrame) -> DataFrame:
    """Many selectors at once: ``selectors`` (selector_id, namespace, value) -> rows of each."""
    out = None
    for namespace, column in _SENDER.items():
        if column not in messages.columns:
            continue
        own = selectors.filter(F.col("namespace") == namespace).select("selector_id", F.col("value").alias(column))
        part = messages.join(own, column).select("selector_id", *messages.columns)
        out = part if out is None else out.unionByName(part)
    return out


def keyword_haystack(*columns: Column | str) -> Column:
    return F.lower(F.concat_ws("\n", *columns))


def has_keyword(keyword: str, *columns: Column | str, json_haystack: bool = False) -> Column:
    """Case-insensitive containment in the values; with ``json_haystack`` in their JSON form,
    where the names of the fields count too.  A keyword must not be blank."""
    if not (keyword or "").strip():
        raise ValueError("a search needs a keyword")
    hay = F.lower(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})) if json_haystack else keyword_haystack(*columns)
    return hay.contains(keyword.strip().lower())


def is_recall(kind: Column, type_code: Column, msg_code: Column, text: Column) -> Column:
    return F.coalesce(
        (kind == "recall/system") | ((type_code == 4) & (msg_code == 5)) | ((type_code == 4) & text.contains(texts.RECALL_WORD)), F.lit(False)
    )


def is_recoverable(recall: Column, text: Column, *media: Column) -> Column:
    """Not a withdrawal, and with text or media to recover."""
    found = texts.filled(text).isNotNull()
    for column in media:
        found = found | (F.coalesce(F.size(column), F.lit(0)) > 0)
    return ~recall & found


def private_chat_of(peer: Column, sender: Column, me: str | None) -> Column:
    """The private chat a row belongs to, for all chats in one pass: its peer, or its sender
    where the row is addressed to me or to nobody.  Without knowing me only the peer counts."""
    own = texts.filled(peer)
    if not me:
        return own
    return F.when(own.isNull() | (own == me), F.when(sender == me, own).otherwise(texts.filled(sender))).otherwise(own)


def group_chat_of(number: Column, uid: Column) -> Column:
    return F.coalesce(F.nullif(number.cast("string"), F.lit("0")), texts.filled(uid))


@dataclass(frozen=True)
class MessageScope:
    """What to read of many chats at once."""

    chats: tuple[str, ...] = ()
    time: TimeRange = TimeRange()
    sender: tuple[str, str] | None = None
    kind: str | None = None
    keyword: str | None = None

    def apply(self, messages: DataFrame) -> DataFrame:
        """Chat, time, sender and kind are plain comparisons that reach the scan."""
        out = messages.filter(self.time.holds(F.col("timestamp")))
        if self.chats:
            out = out.filter(F.col("chat_id").isin(*self.chats))
        if self.sender:
            out = out.filter(F.col(self.sender[0]) == self.sender[1])
        if self.kind:
            out = out.filter(F.col("kind") == self.kind)
        return out.filter(has_keyword(self.keyword, "text", "kind")) if self.keyword is not None else out
