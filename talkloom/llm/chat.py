"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events: messages are opened, streamed in deltas, edited, and generated
again.  Logs are partitioned by conversation (a long one by stretches of its turns), sorted by
sequence and folded into final messages, which are rendered through a template with a loss mask
over what the assistant says.  The rendered table can be read back exactly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import pieces, written

#: Kinds of events, in the order in which events of one sequence number count.
KINDS = ("open", "delta", "edit", "regenerate")
EVENTS = "turn bigint, copy int, seq bigint, kind string, role string, text string, first int, last int"
#: Turns of a conversation that go to a task together.
STRETCH = 1024
#: Characters of a rendered row, beyond which the next message begins another.
ROW_CHARS = 1 << 20
#: Characters of a delta when a finished message is written as a log.
DELTA = 400


# -- the template ----------------------------------------------------------------------------------

#: Control strings of the template and what stands for them in texts and roles.
CONTROL = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e", ":": "\\c"}
_IN_TEXT, _IN_ROLE = (re.compile("|".join(map(re.escape, keys))) for keys in (list(CONTROL)[:3], CONTROL))
_PLAIN = {v: k for k, v in CONTROL.items()}
_ESCAPED = re.compile(r"\\[\\hec]")
START, MIDDLE, END = "### ", ": ", "</turn>\n"


def escape(text: str, role: bool = False) -> str:
    """``text`` without any control string of the template (a role has no colon either);
    :func:`unescape` gives it back."""
    return (_IN_ROLE if role else _IN_TEXT).sub(lambda m: CONTROL[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[0]], text) if "\\" in text else text


def render_message(role: str, text: str) -> tuple[str, int, int]:
    """(rendered message, first and last offset of its text)."""
    head, body = f"{START}{escape(role, role=True)}{MIDDLE}", escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def parse(rendered: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each message; ValueError if anything else is there."""
    at = 0
    while at < len(rendered):
        middle, end = rendered.find(MIDDLE, at), rendered.find(END, at)
        if not rendered.startswith(START, at) or not 0 <= middle < end:
            raise ValueError(f"no message at character {at}")
        yield unescape(rendered[at + len(START) : middle]), unescape(rendered[middle + len(MIDDLE) : end])
        at = end + len(END)


# -- logs ------------------------------------------------------------------------------------------


def log_of_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Finished turns as the log that a chat service would have kept of them: each message opened and
    streamed in deltas; some with a slip that an edit mends, some answers broken off and generated
    again, as the checksum of conversation and turn says.  Folding gives the turns back.

    Rows of one turn are messages of their own, in the order of role and text; a null text is empty, a
    null role empty too; rows without a conversation or a turn are kept as such.
    """
    order = Window.partitionBy("conv", "turn").orderBy("role", "text")
    chosen = turns.select(
        turns[conversation].alias("conv"), turns[turn].cast("bigint").alias("turn"), F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"),
    ).withColumn("copy", F.row_number().over(order))

    def events(role: str, text: str, choice: int) -> Iterator[tuple]:
        """(kind, role, text, first, last)"""
        stream = lambda t: (("delta", None, t[i : i + DELTA], None, None) for i in range(0, len(t), DELTA))
        yield "open", role, None, None, None
        if choice == 0 and role == "assistant":
            yield from stream(text[: len(text) // 4])
            yield "regenerate", None, None, None, None
        if choice == 1 and text:
            at = choice + len(text) // 3
            yield from stream(text[:at] + "?" + text[at + 2 :])
            yield "edit", None, text[at : at + 2], at, at + 1
        else:
            yield from stream(text)

    def run(batches):
        names = ["conv", *(c.split()[0] for c in EVENTS.split(", "))]
        for batch in pieces(batches):
            rows, source = [], []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for i, (conv, at, own, body, copy) in enumerate(zip(*columns, strict=True)):
                choice = zlib.crc32(f"{conv}:{at}".encode()) % 4
                for seq, (kind, role, text, first, last) in enumerate(events(own, body, choice)):
                    rows.append((at, copy, seq, kind, role, text, first, last))
                    source.append(i)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int64())), *made], names)

    return chosen.mapInArrow(run, f"conv {chosen.schema['conv'].dataType.simpleString()}, {EVENTS}")


@dataclass
class Message:
    """The state that the events of one message fold into."""

    role: str = ""
    parts: list[str] = field(default_factory=list)

    def text(self) -> str:
        return "".join(self.parts)

    def apply(self, kind: str, role: str | None, text: str | None, first: int | None, last: int | None) -> None:
        """``open`` names the role, ``delta`` appends, ``edit`` puts its text in the place of the
        characters from ``first`` to before ``last`` (null: from the start, to the end),
        ``regenerate`` drops what has been said; other kinds change nothing."""
        if kind == "open":
            self.role = role or ""
        elif kind == "delta":
            self.parts.append(text or "")
        elif kind == "edit":
            said = self.text()
            self.parts = [said[: first or 0], text or "", said[len(said) if last is None else last :]]
        elif kind == "regenerate":
            self.parts = []


def folded(rows: Iterator[tuple]) -> Iterator[tuple[tuple, str, str]]:
    """Events (conversation, stretch, turn, copy, kind, role, text, first, last) in order -> (place,
    role, text) of each message; one message is held at a time."""
    place, message = None, None
    for *own, kind, role, text, first, last in rows:
        if own != place:
            if message is not None:
                yield tuple(place), message.role, message.text()
            place, message = own, Message()
        message.apply(kind, role, text, first, last)
    if message is not None:
        yield tuple(place), message.role, message.text()


def format_chats(events: DataFrame, assistant: str = "assistant") -> DataFrame:
    """A log ``(conv, turn, copy, seq, kind, role, text, first, last)`` -> rendered rows ``(conv,
    stretch, part, text, n_turns, mask_first, mask_last)``.

    Rows of a conversation in the order of stretch and part, put together, are its formatted text; a
    row holds whole messages, at most ``STRETCH`` turns of them, and no further message once it has
    ``ROW_CHARS`` characters.  The mask gives the offsets in a row of every text of the assistant.
    Events are sorted by ``seq`` within a message (ties by kind, then text) and messages by turn and
    copy, nulls first.

    A conversation, however long, is never held: stretches of it go to different tasks, which hold
    one rendered row.  A message is one text in memory, as it is in a row.  Repeated events count
    again; null texts are empty; a message that was never opened has the empty role; further columns
    are not read; an empty log gives no rows.
    """
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    stretch = F.floor(F.col("turn") / STRETCH).alias("stretch")
    chosen = events.select("conv", stretch, "turn", "copy", "seq", kind.alias("step"), "kind", "role", "text", "first", "last")
    placed = chosen.repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", "turn", "copy", "seq", "step", "text")
    names, row_chars = ["conv", "stretch", "part", "text", "n_turns", "mask_first", "mask_last"], ROW_CHARS

    def run(batches):
        key_type = None

        def rows():
            nonlocal key_type
            for batch in pieces(batches):
                key_type = batch.column(0).type
                columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 6, 7, 8, 9, 10)]
                yield from zip(*columns, strict=True)

        def row(place, part, texts, mask):
            return (*place, part, "".join(texts), len(texts), [m[0] for m in mask], [m[1] for m in mask])

        def batch_of(made):
            kinds = [key_type, pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

        place, part, texts, mask, size, made, total = None, 0, [], [], 0, [], 0
        for (conv, at, _, _), role, text in folded(rows()):
            if texts and ((conv, at) != place or size >= row_chars):
                made.append(row(place, part, texts, mask))
                part, texts, mask, total, size = part + 1 if (conv, at) == place else 0, [], [], total + size, 0
                if total >= row_chars:
                    yield batch_of(made)
                    made, total = [], 0
            place = (conv, at)
            rendered, first, last = render_message(role, text)
            if role == assistant:
                mask.append((size + first, size + last))
            texts.append(rendered)
            size += len(rendered)
        if texts:
            yield batch_of([*made, row(place, part, texts, mask)])

    return placed.mapInArrow(run, f"conv {events.schema['conv'].dataType.simpleString()}, stretch bigint, part int, text string, n_turns int, mask_first array<int>, mask_last array<int>")


def read_chats(rendered: DataFrame) -> DataFrame:
    """Rendered rows read back: ``(conv, stretch, part, chars, roles, texts, loss)``, the length of each
    row, its messages, and the texts under its mask, unescaped."""
    names = ["conv", "stretch", "part", "chars", "roles", "texts", "loss"]

    def run(batches):
        for batch in pieces(batches):
            roles, texts, loss = [], [], []
            for body, first, last in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)), strict=True):
                messages = list(parse(body))
                roles.append([r for r, _ in messages])
                texts.append([t for _, t in messages])
                loss.append([unescape(body[a:b]) for a, b in zip(first, last, strict=True)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(x, pa.list_(pa.string())) for x in (roles, texts, loss))], names)

    chosen = rendered.select("conv", "stretch", "part", F.length("text").cast("bigint").alias("chars"), "text", "mask_first", "mask_last")
    return chosen.mapInArrow(run, f"conv {rendered.schema['conv'].dataType.simpleString()}, stretch bigint, part int, chars bigint, roles array<string>, texts array<string>, loss array<string>")


def digest_chats(rendered: DataFrame) -> DataFrame:
    """One row for each conversation of rendered rows, from what is read back of them: ``(conv, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars)``.

    A digest runs along a conversation, so its rows pass through one task in order, each let go
    before the next; only the state of the digests stays.
    """
    from hashlib import sha256

    placed = read_chats(rendered).repartition("conv").sortWithinPartitions("conv", "stretch", "part")
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        def row(conv, state):
            return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def batch_of(key_type, made):
            kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

        now, state, key_type, made = None, None, None, []
        for batch in pieces(batches):
            key_type = batch.column(0).type
            for i, (conv, chars) in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if state is None or conv != now:
                    if state is not None:
                        made.append(row(now, state))
                    now, state = conv, [0, sha256(), 0, sha256(), 0]
                roles, texts, loss = (batch.column(k)[i].as_py() for k in (4, 5, 6))
                for role, text in zip(roles, texts, strict=True):
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for text in loss:
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[0] += len(roles)
                state[4] += chars
            if made:
                yield batch_of(key_type, made)
                made = []
        if state is not None:
            yield batch_of(key_type, [row(now, state)])

    return placed.mapInArrow(run, f"conv {rendered.schema['conv'].dataType.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def write_chats(events: DataFrame, assistant: str = "assistant") -> DataFrame:
    """:func:`format_chats` written in the shared folder and read back from there."""
    return written(format_chats(events, assistant), "chats")
