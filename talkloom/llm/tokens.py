"""Tokenizing whole texts inside tasks, and binary records of token ids.

Records: ``length:u64  crc(length):u32  payload  crc(payload):u32``, little-endian, with masked
CRCs; the payload is the document's ids as little-endian u16 (u32 for vocabularies over 65,536).
One file holds one range of ids in ascending order.  Beside the files lies an index (Parquet):
file, byte offset, id, token count and the position of its first id among all ids, by which a
reader can seek to any record in any order.
"""

from __future__ import annotations

import array
import functools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom.llm.common import new_path, open_store, written

#: White space other than blank and line feed, and the two marks used below.
_OTHER_SPACE = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\x00\\x01]")
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_CACHE = 650_000
#: The letter that stands for each byte in vocabularies of bytes: printable Latin-1 for itself,
#: every other byte, in order, for the letters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class TextEncoder:
    """Encodes whole texts exactly as the tokenizer file does, one distinct word only once.

    Both kinds of tokenizer end a piece before white space that follows other text, so a text
    is cut there, each distinct word is encoded with its leading blank, and the ids are joined.
    Texts in which white space itself could be merged or is unusual, or in which a token that the
    file adds to its vocabulary could occur, are encoded whole.
    """

    def __init__(self, path: str, code: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = code
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if t.content]
        self.folded = [t.content.lower() for t in added if t.content and t.normalized]
        self.prefix = os.path.commonprefix(self.added)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.lower = any(t.endswith("</w>") for t in vocabulary)  # such files fold case and drop white space
        self.tokenize = self.tokenizer.model.tokenize
        self.marks = {m: self._whole(m) for m in ("", ",", ".", "\n")}

    def _ids(self, ids: list[int]) -> bytes:
        return array.array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else b""

    def _word(self, word: str) -> bytes:
        """A word of Latin letters is one piece, so the merges alone give its ids."""
        lead = "" if self.lower else _LETTERS[ord(" ")]
        if word[0] == "\x01":
            lead, word = "" if self.lower else _LETTERS[ord("\n")], word[1:]
            if lead:  # a line feed before a word is a piece of its own
                return self.marks["\n"] + self._ids([t.id for t in self.tokenize(self._letters(word))])
        if self.lower:
            word = word.lower()
        return self._ids([t.id for t in self.tokenize(lead + self._letters(word))])

    def _letters(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)

    def _learn(self, new: list[str]) -> None:
        """Encode unseen words: those of Latin letters one by one, others many in one text, told
        apart by where their ids start in it."""
        words, rest = self.words, []
        for w in new:
            if (known := self.older.get(w)) is not None:
                words[w] = known
                continue
            last = w[-1:]
            mark = last if last == "," or last == "." else ""
            body = w[:-1] if mark else w
            bare = body[1:] if body[:1] == "\x01" else body
            if not (bare.isalpha() if bare.isascii() else _LATIN.fullmatch(bare)):
                rest.append(w)
                continue
            if (ids := words.get(body)) is None:
                ids = words[body] = self._word(body)
            if mark:
                words[w] = ids + self.marks[mark]
        for i in range(0, len(rest), 1000):
            part = ["\n" + w[1:] if w[:1] == "\x01" else " " + w for w in rest[i : i + 1000]]
            done = self.tokenizer.encode("".join(part), add_special_tokens=False)
            data, starts = self._ids(done.ids), [a for a, _ in done.offsets]
            bounds = np.searchsorted(starts, np.cumsum([0, *map(len, part)])) * (len(data) // max(1, len(starts)))
            words.update(zip(rest[i : i + 1000], (data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)), strict=True))

    def __call__(self, text: str | None) -> bytes:
        """The ids as little-endian bytes."""
        if not text:
            return b""
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1] in " \n" or _OTHER_SPACE.search(text) or self._may_hold_added(text):
            return self._whole(text)
        first, *rest = text.replace("\n", " \x01").split(" ")
        if (head := self.firsts.get(first)) is None:
            if len(self.firsts) > _CACHE // 8:
                self.firsts.clear()
            head = self.firsts[first] = self._whole(first)
        parts = list(map(self.words.get, rest))
        if None in parts:
            if len(self.words) > _CACHE:  # what is still in use moves over from the older half
                self.older, self.words = self.words, {}
            words = self.words
            self._learn([w for w in dict.fromkeys(w for w, p in zip(rest, parts, strict=True) if p is None) if w not in words])
            parts = [words[w] if p is None else p for w, p in zip(rest, parts, strict=True)]
        return head + b"".join(parts)

    def _may_hold_added(self, text: str) -> bool:
        if self.prefix in text and any(t in text for t in self.added):
            return True
        return bool(self.folded) and any(t in text.lower() for t in self.folded)


@functools.lru_cache(maxsize=2)
def encoder(path: str, code: str) -> TextEncoder:
    """The worker's encoder: tasks that follow each other in a worker share the words it knows."""
    return TextEncoder(path, code)


# CRC-32C would need a library or slow Python; zlib's CRC-32 is masked in the same way.
def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(data: bytes, at: int = 0) -> bytes:
    """The payload of the record at byte ``at``; ValueError if its frame or content is broken."""
    head = data[at : at + 8]
    if len(data) < at + 12 or struct.unpack_from("<I", data, at + 8)[0] != masked_crc(head):
        raise ValueError(f"broken record length at byte {at}")
    size = struct.unpack("<Q", head)[0]
    payload = data[at + 12 : at + 12 + size]
    if len(data) < at + 16 + size or struct.unpack_from("<I", data, at + 12 + size)[0] != masked_crc(payload):
        raise ValueError(f"broken record content at byte {at}")
    return payload


def write_records(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    path: str | None = None,
    file_bytes: int = 32 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text, append ``end_id`` and write records in ascending id order.

    Returns the offset index: ``(part, file, byte, <id>, n_tokens, start)``.  Null and empty
    texts give a record of the end id alone; rows that share an id follow each other ordered by
    text, null ids come first; an empty table gives an empty index.  Texts are dealt by id range
    into files of about ``file_bytes`` of text; a longer text is one record in a file of its own
    size, encoded whole; further columns, whatever their names, are not read.  A task writes under a name of its own and only
    the index of tasks that ended well is kept, so lost or repeated tasks leave no trace in it.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = path or new_path(spark, "records")
    code = "H" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "I"
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("__text"))
    dealt = rows.repartitionByRange(max(1, -(-total // file_bytes)), id_col).sortWithinPartitions(id_col, "__text")
    names = ["part", "file", "byte", id_col, "n_tokens", "first"]
    end = array.array(code, [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, at, first = encoder(tokenizer_path, code), None, 0, 0
        part = TaskContext.get().partitionId()
        name = f"{part:08d}-{uuid.uuid4().hex}.rec"
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    store, where = open_store(folder)
                    store.create_dir(where)
                    out = store.open_output_stream(f"{where}/{name}")
                places, counts, firsts = [], [], []
                for text in batch.column(1).to_pylist():
                    payload = encode(text) + end
                    record = frame(payload)
                    places.append(at)
                    counts.append(len(payload) // len(end))
                    firsts.append(first)
                    at += len(record)
                    first += counts[-1]
                    out.write(record)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array([f"{folder}/{name}"] * n), pa.array(places, pa.int64()), batch.column(0), pa.array(counts, pa.int64()), pa.array(firsts, pa.int64())], names
                )
        finally:
            if out is not None:
                out.close()

    kind = docs.schema[id_col].dataType.simpleString()
    index = written(dealt.mapInArrow(run, f"part int, file string, byte bigint, `{id_col}` {kind}, n_tokens bigint, first bigint"), "index")
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select("part", before.alias("before"))  # one row a file
    return index.join(starts, "part").select("part", "file", "byte", id_col, "n_tokens", (F.col("before") + F.col("first")).alias("start"))


def read_records(index: DataFrame, code: str = "H", id_col: str = "doc_id") -> DataFrame:
    """The records that ``index`` points to, in any order: the index columns and ``ids``.

    Every record's frame and content are verified; a broken one raises ValueError.
    """
    names = [id_col, "start", "ids"]
    kind = index.schema[id_col].dataType.simpleString()
    dtype = {"H": "<u2", "I": "<u4"}[code]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = data = None
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some, ids = batch.slice(i, 500), []
                for file, byte in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    if file != name:
                        store, where = open_store(file)
                        name, data = file, store.open_input_file(where)
                    data.seek(byte)
                    head = data.read(12)
                    size = struct.unpack_from("<Q", head)[0] if len(head) == 12 and struct.unpack_from("<I", head, 8)[0] == masked_crc(head[:8]) else -1
                    payload = unframe(head + data.read(size + 4)) if size >= 0 else unframe(head)
                    ids.append(np.frombuffer(payload, dtype).astype("<u4"))
                yield pa.RecordBatch.from_arrays([some.column(2), some.column(3), pa.array([x.tobytes() for x in ids], pa.binary())], names)

    files = max(1, index.select("file").distinct().count())
    dealt = index.repartition(files, "file").sortWithinPartitions("file", "byte").select("file", "byte", id_col, "start")
    return dealt.mapInArrow(run, f"`{id_col}` {kind}, start bigint, ids binary")
