"""Folders of exported messages as a Spark data source, in batch and as a stream.

Exports are files of JSON lines.  They are read in pieces of files, bounds on the time skip whole
files by the day or month in their path, and a stream goes on where it has stopped, in the middle of a
file if need be.

Bounds are options of a read, not filters that Spark hands to the source: Spark 4.1 keeps what it has
handed over with the frame, so a second query on it would lose the files that the first has skipped.
"""

from __future__ import annotations

import calendar
import io
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from talkloom.functions.times import TimeRange
from talkloom.sources.readers import NORMALIZED

#: Bytes of a piece of a file.
PIECE = 64 << 20
#: Seconds that local days are ahead of UTC; the days of paths are local.
OFFSET = 8 * 3600
SCHEMA = f"{NORMALIZED}, corrupt string, file string, at bigint"
_FIELDS = [tuple(c.rsplit(" ", 1)) for c in NORMALIZED.split(", ")]
_WHOLE = {name for name, kind in _FIELDS if kind == "bigint"}
_DATE = re.compile(r"(?<!\d)(\d{4})-(\d{2})(?:-(\d{2}))?(?!\d)")
_ROWS = 5000


@dataclass(frozen=True)
class Piece(InputPartition):
    """Lines of a file that begin at ``start`` or later and before ``end``."""

    path: str
    start: int
    end: int


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def files_below(path: str) -> list[tuple[str, int]]:
    """Files and their sizes in the order of their names; hidden ones are no exports."""
    store, place = store_of(path)
    found = store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
    plain = [f for f in found if f.type == fs.FileType.File and not re.search(r"(^|/)[._]", f.path[len(place) :])]
    return sorted((f.path, f.size) for f in plain)


def span_of(path: str) -> tuple[int, int] | None:
    """First and last second of the last day or month named in a path."""
    named = _DATE.findall(path)
    if not named:
        return None
    year, month, day = (int(x or 0) for x in named[-1])
    try:
        first = calendar.timegm((year, month, day or 1, 0, 0, 0)) - OFFSET
        last = first + 86400 * (1 if day else calendar.monthrange(year, month)[1]) - 1
    except (ValueError, calendar.IllegalMonthError):
        return None
    return (first, last) if 1 <= month <= 12 else None


def pieces_of(path: str, start: int, end: int, size: int) -> list[Piece]:
    return [Piece(path, a, min(a + size, end)) for a in range(start, end, size)]


def lines_of(root: str, piece: Piece) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of a piece; a line belongs to the piece in which it begins."""
    store, _ = store_of(root)
    with io.BufferedReader(store.open_input_file(piece.path), 1 << 20) as file:
        at = piece.start
        if at:  # whatever is on before the first line end has begun in the piece before
            file.seek(at - 1)
            at += len(file.readline()) - 1
        while at < piece.end:
            line = file.readline()
            if not line:
                return
            yield at, line
            at += len(line)


def parsed(line: bytes) -> list:
    """The columns of a line, then what could not be read of it."""
    try:
        row = json.loads(line.decode("utf-8-sig"))
        if not isinstance(row, dict):
            raise ValueError
        values = [row.get(name) for name, _ in _FIELDS]
        if any(v is not None and (isinstance(v, bool) or not isinstance(v, int if name in _WHOLE else str)) for (name, _), v in zip(_FIELDS, values, strict=True)):
            raise ValueError
        return [*values, None]
    except (ValueError, UnicodeDecodeError):
        return [None] * len(_FIELDS) + [line.decode("utf-8", "replace").rstrip("\r\n")]


class _Reading:
    def __init__(self, options: dict[str, str]):
        self.root, self.size = options["path"], int(options.get("pieceBytes", PIECE))
        self.first, self.last = (int(options[k]) if k in options else None for k in ("first", "last"))

    def may_hold(self, path: str) -> bool:
        """Whether a file can have rows from second ``first`` to second ``last``."""
        span = span_of(path)
        return span is None or ((self.first is None or span[1] >= self.first) and (self.last is None or span[0] <= self.last))

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        kinds = [*(pa.int64() if name in _WHOLE else pa.string() for name, _ in _FIELDS), pa.string(), pa.string(), pa.int64()]
        names = [*(name for name, _ in _FIELDS), "corrupt", "file", "at"]
        rows: list[list] = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for at, line in lines_of(self.root, piece):
            if line.strip():
                rows.append([*parsed(line), piece.path, at])
                if len(rows) >= _ROWS:
                    yield out()
                    rows = []
        if rows:
            yield out()


class ExportReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Piece]:
        return [p for path, size in files_below(self.root) if self.may_hold(path) for p in pieces_of(path, 0, size, self.size)]


class ExportStream(_Reading, DataSourceStreamReader):
    """Exports that grow: files come in the order of their names and only the last one is written to,
    so a place is a name and an offset in the file.  A line counts once it has ended."""

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def latestOffset(self) -> dict:
        found = [f for f in files_below(self.root) if f[1]]
        if not found:
            return self.initialOffset()
        path, size = found[-1]
        return {"file": path, "at": self._line_end(path, size)}

    def _line_end(self, path: str, size: int) -> int:
        store, _ = store_of(self.root)
        with store.open_input_file(path) as file:
            end = size
            while end:
                begin = max(0, end - (1 << 16))
                file.seek(begin)
                found = file.read(end - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                end = begin
        return 0

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        new = [f for f in files_below(self.root) if start["file"] <= f[0] <= end["file"]]
        ranges = [(p, start["at"] if p == start["file"] else 0, end["at"] if p == end["file"] else size) for p, size in new if self.may_hold(p)]
        return [piece for p, a, b in ranges for piece in pieces_of(p, a, b, self.size)]


class ExportSource(DataSource):
    """Format ``chat_exports``: options ``path``, ``first`` and ``last`` (seconds; files of other days are
    not opened), and ``pieceBytes`` for the size of a piece."""

    @classmethod
    def name(cls) -> str:
        return "chat_exports"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ExportReader:
        return ExportReader(self.options)

    def streamReader(self, schema) -> ExportStream:
        return ExportStream(self.options)


def read_exports(spark: SparkSession, path: str, time: TimeRange | None = None, stream: bool = False, **options) -> DataFrame:
    """Messages of the exports below ``path``, and for each its file and its offset there; a line that is
    no message has it in ``corrupt``.  With ``time`` only rows in it, from files that can have any."""
    spark.dataSource.register(ExportSource)
    given = {"path": path} | {k: str(v) for k, v in options.items()}
    if time is not None:
        given |= {k: str(v) for k, v in (("first", time.start), ("last", None if time.end is None else time.end - 1)) if v is not None}
    rows = (spark.readStream if stream else spark.read).format("chat_exports").options(**given).load()
    return rows if time is None else rows.filter(time.holds(F.col("timestamp")))
