"""A store of messages clustered by time, from which a page opens a file or two.

Every part of the store is sorted: its files cover ranges of the order key that do not overlap, and
a zone map says for each file its least and greatest key and its rows.  A page looks up the zones
around its position and reads only files whose range it can meet, however deep it is and however
many files there are.  What is appended makes a further part; parts are merged by level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.operators.paging import ORDER, Page, after_key, decode_cursor, encode_cursor, order_columns, scope_hash
from talkloom.plans.commits import CommitLog, Part, merge_levels
from talkloom.sources.scratch import kept


class PageStore:
    """Messages below ``path`` in the order of ``keys``, none of which may be null.

    ``file_rows`` is about how many rows a file gets.  For pages of single chats, put ``chat_id``
    before the other keys.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ORDER, file_rows: int = 1_000_000):
        self.spark, self.keys, self.file_rows, self.log = spark, tuple(keys), file_rows, CommitLog(spark, path, ("zones",))

    # -- writing ----------------------------------------------------------------------------------

    def _write(self, messages: DataFrame, rows: int, level: int = 0, first: int = 0, last: int = 0) -> Part:
        """A sorted part with its zone map beside the ``rows`` rows."""
        files = max(1, round(rows / self.file_rows))
        part = self.log.write(messages.repartitionByRange(files, *self.keys).sortWithinPartitions(*self.keys), level, first, last)
        key = F.struct(*self.keys)
        # each file was sorted by one task, so its range is that of its own rows
        zones = (
            self.spark.read.schema(messages.schema).parquet(self.log.folder(part)).select(*self.keys, F.col("_metadata.file_name").alias("file"))
            .groupBy("file").agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("rows"))
        )
        named = [F.col(f"{side}.{k}").alias(f"{side}_{k}") for side in ("lo", "hi") for k in self.keys]
        zones.select("file", "rows", *named).sort(*[f"hi_{k}" for k in self.keys]).coalesce(1).write.parquet(f"{self.log.path}/zones/{part.name}")
        return Part(part.name, level, first, last, rows)

    def append(self, messages: DataFrame) -> None:
        """Add a part.  Writers may run at once; each adds its own."""
        messages = kept(messages, "appended")  # counted, sampled for its ranges and dealt, but computed once
        missing = F.count_if(F.greatest(*[F.col(k).isNull() for k in self.keys]))
        rows, without = messages.agg(F.count("*"), missing).first()
        if without:
            raise ValueError(f"{without} rows lack a part of their key")
        part = self._write(messages, rows)
        facts = {"schema": messages.schema.json(), "keys": list(self.keys)}

        def add(commit):
            if commit.parts and commit.facts != facts:
                raise ValueError("the store has other columns or another order")
            turn = max((p.last for p in commit.parts), default=0) + 1
            return (*commit.parts, Part(part.name, 0, turn, turn, part.rows)), facts

        self.log.update(add)

    def merge(self, fan: int = 4) -> None:
        """Merge parts by level; pages go on meanwhile and see the same rows."""
        merge_levels(self.log, lambda old, *place: self._write(self.log.frame(old), sum(p.rows for p in old), *place), fan)

    # -- reading ----------------------------------------------------------------------------------

    def rows(self) -> DataFrame | None:
        """All messages of the store."""
        return self.log.frame(self.log.latest().parts)

    def zones(self, parts: tuple[Part, ...]) -> DataFrame:
        found = self.spark.read.parquet(*[f"{self.log.path}/zones/{p.name}" for p in parts])
        return found.withColumn("part", F.regexp_extract(F.col("_metadata.file_path"), "/zones/([0-9a-f]+)/", 1))

    def _files(self, parts: tuple[Part, ...], limit: int, position: list | None, descending: bool, prefix: list) -> list[str]:
        """Files that can hold any of the next ``limit`` rows.

        Zones are taken by their far ends until they are sure to hold enough rows: a zone that lies
        wholly behind the position holds all its rows there, one that is cut by it at least one.
        Whatever begins before the end of the last of them may hold rows of the page.
        """
        near, far = ("hi", "lo") if descending else ("lo", "hi")
        named = lambda side: tuple(f"{side}_{k}" for k in self.keys)
        zones = self.zones(parts)
        if prefix:  # ranges that can hold keys which begin so
            own = self.keys[: len(prefix)]
            below = after_key(tuple(f"lo_{k}" for k in own), prefix, descending=True, strict=False)
            zones = zones.filter(below & after_key(tuple(f"hi_{k}" for k in own), prefix, strict=False))
        if position:
            zones = zones.filter(after_key(named(far), position, descending))
        whole = after_key(named(near), position, descending) if position else F.lit(True)
        if prefix:  # a range that begins or ends outside the prefix holds one row of it at least
            inside = F.lit(True)
            for k, value in zip(self.keys, prefix, strict=False):
                inside = inside & (F.col(f"lo_{k}") == value) & (F.col(f"hi_{k}") == value)
            whole = whole & inside
        sure = F.when(whole, F.col("rows")).otherwise(0 if prefix else 1)
        take = 4 * len(parts) + limit // self.file_rows
        while True:
            first = zones.select(*named(far), sure.alias("sure")).orderBy(*order_columns(named(far), descending)).limit(take).collect()
            total, end = 0, None
            for row in first:
                total += row["sure"]
                if total >= limit:
                    end = [row[k] for k in named(far)]
                    break
            if end is not None or len(first) < take:
                break
            take *= 4
        if end is not None:
            zones = zones.filter(after_key(named(near), end, not descending, strict=False))
        return [f"{self.log.folder(r['part'])}/{r['file']}" for r in zones.select("part", "file").collect()]  # as many as the page needs

    def page_rows(self, limit: int, position: list | None = None, descending: bool = False, prefix: tuple = ()) -> DataFrame:
        """The next ``limit`` rows after ``position`` whose key begins with ``prefix``."""
        commit = self.log.latest()
        files = self._files(commit.parts, limit, position, descending, list(prefix)) if commit.parts else []
        if not files:
            return self.spark.createDataFrame([], self.rows().schema) if commit.parts else self.spark.createDataFrame([], "empty int")
        rows = self.spark.read.schema(self.rows().schema).parquet(*files)
        for key, value in zip(self.keys, prefix, strict=False):
            rows = rows.filter(F.col(key) == value)
        if position:
            rows = rows.filter(after_key(self.keys, position, descending))
        return rows.orderBy(*order_columns(self.keys, descending)).limit(limit)

    def page(self, limit: int, cursor: str | None = None, descending: bool = False, prefix: tuple = (), **scope) -> Page:
        """One page and the cursor of the next, as :func:`talkloom.operators.paging.keyset_page` gives
        them.  Its rows (at most 5,000) are read once and held by the driver."""
        if not 1 <= limit <= 5000:
            raise ValueError("limit must be between 1 and 5000")
        own = scope_hash(keys=self.keys, descending=descending, prefix=prefix, **scope)
        found = self.page_rows(limit + 1, decode_cursor(cursor, own) if cursor else None, descending, prefix)
        rows = found.collect()
        more = len(rows) > limit
        after = encode_cursor([rows[limit - 1][k] for k in self.keys], own) if more else None
        return Page(self.spark.createDataFrame(rows[:limit], found.schema), more, after)
