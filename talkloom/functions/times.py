"""Time bounds, and local time at a fixed offset of eight hours."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_SECONDS = 8 * 3600
ZONE = dt.timezone(dt.timedelta(seconds=OFFSET_SECONDS))
_INTEGER = r"^[+-]?[0-9]+$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2})?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def parse_bound(value: str | int | None, before: bool = False) -> int | None:
    """Epoch seconds of a bound; ValueError for what is ambiguous or malformed.

    Integers are seconds, or milliseconds if they have 13 digits; a bare day as an upper bound
    covers that day; times without a zone are local; fractions of a second are refused.
    """
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (str, int)):
        raise ValueError(f"not a time bound: {value!r}")
    text = str(value).strip()
    if re.match(_INTEGER, text):
        digits = len(text.lstrip("+-"))
        if digits == 8 or digits > 13:
            raise ValueError(f"ambiguous number of digits: {text}")
        return int(text) // 1000 if digits == 13 else int(text)
    if re.match(_DAY, text):
        day = dt.datetime.combine(dt.date.fromisoformat(text), dt.time(), ZONE)
        return int((day + dt.timedelta(days=before)).timestamp())
    if not re.match(_MOMENT, text):
        raise ValueError(f"neither a day nor a time in whole seconds: {text!r}")
    moment = dt.datetime.fromisoformat(text)
    return int((moment if moment.tzinfo else moment.replace(tzinfo=ZONE)).timestamp())


@dataclass(frozen=True)
class TimeRange:
    """``start <= t < end``; either side may be open."""

    start: int | None = None
    end: int | None = None

    @classmethod
    def of(cls, after=None, before=None, date: str | None = None, end_date_inclusive: bool = True) -> TimeRange:
        if date is not None:
            if after is not None or before is not None:
                raise ValueError("a day excludes other bounds")
            if not isinstance(date, str) or not re.match(_DAY, date):
                raise ValueError("a day looks like 2024-01-31")
            after = before = date
            end_date_inclusive = True
        found = cls(parse_bound(after), parse_bound(before, end_date_inclusive))
        if found.start is not None and found.end is not None and found.start > found.end:
            raise ValueError("the range ends before it starts")
        return found

    def clipped(self, snapshot: int) -> TimeRange:
        """No later than the snapshot."""
        return TimeRange(self.start, snapshot if self.end is None else min(self.end, snapshot))

    @property
    def empty(self) -> bool:
        return self.start is not None and self.end is not None and self.start >= self.end

    def holds(self, column: Column) -> Column:
        """Plain comparisons with literals, which reach the Parquet scan."""
        if self.empty:
            return F.lit(False)
        found = F.lit(True)
        if self.start is not None:
            found = column >= self.start
        if self.end is not None:
            found = found & (column < self.end) if self.start is not None else column < self.end
        return found


def parse_bounds(column: Column, before: bool = False) -> Column:
    """The same for a string column; null where the value is not a bound."""
    text = F.trim(column)
    digits = F.length(F.regexp_replace(text, r"^[+-]", ""))
    number = F.try_to_number(text, F.lit("S9999999999999")).cast("bigint")
    whole = F.when(digits == 13, F.floor(number / 1000)).when((digits != 8) & (digits < 13), number)
    padded = F.when(text.rlike(r"[0-9]:[0-9]{2}:[0-9]{2}"), text).otherwise(F.regexp_replace(text, r"([T ][0-9]{2}:[0-9]{2})", "$1:00"))
    clock = F.try_to_timestamp(F.replace(F.substring(padded, 1, 19), F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm:ss"))
    zone = F.regexp_extract(text, r"(Z|[+-][0-9]{2}:[0-9]{2})$", 1)
    shift = (
        F.when(~text.rlike(r":[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})$"), OFFSET_SECONDS)
        .when(zone == "Z", 0)
        .otherwise(
            F.when(zone.startswith("-"), -1).otherwise(1)
            * (F.try_to_number(F.substring(zone, 2, 2), F.lit("99")) * 3600 + F.try_to_number(F.substring(zone, 5, 2), F.lit("99")) * 60)
        )
    )
    day = F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    return (
        F.when(text.rlike(_INTEGER), whole)
        .when(text.rlike(_DAY), F.unix_seconds(day) - OFFSET_SECONDS + (86400 if before else 0))
        .when(text.rlike(_MOMENT), F.unix_seconds(clock) - shift)
        .cast("bigint")
    )


def epoch_of(column: str) -> Column:
    """Epoch seconds of a timestamp column without a zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})")


def _local(column: Column) -> Column:
    seconds = (column + OFFSET_SECONDS).cast("decimal(18,0)")
    zero = F.lit(0)
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(zero, zero, zero, seconds)


def local_time(column: Column) -> Column:
    """ISO text at +08:00; null and zero have none."""
    return F.when(column != 0, F.concat(F.date_format(_local(column), "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")))


def local_day(column: Column) -> Column:
    return F.date_format(_local(column), "yyyy-MM-dd")


def local_month(column: Column) -> Column:
    return F.date_format(_local(column), "yyyy-MM")


def message_month(seconds: Column, text: Column | None = None) -> Column:
    """Month of a number of seconds or milliseconds, else of an ISO text."""
    whole = F.when(seconds >= 10**11, F.floor(seconds / 1000)).otherwise(seconds)
    found = F.when(seconds > 0, local_month(whole.cast("bigint")))
    return found if text is None else F.coalesce(found, F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}"), F.substring(text, 1, 7)))
