import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkloom.functions.times import TimeRange, local_day, local_time, message_month, parse_bound, parse_bounds

GOOD = {
    "2024-01-07": 1704556800, " 2024-01-07 ": 1704556800, "2024-01-07 01:02": 1704560520, "2024-01-07T01:02:03": 1704560523,
    "2024-01-07T01:02:03Z": 1704589323, "2024-01-07 01:02+09:00": 1704556920, "2024-01-07T01:02:03-05:30": 1704609123,
    "1700000000": 1700000000, "1700000000123": 1700000000, "-5": -5, "0": 0,
}
BAD = ["", " ", "20240107", "12345678901234", "2024-W01-1", "2024-01-07T01", "2024-01-07 01:02:03.5", "2024-13-01", "1e9", "1.5", "yesterday", "20240107T010203"]


def test_accepted():
    for text, want in GOOD.items():
        assert parse_bound(text) == want
    assert parse_bound("2024-01-07", before=True) == 1704556800 + 86400
    assert parse_bound(1700000000) == 1700000000 and parse_bound(None) is None


@pytest.mark.parametrize("text", [*BAD, True, 1.5, []])
def test_refused(text):
    with pytest.raises(ValueError):
        parse_bound(text)


def test_columns_agree_with_literals(spark):
    texts = [*GOOD, *[b for b in BAD if b != "2024-13-01"]]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_bounds(F.col("t")).alias("a"), parse_bounds(F.col("t"), True).alias("b")).collect()
    for r in found:
        assert r.a == GOOD.get(r.t)
        if r.t in GOOD:
            assert r.b == parse_bound(r.t, before=True)


def test_ranges():
    assert TimeRange.of(date="2024-01-07") == TimeRange(1704556800, 1704643200)
    assert TimeRange.of("2024-01-07", "2024-01-07").end == 1704643200
    assert TimeRange.of("2024-01-07", "2024-01-07", end_date_inclusive=False).empty
    assert TimeRange.of("5", "5").empty
    assert TimeRange(1, None).clipped(9) == TimeRange(1, 9) and TimeRange(1, 5).clipped(9).end == 5
    for wrong in ({"after": "9", "before": "5"}, {"date": "2024-01-07", "after": "5"}, {"date": "2024-1-7"}, {"date": 5}):
        with pytest.raises(ValueError):
            TimeRange.of(**wrong)


def test_range_reaches_the_scan(spark, data):
    rows = spark.read.parquet(f"{data}/events.parquet").filter(TimeRange(10, 20).holds(F.col("event_id")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_id,10)" in plan and "LessThan(event_id,20)" in plan
    assert spark.range(5).filter(TimeRange(3, 3).holds(F.col("id"))).count() == 0


@given(st.integers(min_value=1, max_value=4_000_000_000))
def test_bound_of_its_own_text(seconds):
    local = dt.datetime.fromtimestamp(seconds, dt.timezone(dt.timedelta(hours=8)))
    assert parse_bound(local.isoformat()) == parse_bound(local.replace(tzinfo=None).isoformat(" ")) == seconds


def test_local_columns(spark):
    r = spark.createDataFrame([(1704556799,)], "t bigint").select(
        local_time(F.col("t")), local_day(F.col("t")), local_time(F.lit(0)), message_month(F.col("t") * 1000), message_month(F.lit(None).cast("bigint"), F.lit("2024-02-03 x"))
    ).first()
    assert tuple(r) == ("2024-01-06 23:59:59+08:00", "2024-01-06", None, "2024-01", "2024-02")
