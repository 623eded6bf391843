import json
import random

import pytest

from talkloom.functions.times import TimeRange
from talkloom.sources import exports, readers


def line(i, t, **more):
    row = {"source": "w", "chat_id": "c", "message_id": str(i), "record_id": f"c:{i}", "timestamp": t, "seq": i, "text": f"grüße {i}"}
    return json.dumps(row | more, ensure_ascii=i % 2 == 0)


@pytest.fixture
def folder(tmp_path):
    """Two months of days, a file without a date, and lines that are none."""
    rng = random.Random(1)
    for month in (1, 2):
        for day in range(1, 11):
            start = 1_704_038_400 + (month - 1) * 31 * 86400 + (day - 1) * 86400  # local midnight
            lines = [line(month * 1000 + day * 20 + i, start + rng.randrange(86400)) for i in range(15)]
            path = tmp_path / "in" / f"2024-{month:02d}"
            path.mkdir(parents=True, exist_ok=True)
            (path / f"2024-{month:02d}-{day:02d}.jsonl").write_text("\n".join(lines) + "\n" * (day % 2), encoding="utf-8")
    odd = ["", "  ", "{broken", "[1]", line(1, "text"), line(2, 1_704_100_000), line(3, None), "﻿" + line(4, 1_704_100_001, extra=[1])]
    (tmp_path / "in" / "rest.jsonl").write_text("\r\n".join(odd), encoding="utf-8")
    (tmp_path / "in" / "_SUCCESS").write_text("no export")
    return str(tmp_path / "in")


def read(spark, folder, time=None, **options):
    return exports.read_exports(spark, folder, time, **options)


def rows(frame):
    return sorted(((r.record_id, r.timestamp, r.text, r.corrupt) for r in frame.collect()), key=str)


@pytest.mark.parametrize("size", [40, 333, 1 << 26])
def test_pieces_of_any_size_give_the_same_rows(spark, folder, size):
    found = rows(read(spark, folder, pieceBytes=size))
    assert len(found) == 300 + 6 and len({f[0] for f in found}) == 303 + 1
    assert sorted(f[3] for f in found if f[3]) == sorted(["{broken", "[1]", line(1, "text")])
    good, _ = readers.read_normalized(spark, f"{folder}/*/*.jsonl")
    plain = sorted(((r.record_id, r.timestamp, r.text, None) for r in good.collect()), key=str)
    assert [f for f in found if f[0] and f[0] not in ("c:2", "c:3", "c:4")] == plain


def test_a_bound_skips_files(spark, folder):
    whole, days = read(spark, folder), TimeRange(1_704_038_400 + 32 * 86400, 1_704_038_400 + 34 * 86400)
    bounded = read(spark, folder, days)
    assert bounded.select("file").distinct().count() == 2
    assert bounded.rdd.getNumPartitions() == 3 < whole.rdd.getNumPartitions() == 21  # two days and the file without one
    assert rows(bounded) == [r for r in rows(whole) if r[1] and days.start <= r[1] < days.end]
    assert rows(read(spark, folder, TimeRange(None, days.end))) == [r for r in rows(whole) if r[1] and r[1] < days.end]
    assert len(rows(whole)) == 306 and rows(read(spark, folder, TimeRange(5, 5))) == []
    assert exports.span_of("/x/2024-02.jsonl") == (1_706_716_800, 1_706_716_800 + 29 * 86400 - 1) and exports.span_of("/x/2024-13-01") is None is exports.span_of("/12024-01-01")


def test_stream_goes_on_where_it_stopped(spark, folder, tmp_path):
    def run():
        stream = read(spark, folder, stream=True, pieceBytes=200)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").start(f"{tmp_path}/out")
        query.processAllAvailable()
        query.stop()
        return rows(spark.read.parquet(f"{tmp_path}/out"))

    import pathlib

    last = pathlib.Path(folder) / "rest.jsonl"
    first = run()
    whole = last.read_bytes()
    assert len(first) == 305  # the last line of the last file has not ended
    last.write_bytes(whole + b"\r\n" + line(9000, 5)[:20].encode())
    assert len(run()) == 306
    last.write_bytes(whole + b"\r\n" + line(9000, 5).encode() + b"\n")
    (pathlib.Path(folder) / "s.jsonl").write_text(line(9001, 6) + "\n")
    assert run() == rows(read(spark, folder)) and len(run()) == 308


def test_a_large_month_is_written_by_several_tasks(spark, data, monkeypatch):
    from pathlib import Path

    from talkloom.catalog import stores
    from talkloom.sources import scratch

    places = []
    monkeypatch.setattr(stores, "_place", lambda s, name: places.append(f"{scratch.shared_dir(s)}/large-month") or places[-1])
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        stores.exports_in_range(spark, data)
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(list(Path(places[0]).glob("month=2024-01/*.json"))) > 1
