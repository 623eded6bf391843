import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkloom.functions import media as on
from talkloom.functions import texts
from talkloom.functions.times import local_day
from talkloom.operators import combine, enrich, filters, identity, lookup, media, normalize, observe, paging, payload, snapshot
from talkloom.plans import views, workflow
from talkloom.plans.commits import CommitLog
from talkloom.sources import readers, sinks
from talkloom.streaming import observe as streams


@pytest.fixture(scope="module")
def chat(spark):
    """Two chats with ties inside a second."""
    rows = [("w", f"c{i % 2}", str(i), f"c{i % 2}:{i}", None, 1_700_000_000 + i // 5 * 40_000, i % 5, f"u{i % 3}", f"n{i % 3}", "incoming", "reported", "text", f"t{i}") for i in range(60)]
    return spark.createDataFrame(rows, readers.NORMALIZED)


def test_nested_rules(spark):
    rows = spark.createDataFrame(
        [("c", ("9", 1), 5, "a", "A", True, "text", "x", None), ("c", (None, 2), 5, None, "B", None, "system", None, None), ("c", ("", 3), 5, "b", "C", False, "text", "y", ["sender_identity_conflict: z"])],
        "chat_id string, id struct<server_id_str:string,local_id:bigint>, create_time bigint, sender_wxid string, sender string, is_from_me boolean, kind string, text string, warnings array<string>",
    )
    a, b, c = normalize.normalize_nested(rows).orderBy("seq").collect()
    assert (a.message_id, a.record_id, a.direction, a.identity_status) == ("9", "c:9:1:5:text", "outgoing", "reported")
    assert (b.message_id, b.direction, b.identity_status, b.text) == ("2", "system", "unknown", "")
    assert (c.message_id, c.sender_id, c.sender_name, c.direction, c.identity_status) == ("3", None, "unknown", "unknown", "conflict")


def test_primary_has_authority(spark):
    main = spark.createDataFrame([("c", 1, 10, None), ("c", 2, 20, "s")], "chat_id string, msg_id long, timestamp long, sender_uid string")
    index = spark.createDataFrame([("c", 1, 99, "other", "t1"), ("c", 3, 30, "z", "t3")], "chat_id string, msg_id long, timestamp long, sender_uid string, text string")
    found = {r.msg_id: r for r in combine.merge_primary_index(main, index).collect()}
    assert (found[1].timestamp, found[1].sender_uid, found[1].text, found[1].fts_only) == (10, None, "t1", False)
    assert found[2].text is None and (found[3].timestamp, found[3].fts_only) == (30, True)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [1, 7, 59, 60, 100])
def test_pages_join_to_the_whole(chat, limit, descending):
    whole = [r.record_id for r in chat.orderBy(*paging.order_columns(paging.ORDER, descending)).collect()]
    seen, cursor = [], None
    for _ in range(0, 60 if limit > 1 else 3 * limit, limit):
        page = paging.keyset_page(chat, limit, cursor, descending=descending, who="x")
        seen += [r.record_id for r in page.rows.collect()]
        cursor = page.next_cursor
        assert page.has_more == (len(seen) < 60)
        if not page.has_more:
            break
    assert seen == whole[: len(seen)] and (limit == 1 or len(seen) == 60)


def test_cursors_are_bound_to_their_query(chat):
    page = paging.keyset_page(chat, 5, who="a")
    for wrong in ({"cursor": page.next_cursor, "who": "b"}, {"cursor": "junk", "who": "a"}, {"cursor": page.next_cursor, "offset": 3, "who": "a"}):
        with pytest.raises(ValueError):
            paging.keyset_page(chat, 5, **wrong)


def test_context_and_ties(spark, chat):
    targets = spark.createDataFrame([(1, "c0", "c0:10"), (2, "c1", "c1:1"), (3, "c1", "missing")], "target_id int, chat_id string, record_id string")
    found = lookup.context(chat, targets, 2, 2).orderBy("target_id", "steps").collect()
    assert [r.record_id for r in found if r.target_id == 1] == ["c0:6", "c0:8", "c0:10", "c0:12", "c0:14"]
    assert [r.side for r in found if r.target_id == 2] == ["target", "after", "after"]
    assert not [r for r in found if r.target_id == 3]
    twice = chat.unionByName(chat.filter("record_id = 'c0:10'"))
    assert lookup.context(twice, targets.filter("target_id = 1")).count() == 0
    assert lookup.locate(twice, targets).filter("target_id = 1").first().status == "ambiguous"
    with pytest.raises(ValueError):
        lookup.context(chat, targets, 51, 0)


def test_selectors():
    assert filters.sender_selector("123") == ("sender_uin", "123")
    assert filters.sender_selector("u_x") == ("sender_uid", "u_x")
    assert filters.sender_selector("from_me") == ("direction", "from_me")
    assert filters.sender_selector("name: 123") == ("sender_name", "123")
    assert filters.sender_selector("Ann: B") == ("sender_name", "Ann: B")
    assert filters.sender_selector(uin="5") == ("sender_uin", "5") and filters.sender_selector("") is None
    for wrong in (("x", {"uid": "y"}), ("", {"uid": "y", "uin": "z"}), ("uid:", {})):
        with pytest.raises(ValueError):
            filters.sender_selector(wrong[0], **wrong[1])
    with pytest.raises(ValueError):
        filters.has_keyword("  ", "text")


def test_contact_resolution(spark):
    people = spark.createDataFrame(
        [("u_1", "11", "Ann", "boss"), ("u_2", "22", "Ann", None), ("u_3", "33", "44", None), ("u_4", "44", "Dan", None), (None, "55", "Eve", None), ("u_6", "66", "F", None), ("u_6", "67", "F2", None)],
        "uid string, uin string, nick string, remark string",
    )
    asked = ["u_1", "11", "Ann", "boss", "44", "name:44", "Eve", "u_6", "66", "nobody", " ", "uid: u_2"]
    found = {r.query: (r.status, r.uid) for r in identity.resolve_contacts(spark.createDataFrame([(q,) for q in asked], "query string"), people).collect()}
    assert found == {
        "u_1": ("resolved", "u_1"), "11": ("resolved", "u_1"), "Ann": ("ambiguous", None), "boss": ("resolved", "u_1"), "44": ("resolved", "u_4"), "name:44": ("resolved", "u_3"),
        "Eve": ("missing_uid", None), "u_6": ("ambiguous", None), "66": ("conflicting_mapping", None), "nobody": ("not_found", None), " ": ("invalid", None), "uid: u_2": ("resolved", "u_2"),
    }


def test_sender_verdicts(spark):
    rows = spark.createDataFrame(
        [("private", "p", "me", "1"), ("private", "p", "pe", "2"), ("private", "p", "pe", "9"), ("private", "p", "zz", None), ("group", "g", "m1", "0"), ("group", "g", None, "7"), ("group", "g", "new", None)],
        "chat_type string, chat_id string, sender_uid string, sender_uin string",
    )
    contacts = spark.createDataFrame([("p", "pe", "2", "Pe")], "chat_id string, uid string, uin string, name string")
    members = spark.createDataFrame([("g", "m1", "5", "M1"), ("g", "m2", "7", "M2")], "chat_id string, uid string, uin string, name string")
    found = {(r.sender_uid, r.sender_uin): (r.direction, r.sender) for r in identity.sender_verdicts(rows, contacts, members, "me", "1").collect()}
    assert found == {
        ("me", "1"): ("from_me", "me"), ("pe", "2"): ("from_contact", "Pe"), ("pe", "9"): ("unknown", "pe"), ("zz", None): ("unknown", "zz"),
        ("m1", "0"): ("from_member", "M1"), (None, "7"): ("from_member", "M2"), ("new", None): ("from_member", "new"),
    }
    unknown = identity.sender_verdicts(rows, contacts, members, None, None)
    assert {r.direction for r in unknown.collect()} == {"unknown"}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.booleans()), min_size=1, max_size=25), st.integers(1, 24))
def test_fold_equals_replay(spark, steps, cut):
    rows = [("c", m, i, ok, f"t{i}" if ok else "", "k") for i, (m, ok) in enumerate(steps)]
    kept = {}
    for _, m, _, ok, text, _ in rows:
        if m not in kept or not kept[m][0] or ok:
            kept[m] = (ok, text)
    log = spark.createDataFrame(rows, "chat_id string, msg_id int, observed_at int, recoverable boolean, text string, kind string")
    assert {r.msg_id: (r.recoverable, r.text) for r in observe.fold_observations(log).collect()} == kept


def test_interval_join_equals_definition(spark):
    rng = random.Random(3)
    events = [("c", 1000 + i, rng.randrange(1, 400)) for i in range(30)]
    cache = [("c", i, rng.randrange(1, 400), rng.random() < 0.8, "x") for i in range(60)]
    live = [("c", i) for i in range(0, 60, 4)]
    want = set()
    for _, e, t in events:
        near = sorted((t - s, m) for _, m, s, ok, _ in cache if ok and 0 <= t - s <= 50 and m % 4)[:5]
        want |= {(e, m, d) for d, m in near}
    found = observe.recall_candidates(
        spark.createDataFrame(events, "chat_id string, msg_id long, timestamp long"), spark.createDataFrame(cache, "chat_id string, msg_id long, timestamp long, recoverable boolean, text string"),
        spark.createDataFrame(live, "chat_id string, msg_id long"), window=50,
    )
    assert {(r.event_id, r.msg_id, r.seconds) for r in found.collect()} == want


def test_stream_equals_batch(spark, tmp_path):
    rows = [("c", i % 7, i, i % 3 != 0, f"t{i}", "k") for i in range(40)]
    schema = "chat_id string, msg_id int, observed_at int, recoverable boolean, text string, kind string"
    log = spark.createDataFrame(rows, schema)
    log.repartition(5).write.parquet(f"{tmp_path}/in")
    query = streams.stream_cache(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), f"{tmp_path}/folded", f"{tmp_path}/cp")
    query.processAllAvailable()
    query.stop()
    assert sorted(streams.read_cache(spark, f"{tmp_path}/folded").collect()) == sorted(observe.fold_observations(log).collect())


def test_parts_of_a_long_stream_are_merged(spark, tmp_path):
    schema = "chat_id string, msg_id int, observed_at int, recoverable boolean, text string, kind string"
    log = spark.createDataFrame([("c", i % 5, i, i % 3 != 0, f"t{i}", "k") for i in range(13)], schema)
    log.repartition(13, "observed_at").write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/in")
    stream = lambda: streams.stream_cache(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), f"{tmp_path}/folded", f"{tmp_path}/cp", fan=3)
    query = stream()
    held = None
    while query.isActive and query.lastProgress is None or held is None:
        query.processAllAvailable()
        held = streams.read_cache(spark, f"{tmp_path}/folded")
    query.stop()
    commits = CommitLog(spark, f"{tmp_path}/folded")
    assert max(p.last for p in commits.latest().parts) == 12 and len(commits.latest().parts) <= 2 * 3
    want = sorted(observe.fold_observations(log).collect())
    assert sorted(held.collect()) == want
    before = commits.latest()
    streams.add_batch(commits, held.limit(1), 7)  # a batch that is run again
    assert commits.latest() == before
    streams.merge_cache(spark, f"{tmp_path}/folded", fan=2)
    assert sorted(held.collect()) == want == sorted(streams.read_cache(spark, f"{tmp_path}/folded").collect())
    assert streams.clean_cache(spark, f"{tmp_path}/folded", older=-60) and sorted(streams.read_cache(spark, f"{tmp_path}/folded").collect()) == want
    with pytest.raises(ValueError, match="committed"):
        streams.read_cache(spark, f"{tmp_path}/none")


def test_stream_joins_and_duplicates(spark, tmp_path):
    spark.createDataFrame([("c", 1, 1000), ("c", 2, 5000)], "chat_id string, msg_id int, timestamp long").write.parquet(f"{tmp_path}/e")
    spark.createDataFrame([("c", 7, 990, True), ("c", 8, 800, True), ("c", 9, 4999, False)], "chat_id string, msg_id int, timestamp long, recoverable boolean").write.parquet(f"{tmp_path}/c")
    read = lambda p, s: spark.readStream.schema(s).parquet(f"{tmp_path}/{p}")
    joined = streams.stream_recoveries(read("e", "chat_id string, msg_id int, timestamp long"), read("c", "chat_id string, msg_id int, timestamp long, recoverable boolean"), 60)
    query = joined.writeStream.format("memory").queryName("recovered").option("checkpointLocation", f"{tmp_path}/cp1").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.event_id, r.msg_id) for r in spark.table("recovered").collect()] == [(1, 7)]
    spark.createDataFrame([("w", "a", 5), ("w", "a", 5), ("w", "b", 6)], "source string, record_id string, t long").write.parquet(f"{tmp_path}/d")
    once = streams.stream_without_duplicates(read("d", "source string, record_id string, t long"), F.timestamp_seconds("t"))
    streams.append_snapshot(once, f"{tmp_path}/out", f"{tmp_path}/cp2").awaitTermination()
    assert sorted(r.record_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]


def test_snapshot_resumes_and_refuses(spark, chat, tmp_path):
    path = f"{tmp_path}/snap"
    first = chat.filter(local_day(F.col("timestamp")) < "2023-11-17")
    workflow.export_snapshot(first, path, chats="all")
    before = workflow.snapshot_records(spark, path).count()
    verdicts = {r.verdict for r in workflow.export_snapshot(chat, path, chats="all").collect()}
    assert "added" in verdicts and workflow.snapshot_records(spark, path).count() > before
    assert workflow.snapshot_records(spark, path).select("record_id").distinct().count() == 60
    assert readers.snapshot_sources(spark, path).first().rows == 60
    with pytest.raises(ValueError, match="scope"):
        workflow.export_snapshot(chat, path, chats="one")
    with pytest.raises(ValueError, match="history"):
        workflow.export_snapshot(chat.withColumn("text", F.lit("new")), path, chats="all")


def test_snapshot_grows_and_survives_a_broken_run(spark, chat, tmp_path, monkeypatch):
    path = f"{tmp_path}/snap"
    workflow.export_snapshot(chat.filter("seq < 3"), path, chats="all")
    kept = workflow.snapshot_records(spark, path).count()
    with monkeypatch.context() as broken:
        broken.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            workflow.export_snapshot(chat.filter("seq < 4"), path, chats="all")
    assert workflow.snapshot_records(spark, path).count() == kept  # nothing of the broken run is read
    verdicts = {r.verdict for r in workflow.export_snapshot(chat, path, chats="all").collect()}
    records = workflow.snapshot_records(spark, path)
    assert verdicts == {"grown"} and records.count() == 60 == records.select("record_id").distinct().count()
    assert {r.verdict for r in workflow.export_snapshot(chat, path, chats="all").collect()} == {"same"}
    with pytest.raises(ValueError, match="history"):
        workflow.export_snapshot(chat.filter("record_id <> 'c0:10'"), path, chats="all")
    assert len(workflow.clean_snapshot(spark, path, older=-60)) == 1  # what the broken run had written
    assert workflow.snapshot_records(spark, path).count() == 60


def test_two_exports_at_once_lose_nothing(spark, chat, tmp_path, monkeypatch):
    """While one run writes, another commits: records of both, common ones once, an id that both have
    given to different contents told apart, and digests over both."""
    path = f"{tmp_path}/snap"
    workflow.export_snapshot(chat.filter("seq < 2"), path, chats="all")
    mine = chat.filter("seq < 3").unionByName(chat.filter("seq = 4").limit(3))
    other = chat.filter("seq < 2 OR seq = 3").unionByName(chat.filter("seq = 4").limit(2)).unionByName(chat.filter("seq = 2").limit(1).withColumn("text", F.lit("of the other run")))
    write, turns = workflow._write_part, []

    def slow(log, new, digests):
        if not turns:
            turns.append(1)
            workflow.export_snapshot(other, path, chats="all")
        return write(log, new, digests)

    monkeypatch.setattr(workflow, "_write_part", slow)
    workflow.export_snapshot(mine, path, chats="all")
    assert CommitLog(spark, path).latest().version == 3
    records = workflow.snapshot_records(spark, path)
    columns = ["source", "timestamp", "text", "seq", "chat_id"]
    want = {tuple(r) for df in (mine, other) for r in df.select(*columns).collect()}
    assert records.count() == len(want) == records.select("source", "record_id").distinct().count()
    assert {tuple(r) for r in records.select(*columns).collect()} == want
    both = mine.unionByName(other)  # a later run finds every bucket as it is
    assert {r.verdict for r in workflow.export_snapshot(both, path, chats="all").collect()} == {"same"}
    assert readers.snapshot_sources(spark, path).agg(F.sum("rows")).first()[0] == len(want)



def test_media_inventory(spark, chat, tmp_path):
    path = f"{tmp_path}/inventory"
    rows = chat.withColumn("kind", F.when(F.col("seq") == 1, "image").when(F.col("seq") == 2, "voice").otherwise("text"))
    twice = rows.unionByName(rows)
    first = {r.kind: r.rows for r in workflow.media_inventory(twice, path, ("image",), 1_700_400_000, chat="all").collect()}
    want = {r.kind: r.n for r in rows.filter("timestamp < 1700400000").groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert first == {"image": want["image"]}
    with pytest.raises(ValueError, match="fresh"):
        workflow.media_inventory(rows, path, ("image",), 1_700_400_000, chat="all")
    both = {r.kind: r.rows for r in workflow.media_inventory(twice, path, ("image", "voice", "video"), 1_700_400_000, resume=True, chat="all").collect()}
    assert both == {"image": want["image"], "voice": want["voice"], "video": 0}
    with pytest.raises(ValueError, match="scope"):
        workflow.media_inventory(rows, path, ("image", "voice", "video"), 1_700_400_001, resume=True, chat="all")
    with pytest.raises(ValueError, match="nothing"):
        workflow.media_inventory(rows, f"{tmp_path}/none", ("image",), 5, resume=True)
    spark.read.parquet(f"{path}/parts").limit(1).drop("part").write.mode("append").parquet(f"{path}/parts/part=image")
    with pytest.raises(ValueError, match="match"):
        workflow.media_inventory(rows, path, ("image", "voice", "video"), 1_700_400_000, resume=True, chat="all")


def test_reader_follows_contents_and_options(spark, chat, tmp_path):
    path = str(tmp_path)
    assert workflow.build_reader(chat, path, 25) and not workflow.build_reader(chat, path, 25)
    assert workflow.build_reader(chat, path, 30)
    assert workflow.build_reader(chat.withColumn("text", F.concat("text", F.lit("!"))), path, 30)
    items = spark.read.json(f"{path}/reader/items")
    assert sorted(r.position for r in items.collect()) == list(range(1, 61)) and items.filter("text LIKE '%!'").count() == 60


def test_offset_pages(chat):
    page = paging.offset_page(chat, 25, 50)
    assert (page.rows.count(), page.total, page.next_offset) == (10, 60, None)
    page = paging.offset_page(chat, "25", 0, descending=True, display_descending=False)
    assert (page.total, page.next_offset) == (60, 25) and [r.timestamp for r in page.rows.collect()] == sorted(r.timestamp for r in page.rows.collect())
    assert paging.clamped("x", 50, 1, 1000) == 50 and paging.clamped(0, 50, 1, 1000) == 1 and paging.clamped(5000, 50, 1, 1000) == 1000


def test_stages_and_reader(spark, chat, tmp_path):
    candidates = chat.select("source", "record_id", F.lit("ocr").alias("stage"), F.lit("v1").alias("version"))
    stage = lambda df: df.select("source", "record_id", F.when(F.col("record_id") == "c0:0", "broken").otherwise("ok").alias("status"))
    ledger = f"{tmp_path}/ledger"
    summary = {r.status: r.n for r in workflow.run_stages(candidates, ledger, {"ocr": stage}, 1).collect()}
    assert summary == {"ok": 59, "failed": 1}
    workflow.run_stages(candidates, ledger, {"ocr": stage}, 2)
    assert spark.read.parquet(ledger).count() == 60
    workflow.run_stages(candidates, ledger, {"ocr": stage}, 3, retry_failed=True)
    assert spark.read.parquet(ledger).count() == 61
    assert workflow.build_reader(chat, str(tmp_path), 25) and not workflow.build_reader(chat, str(tmp_path), 25)
    index = spark.read.json(f"{tmp_path}/reader/index").orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.n) for r in index] == [(1, 25), (2, 25), (3, 10)]


def test_sinks_and_readers(spark, chat, tmp_path):
    sinks.write_jsonl(chat, f"{tmp_path}/j", ["timestamp", "record_id"])
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_jsonl(chat, f"{tmp_path}/j", ["timestamp"])
    good, bad = readers.read_normalized(spark, f"{tmp_path}/j")
    assert good.count() == 60 and bad.count() == 0
    (tmp_path / "k.jsonl").write_text('﻿{"source":"w","record_id":"c:1","chat_id":"c"}\n\n{"source":"z","record_id":"1"}\nnope\n{"source":"q"}\n{"source":"q","chat_id":"c","record_id":"d:1"}\n', "utf-8")
    good, bad = readers.read_normalized(spark, f"{tmp_path}/k.jsonl")
    assert [r.record_id for r in good.collect()] == ["c:1"]
    assert sorted(r.reason for r in bad.collect()) == ["contradictory_identity", "missing_record_id", "not_json", "unknown_source"]
    sinks.write_markdown(chat, f"{tmp_path}/m")
    lines = spark.read.text(f"{tmp_path}/m/chat_id=c0").collect()
    assert sum(r.value.startswith("## ") for r in lines) == chat.filter("chat_id = 'c0'").select(F.floor((F.col("timestamp") + 28800) / 86400)).distinct().count()
    inventory = readers.file_inventory(spark, f"{tmp_path}/j", "*.json")
    assert inventory.filter("length(sha256) = 64 AND bytes > 0").count() == inventory.count() > 0
    refs = inventory.select(F.lit("r").alias("record_id"), F.lit("image").alias("role"), F.lit(0).alias("occurrence"), "path")
    rows, contents = sinks.media_manifest(refs, inventory)
    assert rows.count() == refs.count() and contents.count() == inventory.select("sha256").distinct().count()


def test_optional_columns(spark):
    raw = spark.createDataFrame([(1, 5, "u")], "`40001` long, `40050` long, `40020` string")
    row = readers.scan_primary({"group": raw, "private": raw.drop("40020")}).orderBy("chat_type").collect()
    assert (row[0].msg_id, row[0].sender_uid, row[0].payload, row[0].chat_type) == (1, "u", None, "group") and row[1].sender_uid is None
    member = readers.scan_members(spark.createDataFrame([(7, "u", "  ", "nick")], "`60001` long, `1000` string, `64003` string, `20002` string")).first()
    assert member.display_name == "nick"


def number(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(f, value):
    return number(f << 3 | 2) + number(len(value)) + value


def test_payload_walk():
    name = b"0123456789abcdef0123.png"
    data = field(1, field(45101, "héllo".encode()) + field(9, name)) + field(2, field(45101, b"two")) + number(3 << 3) + number(7)
    found = payload.walk(data)
    assert found["texts"] == ["héllo", "two"] and found["images"] == [name.decode()] and not found["malformed"]
    assert payload.walk(data[:-1])["malformed"] and payload.walk(b"")["texts"] == [] and payload.walk(None)["texts"] == []
    deep = field(3, number(5 << 3) + number(7))
    for _ in range(12):
        deep = field(1, deep)
    assert payload.walk(deep)["truncated"] and payload.walk(field(1, b"x") * 3000)["truncated"]
    assert payload.walk(field(1, b"x") * 2048)["unknown"] == 2048 and not payload.walk(field(1, b"x") * 2048)["truncated"]


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.lists(st.one_of(st.text(min_size=1, max_size=9), st.integers(0, 1 << 40)), max_size=4), lambda inner: st.lists(st.one_of(st.text(min_size=1, max_size=9), inner), max_size=4), max_leaves=12))
def test_payload_tree(tree):
    want = []

    def build(node):
        out = b""
        for x in node:
            if isinstance(x, str):
                out += field(45101, x.encode())
                want.extend([x] if all(c.isprintable() or c in "\t\r\n" for c in x) else [])
            else:
                out += number(3 << 3) + number(x) if isinstance(x, int) else field(2, build(x))
        return out

    plain = [x for x in payload.walk(build(tree))["texts"]]
    assert [x for x in plain if x in want] == plain and set(want) <= set(plain)


def test_decode_only_what_is_missing(spark):
    rows = spark.createDataFrame([(1, "have", b"junk"), (2, None, field(1, field(45101, b"walked"))), (3, " ", None)], "msg_id int, index_text string, payload binary")
    assert {r.msg_id: r.text for r in payload.decode_missing(rows).collect()} == {1: "have", 2: "walked", 3: ""}


def test_stitching(spark):
    tiles = [("i", 0, 0, 0, 10, 10, "a\nb\nc"), ("i", 1, 0, 8, 10, 18, " b \nc\nd"), ("i", 2, 8, 0, 18, 10, "d\ne"), ("j", 0, 0, 0, 9, 9, None)]
    found = {r.image: (r.text, r.removed) for r in media.stitch_tiles(spark.createDataFrame(tiles, "image string, index int, x0 int, y0 int, x1 int, y1 int, raw_text string")).collect()}
    assert found["i"] == ("a\nb\nc\nd\nd\ne", 2) and found["j"][1] == 0


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(texts.without_cjk_gaps(F.lit("中 文 a b"))) == "中文 a b"
    assert one(texts.safe_name(F.lit(" ../Ä b/c.. "))) == "b_c" and one(texts.safe_name(F.lit(None).cast("string"))) == "unknown"
    assert one(texts.chat_type(F.lit(" 群聊 "))) == "group" and one(texts.chat_type(F.lit("x"))) is None and one(texts.chat_type(F.lit(None).cast("string"))) == "private"
    assert one(texts.file_names(F.lit("see report.PDF, x"))) == ["see report.PDF"]
    assert one(texts.image_names(F.lit("0123456789abcdef.png z 0123456789abcdef.png"))) == ["0123456789abcdef.png"]
    stem = "0123456789ABCDEF"
    for text, found in {
        f"x{stem}.jpg.png": [f"{stem}.jpg"], f"{stem}.gif{stem}.webp": [f"{stem}.gif", f"{stem}.webp"], f"{stem[1:]}.png": [], f"{stem}.pn g": [], f"{stem}": [],
        f"{stem * 5}.jpeg": [f"{stem * 4}.jpeg"], f"{stem}.jpg,{stem}a.png": [f"{stem}.jpg", f"{stem}a.png"], ".": [], "": [],
    }.items():
        assert one(texts.image_names(F.lit(text))) == found, text
    for text, found in {"http://": [], "xhttp://a/download?b 'https://'": ["http://a/download?b"], "https://b<http://a>": ["http://a", "https://b"], "": []}.items():
        assert one(texts.urls(F.lit(text))) == found, text
    assert one(texts.cjk_chunks(F.lit("x 你好，世界 y"))) == ["你好，世界 y"]
    node = one(texts.node_attributes(F.lit('<msg><emoji md5="ab" len = "5"/></msg>'), "emoji", ["md5", "len", "url"]))
    assert (node.md5, node.len, node.url) == ("ab", "5", None)
    assert one(texts.node_attributes(F.lit('<!DOCTYPE x><emoji md5="ab"/>'), "emoji", ["md5"])) is None
    segment = F.array(F.struct(F.lit(-0.1).alias("avg_logprob"), F.lit(0.1).alias("no_speech_prob")))
    assert one(on.review_reasons(segment, F.lit("abcabcabcabc"), F.lit(9.0), F.lit(0.1))) == ["repetition"]
    assert one(on.review_reasons(segment, F.lit("x" * 0), F.lit(9.0), F.lit(0.1))) == ["level_mismatch"]
    level = lambda text, loud: one(on.review_reasons(segment, F.lit(text), F.lit(9.0), F.lit(loud).cast("double")))
    assert [level("hi", 0.0009), level("hi", 0.001), level("", 0.008), level("", 0.0081), level("", None)] == [["level_mismatch"], [], [], ["level_mismatch"], []]
    assert one(texts.urls(F.lit('see https://b.c/d?e "http://a" /download?x=1>'))) == ["/download?x=1", "http://a", "https://b.c/d?e"]
    assert one(texts.file_names(F.lit("年报 2.docx"))) == ["年报 2.docx"]


def test_media_matching(spark):
    import hashlib

    talker = hashlib.md5(b"chat").hexdigest()
    voice = spark.createDataFrame([("a", "chat", "9", 1, 50), ("b", "chat", "8", 2, 60)], "msg_ref string, chat_id string, server_id string, local_id long, timestamp long")
    files = spark.createDataFrame([(f"{talker}_1_50_9.wav", "s1"), (f"{talker}_1_50_9_acc.wav", "s1"), (f"{talker}_2_60_8.wav", "s2"), (f"{talker}_2_60_8_x.wav", "s3"), ("junk", "s4")], "name string, sha256 string")
    assert {r.msg_ref: (r.status, r.sha256) for r in media.match_audio(voice, files).collect()} == {"a": ("ok", "s1"), "b": ("ambiguous", None)}
    more = spark.createDataFrame([(f"/c/{n}", s) for n, s in files.collect()] + [("/a/x.WAV", "x"), ("/a/longer/x.wav", "x"), ("/a/x.flac", "y"), (r"C:\a\z.mp3", "z"), ("/a/t.txt", "t")], "path string, sha256 string")
    given = [("a", "/a/x.flac", 0), ("a", "/a/longer/x.wav", 0), ("a", "/a/x.WAV", 0), ("b", "/a/t.txt", 0), ("b", "//far/x.wav", 0), ("b", "/not/there.wav", 0), ("c", r"C:\a\z.mp3", 5), ("d", f"/c/{talker}_1_50_9.wav", 0), ("e", f"/c/{talker}_1_50_9.wav", 0)]
    asked = voice.unionByName(spark.createDataFrame([("c", None, None, None, None), ("d", "chat", None, 1, 50), ("e", "chat", "7", 1, 50)], voice.schema))
    got = {r.msg_ref: (r.status, r.path, r.evidence, r.reason) for r in media.resolve_audio(asked, spark.createDataFrame(given, "msg_ref string, path string, rank int"), more).collect()}
    assert got == {
        "a": ("ok", "/a/x.WAV", "message", None), "b": ("ambiguous", None, None, None), "c": ("ok", r"C:\a\z.mp3", "message", None),
        "d": ("identity_unavailable", None, None, "cache_identity_incomplete"), "e": ("not_found", None, None, "cache_identity_mismatch"),
    }
    videos = spark.createDataFrame([("v", "r1", "2024-02"), ("w", "r2", "2024-02")], "ref_id string, resource_id string, month string")
    store = spark.createDataFrame([("r1", "2024-01", "old", False), ("r1", "2024-02", "new", False), ("r1", "2024-02", "cov", True), ("r2", "2024-02", "only", True)], "resource_id string, month string, path string, is_cover boolean")
    assert {r.ref_id: (r.video, r.cover) for r in media.match_videos(videos, store).collect()} == {"v": ("new", "cov"), "w": (None, "only")}
    wanted = spark.createDataFrame([("a", "m1", "r1"), ("b", "zz", "r1")], "ref_id string, md5 string, resource_id string")
    inventory = spark.createDataFrame([("m1", "p1", 5), ("m2", "p2", 9)], "md5 string, path string, bytes int")
    links = spark.createDataFrame([("r1", "p2")], "resource_id string, path string")
    assert {r.ref_id: (r.path, r.evidence) for r in media.match_digests(wanted, inventory, links).collect()} == {"a": ("p1", "content"), "b": ("p2", "resource")}
    refs = spark.createDataFrame([("r", "/images/0", "p1"), ("r", "/images/1", "p9")], "record_id string, media_ref string, path string")
    safe = media.safe_references(refs, spark.createDataFrame([("p1", "available"), ("p2", "broken")], "path string, verdict string"))
    assert sorted((r.path or "", r.unavailable or "") for r in safe.collect()) == [("", "unavailable_unchecked"), ("p1", "")]


def test_transcripts_and_second_hearing(spark):
    rows = spark.createDataFrame([("a", "voice?", ["no transcript yet", "other"]), ("b", "x", [])], "record_id string, text string, warnings array<string>")
    found = {r.record_id: r for r in normalize.attach_transcripts(rows, spark.createDataFrame([("a", "ok", "hello"), ("b", "failed", None)], "record_id string, status string, transcript string")).collect()}
    assert (found["a"].text, found["a"].original_voice_text, found["a"].warnings) == ("[voice] hello", "voice?", ["other"]) and found["b"].text == "x"
    results = spark.createDataFrame([("s1", "good"), ("s2", "bad")], "sha256 string, text string")

    def engine(batches):
        for b in batches:
            yield b.assign(text="again")

    heard = media.second_hearing(results, F.col("text") == "bad", engine, "sha256 string, text string")
    assert {r.sha256: r.text for r in heard.collect()} == {"s1": "good", "s2": "again"}


def test_updates_keep_source_facts(spark):
    base = spark.createDataFrame([("q", "1", "text", None, ["w1"]), ("q", "2", "text", "old", []), ("q", "3", "text", None, [])], "source string, record_id string, kind string, image_text string, warnings array<string>")
    updates = spark.createDataFrame([("q", "1", None, "new", ["w1", "w2"]), ("q", "2", "image", "new", ["w3"])], "source string, record_id string, kind string, image_text string, warnings array<string>")
    found = {r.record_id: r for r in enrich.merge_updates(base, updates, ("image_text",)).collect()}
    assert (found["1"].image_text, found["1"].warnings, found["1"].update_status) == ("new", ["w1", "w2"], "merged")
    assert (found["2"].image_text, found["2"].warnings, found["2"].update_status) == ("old", [], "refused") and found["3"].update_status == "none"


def test_views(spark, chat):
    assert views.sessions(chat).count() == 2
    people = spark.createDataFrame([(1, "Friend"), (2, "group"), (3, "official")], "uid int, contact_type string")
    uids = lambda **f: [r.uid for r in views.contacts(people, **f).collect()]
    assert (uids(friends_only=True), uids(groups_only=True), uids(kinds=("OFFICIAL", "group")), uids()) == ([1], [2], [2, 3], [1, 2, 3])
    with pytest.raises(ValueError):
        views.contacts(people, friends_only=True, groups_only=True)
    schema = views.register(spark, {"chat_messages": chat})
    assert schema.filter("column_name = 'record_id'").first().data_type == "string" and spark.sql("SELECT count(*) AS n FROM chat_messages").first().n == 60


def test_numbering_of_three_million_rows(spark, tmp_path):
    rows = spark.range(3_000_000).select(F.xxhash64("id").alias("timestamp"), "id", F.col("id").cast("string").alias("record_id"))
    snapshot.numbered(rows, ["timestamp", "id"], parts=16).write.parquet(f"{tmp_path}/placed")
    placed = spark.read.parquet(f"{tmp_path}/placed")
    found = placed.agg(F.count("*").alias("n"), F.count_distinct("position").alias("places"), F.min("position").alias("a"), F.max("position").alias("b")).first()
    assert tuple(found) == (3_000_000, 3_000_000, 1, 3_000_000)
    other = placed.select((F.col("position") + 1).alias("position"), F.col("timestamp").alias("before"))
    assert placed.join(other, "position").filter("before > timestamp").count() == 0
    chunks = snapshot.chunk_index(placed, 20_000)
    assert chunks.filter("n <> 20000").count() == 0 and chunks.count() == 150


def test_numbering_needs_no_single_task(spark, chat):
    plan = snapshot.numbered(chat, ["timestamp", "seq", "record_id"])
    assert [r.position for r in plan.orderBy("timestamp", "seq", "record_id").collect()] == list(range(1, 61))


def test_nested_source_and_coverage(spark, tmp_path):
    path = tmp_path / "pages.jsonl"
    path.write_text('{"chat_id":"c","id":{"server_id_str":"1","local_id":2},"create_time":5,"kind":"text"}\nbroken\n{"error":"x"}\n', "utf-8")
    good, bad = readers.read_nested(spark, str(path))
    assert [r.id.local_id for r in good.collect()] == [2] and bad.count() == 2
    assert readers.read_coverage(good, bad).first().status == "partial"
    assert readers.read_coverage(good.filter("false"), bad).first().status == "failed"
    assert readers.read_coverage(good, bad.filter("false")).first().status == "ok"
    assert readers.artifact_manifest(spark, str(tmp_path)).first().bytes == path.stat().st_size


def test_recall_info(spark):
    row = spark.createDataFrame([([47713, 47706, 47715, 47703], ["gone", "Ann", "Ann", "u_1"])], "fields array<int>, texts array<string>")
    info = row.select(normalize.recall_info(F.col("fields"), F.col("texts")).alias("i")).first().i
    assert (info.prompt, info.actor_uid, info.target_uid, info.participants) == ("gone", "u_1", None, ["Ann"])


def test_sources_fail_alone(spark):
    people = spark.createDataFrame([("u_1", "11", "Ann", "x"), ("u_2", "22", "Anna", "y")], "uid string, uin string, nick string, remark string")
    found, statuses = identity.discover_everywhere(spark.createDataFrame([("Ann",)], "query string"), {"a": people, "b": people.drop("nick")}, 5)
    assert [(r.id, r.score, r.source) for r in found.orderBy("rank").collect()] == [("u_1", 0, "a"), ("u_2", 1, "a")]
    assert {r.source: r.ok for r in statuses.collect()} == {"a": True, "b": False}


def test_small_projections(spark):
    df = spark.createDataFrame([("a", "secret", "m")], "record_id string, token string, media string")
    assert normalize.allowed_columns(df, ("record_id", "media", "absent"), media=False).columns == ["record_id"]
    assert normalize.source_facts(df.withColumn("warnings", F.array(F.lit("w"))), ("media",)).columns == ["record_id", "token"]
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(normalize.stages_for(F.lit("voice"), F.lit(0))) == ["voice"] and one(normalize.stages_for(F.lit("image"), F.lit(2))) == ["media", "ocr"]
    filled, clash = normalize.bound_scope(F.lit("c1"), F.lit(None).cast("string"))
    assert one(filled) == "c1" and one(clash) is False and one(normalize.bound_scope(F.lit("c1"), F.lit("c2"))[1]) is True
    none = F.lit(None).cast("string")
    chat = lambda kind, uid, group: one(normalize.canonical_chat_id(F.lit(kind), F.lit(uid).cast("string"), F.lit(group).cast("string"), none, F.lit("other")))
    assert chat("private", " ", "g") is None and chat("private", "u", None) == "u" and chat("group", None, "7") == "7" and chat("group", None, None) == "other"


def test_recall_candidates_equal_every_pair_where_a_second_is_hot(spark):
    """Events of one second, hot seconds, records just inside and outside the window, repeated steps."""
    import random

    rng = random.Random(5)
    cache = [("a", i, 1000 + rng.choice([0, 7, 7, 7, 63, 64, 65, 400, 900]), "t", i % 9 != 0) for i in range(300)] + [("b", 1, 5000, "t", True), ("a", 900, None, "t", True)]
    events = [("a", 1000 + i, 1000 + rng.choice([0, 7, 70, 128, 400, 464, 1300])) for i in range(80)] + [("b", 2, 4999), ("b", 3, 5000), ("b", 4, 5064), ("b", 5, 5065), ("c", 6, 5000)]
    live = [("a", i) for i in range(0, 300, 5)]
    got = observe.recall_candidates(
        spark.createDataFrame(events, "chat_id string, msg_id bigint, timestamp bigint"), spark.createDataFrame(cache, "chat_id string, msg_id bigint, timestamp bigint, text string, recoverable boolean"),
        spark.createDataFrame(live, "chat_id string, msg_id bigint"), 64,
    ).collect()
    want = []
    for chat, event, at in events:
        near = sorted((at - t, m) for c, m, t, _, ok in cache if ok and c == chat and t is not None and 0 <= at - t <= 64 and (c, m) not in live)
        want += [(chat, event, rank, m, s) for rank, (s, m) in enumerate(near[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 100


def test_recall_report_sends_nothing_that_grows_through_the_driver(spark, tmp_path, monkeypatch):
    """Tables in small files, which Spark would broadcast: every table kept on the way and the report itself are merged."""
    rows = [("c", i, 1000 + i // 2, i % 3, f"t{i}", i % 10 == 0) for i in range(200)]
    spark.createDataFrame(rows, "chat_id string, msg_id bigint, timestamp bigint, seq bigint, text string, gone boolean").write.parquet(f"{tmp_path}/messages")
    messages = spark.read.parquet(f"{tmp_path}/messages")
    cache = messages.select("chat_id", "msg_id", "timestamp", "text", (F.col("msg_id") % 4 != 0).alias("recoverable"))
    live = messages.filter("msg_id % 5 <> 0").select("chat_id", "msg_id")
    frames, kept = [], observe.kept
    monkeypatch.setattr(observe, "kept", lambda df, name: (frames.append((name, df)), kept(df, name))[1])
    report = observe.recall_report(messages, F.col("gone"), cache, live, 64)
    frames.append(("report", report))
    assert [name for name, df in frames if "Broadcast" in df._jdf.queryExecution().executedPlan().toString()] == []
    assert len(frames) == 5
    old = [(i, t) for _, i, t, *_ in rows if i % 4 and i % 5 == 0]
    want = {i: (text if i % 4 else None, [] if i % 4 else [m for _, m in sorted((at - t, m) for m, t in old if 0 <= at - t <= 64)][:5]) for _, i, at, _, text, gone in rows if gone}
    assert {r.msg_id: (r.recovered_text, [c.msg_id for c in r.candidates or []]) for r in report.collect()} == want


def test_merged_texts_are_not_broadcast(spark, tmp_path):
    """A filter on the index's text makes the full join an outer join of the index alone."""
    spark.createDataFrame([("c", i, i) for i in range(0, 40, 2)], "chat_id string, msg_id bigint, timestamp bigint").write.parquet(f"{tmp_path}/primary")
    spark.createDataFrame([("c", i, i + 5, f"t{i}") for i in range(0, 40, 5)], "chat_id string, msg_id bigint, timestamp bigint, text string").write.parquet(f"{tmp_path}/index")
    merged = combine.merge_primary_index(spark.read.parquet(f"{tmp_path}/primary"), spark.read.parquet(f"{tmp_path}/index")).filter("text IS NOT NULL")
    assert "Broadcast" not in merged._jdf.queryExecution().executedPlan().toString()
    want = [(i, i if i % 2 == 0 else i + 5, f"t{i}", i % 2 == 1) for i in range(0, 40, 5)]
    assert sorted((r.msg_id, r.timestamp, r.text, r.fts_only) for r in merged.collect()) == want
