"""Media references, content jobs, payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.catalog.base import Registry
from talkloom.functions import media as on
from talkloom.functions import texts, times
from talkloom.operators import media, payload
from talkloom.sources import readers

query = Registry()

FILES = """files AS (SELECT lower(to_hex(doc_id % 60)) || CASE WHEN doc_id % 2 = 0 THEN repeat('a', 20) ELSE 'x' END || '.png' AS name, '2024-0' || (doc_id % 3 + 1) AS month,
  CASE doc_id % 4 WHEN 0 THEN 'Ori' WHEN 1 THEN 'OriTemp' WHEN 2 THEN 'Thumb' ELSE 'ThumbTemp' END AS family, CASE WHEN doc_id % 5 = 0 THEN sha256(text) ELSE 'same' || (doc_id % 60) END AS sha256, doc_id % 9 <> 0 AS readable FROM documents),
hints AS (SELECT event_id AS msg_id, '2024-0' || (event_id % 3 + 1) AS month, o AS occurrence, lower(to_hex((event_id + o) % 80)) || CASE WHEN (event_id + o) % 2 = 0 THEN repeat('a', 20) ELSE 'x' END || '.png' AS hint
  FROM events, (SELECT unnest([0, 1, 2]) AS o))"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = readers.table(spark, sf_dir, "documents"), F.col("doc_id")
    name = F.concat(F.lower(F.hex(n % 60)), F.when(n % 2 == 0, "a" * 20).otherwise("x"), F.lit(".png"))
    family = F.when(n % 4 == 0, "Ori").when(n % 4 == 1, "OriTemp").when(n % 4 == 2, "Thumb").otherwise("ThumbTemp")
    sha = F.when(n % 5 == 0, F.sha2("text", 256)).otherwise(F.concat(F.lit("same"), n % 60))
    return d.select(name.alias("name"), F.concat(F.lit("2024-0"), n % 3 + 1).alias("month"), family.alias("family"), sha.alias("sha256"), (n % 9 != 0).alias("readable"))


def _hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = readers.table(spark, sf_dir, "events"), F.col("event_id")
    one = lambda o: F.concat(F.lower(F.hex((n + o) % 80)), F.when((n + o) % 2 == 0, "a" * 20).otherwise("x"), F.lit(".png"))
    return e.select(n.alias("msg_id"), F.concat(F.lit("2024-0"), n % 3 + 1).alias("month"), F.array(one(0), one(1), one(2)).alias("hints"))


RESOLVED = f"""WITH {FILES}, hit AS (SELECT h.*, CASE f.family WHEN 'Ori' THEN 1 WHEN 'OriTemp' THEN 2 WHEN 'Thumb' THEN 3 ELSE 4 END AS place, f.sha256, f.readable FROM hints h JOIN files f ON f.name = h.hint
   AND (regexp_matches(h.hint, '^[a-f0-9]{{16,64}}\\.png$') OR f.month = h.month)),
 fam AS (SELECT msg_id, occurrence, place, count(*) AS files, count(DISTINCT CASE WHEN readable THEN sha256 END) AS contents, min(CASE WHEN readable THEN sha256 END) AS sha FROM hit GROUP BY ALL),
 best AS (SELECT msg_id, occurrence, sum(files)::BIGINT AS matched, min(CASE WHEN contents > 0 THEN place END) AS place FROM fam GROUP BY ALL)
SELECT h.msg_id, h.occurrence, h.hint, CASE WHEN b.matched IS NULL THEN 'not_found' WHEN b.place IS NULL THEN 'unreadable' WHEN f.contents > 1 THEN 'ambiguous_cache_files' ELSE 'available' END AS status,
 CASE WHEN f.contents = 1 THEN f.sha END AS sha256, CASE WHEN f.contents = 1 THEN CASE WHEN b.place >= 3 THEN 'thumbnail' ELSE 'original' END END AS variant, coalesce(b.matched, 0) AS matched_files
FROM hints h LEFT JOIN best b USING (msg_id, occurrence) LEFT JOIN fam f ON f.msg_id = h.msg_id AND f.occurrence = h.occurrence AND f.place = b.place"""


@query(RESOLVED)
def resolve_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.resolve_images(_hints(spark, sf_dir), _files(spark, sf_dir))


@query(f"SELECT msg_id, count(*) AS hints, count(*) FILTER (WHERE status = 'available') AS available, CASE WHEN count(*) FILTER (WHERE status = 'available') = 3 THEN 'ok' WHEN count(*) FILTER (WHERE status = 'available') > 0 THEN 'partial' ELSE 'unavailable' END AS status FROM ({RESOLVED}) GROUP BY msg_id")
def image_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.resolution_status(media.resolve_images(_hints(spark, sf_dir), _files(spark, sf_dir)))


@query("""SELECT msg_id, variant_group, media_ref FROM (SELECT o_custkey AS msg_id, o_orderkey % 3 AS variant_group, o_orderkey AS media_ref, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 3
  ORDER BY o_orderkey % 2 = 0 DESC, (o_orderkey % 50) * (o_orderkey % 40) DESC, o_orderkey % 5 <> 0 DESC, o_orderkey) AS r FROM orders) WHERE r = 1""")
def best_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = readers.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("msg_id"), (k % 3).alias("variant_group"), k.alias("media_ref"), F.when(k % 2 == 0, "p").alias("path"), (k % 50).alias("width"), (k % 40).alias("height"),
        F.when(k % 5 == 0, "thumb").otherwise("original").alias("variant"),
    )
    return media.best_variants(rows).select("msg_id", "variant_group", "media_ref")


@query("SELECT c_custkey::VARCHAR AS hint, c_custkey || '_720.jpg' AS name, 2::BIGINT AS rank FROM customer UNION ALL SELECT c_custkey::VARCHAR, c_custkey || '.JPG', 1 FROM customer")
def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = readers.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("hint"))
    files = c.select(F.concat("hint", F.lit(".JPG")).alias("name"), F.lit(1).alias("bytes")).unionByName(c.select(F.concat("hint", F.lit("_720.jpg")).alias("name"), F.lit(9).alias("bytes")))
    return media.match_name_variants(c, files).select("hint", "name", F.col("rank").cast("bigint").alias("rank"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN 'not_found' WHEN o_orderkey % 4 = 2 THEN 'identity_ambiguous' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 4 IN (0, 3) THEN 'd' || o_orderkey END AS digest FROM orders""")
def match_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = readers.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("o"), F.col("o_custkey") % 10).alias("chat_id"), F.when(k % 3 == 0, k).alias("server_id"), k.alias("local_id"), times.epoch_of("o_orderdate").alias("timestamp"))
    found = rows.filter("o_orderkey % 4 <> 1").withColumn("digest", F.explode(F.when(k % 4 == 2, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.concat(F.lit("d"), k))))).drop("o_orderkey")
    return media.match_resources(rows, found).select("o_orderkey", "status", "digest")


@query("""SELECT DISTINCT user_id::VARCHAR AS audio_sha256, CASE WHEN user_id % 3 = 2 THEN NULL WHEN user_id % 3 = 0 THEN 'beam5' ELSE 'beam1' END AS engine, user_id % 3 <> 2 AS cached FROM events""")
def reuse_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    audio = readers.table(spark, sf_dir, "events").select("user_id", F.col("user_id").cast("string").alias("audio_sha256"), F.lit("r1").alias("model_rev"))
    engines = F.when(F.col("user_id") % 3 == 0, F.array(*map(F.lit, ("ctc", "beam5", "beam1")))).when(F.col("user_id") % 3 == 1, F.array(F.lit("ctc"), F.lit("beam1")))
    stored = audio.distinct().select("audio_sha256", "model_rev", F.explode(engines).alias("engine"), F.lit("ok").alias("status"), F.lit("t").alias("text"))
    return media.reuse_transcripts(audio.drop("user_id"), stored).select("audio_sha256", "engine", "cached")


@query("SELECT sha256(text) AS sha256, min(doc_id) AS first_request, count(*) AS requests FROM documents GROUP BY ALL")
def content_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = readers.table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"), F.col("doc_id").alias("request_id"))
    return media.jobs(d, "sha256")


@query("SELECT DISTINCT sha256(text) AS sha256, strlen(text) AS bytes FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL)")
def by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One engine call for each content not known yet; the engine here measures its bytes."""
    d = readers.table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"), "text", "doc_id")
    cache = d.filter("doc_id % 3 = 0").select("sha256", F.lit("ok").alias("status"))

    def engine(batches):
        for rows in batches:
            yield rows.assign(bytes=[len(t.encode()) for t in rows["text"]])[["sha256", "bytes"]]

    return media.by_content(d.drop("doc_id"), cache, engine, "sha256 string, bytes bigint")


@query("""SELECT page_id, array_to_string(list_slice(list_sort(list_distinct(regexp_extract_all(html, '((?:https?://|/download\\?)[^\\t\\n\\x0b\\f\\r \\x22\\x27<>]+)', 1))), 1, 6), ' ') AS urls FROM pages""")
def url_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.table(spark, sf_dir, "pages").select("page_id", F.array_join(texts.urls(F.col("html")), " ").alias("urls"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'local' ELSE 'remote' END AS kind FROM pages")
def path_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/data/"), "page_id")).when(F.col("page_id") % 3 == 1, F.col("url")).otherwise(r"\\host\share")
    return readers.table(spark, sf_dir, "pages").select("page_id", texts.path_kind(path).alias("kind"))


@query("""WITH s AS (SELECT p_partkey, (p_partkey % 900 + 1) AS w, (p_size * 37 + 1) AS h FROM part),
 x AS (SELECT p_partkey, w, h, unnest(range(0, CASE WHEN w > 300 THEN ((w - 300 + 259) // 260) ELSE 0 END + 1)) * 260 AS x0 FROM s),
 b AS (SELECT *, unnest(range(0, CASE WHEN h > 300 THEN ((h - 300 + 259) // 260) ELSE 0 END + 1)) * 260 AS y0 FROM x)
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY y0, x0) - 1 AS index, x0, y0, least(w, x0 + 300) AS x1, least(h, y0 + 300) AS y1 FROM b""")
def tile_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = readers.table(spark, sf_dir, "part")
    boxes = on.tile_boxes((F.col("p_partkey") % 900 + 1).cast("int"), F.col("p_size") * 37 + 1, 300, 40)
    found = p.select("p_partkey", F.explode(boxes).alias("b")).select("p_partkey", "b.*")
    return found.select("p_partkey", *[F.col(c).cast("bigint").alias(c) for c in ("index", "x0", "y0", "x1", "y1")])


@query("""WITH hit AS (SELECT d.doc_id AS ref_id, 'p' || f.doc_id AS path, f.n_chars AS bytes, 0 AS how FROM documents d JOIN documents f ON f.doc_id % 2 = 0 AND md5(f.text) = md5(d.text)
  UNION SELECT d.doc_id, 'p' || l.doc_id, l.n_chars, 1 FROM documents d JOIN documents l ON l.doc_id % 100 = 50 AND l.doc_id // 100 = d.doc_id // 10)
SELECT ref_id, path, CASE how WHEN 0 THEN 'content' ELSE 'resource' END AS evidence FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY how, bytes DESC, path) AS r FROM hit) WHERE r = 1""")
def match_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = readers.table(spark, sf_dir, "documents"), F.col("doc_id")
    path = F.concat(F.lit("p"), "doc_id").alias("path")
    wanted = d.select(n.alias("ref_id"), F.md5("text").alias("md5"), F.floor(n / 10).alias("resource_id"))
    files = d.filter("doc_id % 2 = 0").select(F.md5("text").alias("md5"), path, F.col("n_chars").alias("bytes"))
    return media.match_digests(wanted, files, d.filter("doc_id % 100 = 50").select(F.floor(n / 100).alias("resource_id"), path))


@query("""WITH f AS (SELECT doc_id % 100 AS r, '2024-0' || (doc_id % 7 // 2 + 1) AS month, 'p' || doc_id AS path, doc_id % 3 = 0 AS cover FROM documents),
 m AS (SELECT r, month, min(path) FILTER (NOT cover) AS video, min(path) FILTER (cover) AS cover FROM f GROUP BY ALL),
 a AS (SELECT r, arg_max(video, month) FILTER (video IS NOT NULL) AS video, arg_max(cover, month) FILTER (cover IS NOT NULL) AS cover FROM m GROUP BY r)
SELECT event_id AS ref_id, coalesce(m.video, a.video) AS video, coalesce(m.cover, a.cover) AS cover FROM events JOIN a ON a.r = user_id % 100 LEFT JOIN m ON m.r = a.r AND m.month = '2024-0' || (event_id % 3 + 1)""")
def match_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    files = readers.table(spark, sf_dir, "documents").select((n % 100).alias("resource_id"), F.concat(F.lit("2024-0"), F.floor(n % 7 / 2) + 1).alias("month"), F.concat(F.lit("p"), "doc_id").alias("path"), (n % 3 == 0).alias("is_cover"))
    wanted = readers.table(spark, sf_dir, "events").select(F.col("event_id").alias("ref_id"), (F.col("user_id") % 100).alias("resource_id"), F.concat(F.lit("2024-0"), F.col("event_id") % 3 + 1).alias("month"))
    return media.match_videos(wanted, files)


@query("""SELECT event_id AS msg_ref, CASE WHEN event_id % 4 = 0 THEN 'not_found' WHEN event_id % 10 = 1 THEN 'ambiguous' ELSE 'ok' END AS status,
  CASE WHEN event_id % 4 <> 0 AND event_id % 10 <> 1 THEN sha256(props) END AS sha256 FROM events""")
def match_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, n = readers.table(spark, sf_dir, "events"), F.col("event_id")
    chat, seconds = F.concat(F.lit("c"), F.col("user_id") % 10), times.epoch_of("ts")
    name = lambda more, ending: F.concat_ws("_", F.md5(chat), n, seconds, F.concat(n, F.lit(more + ending)))
    files = e.filter("event_id % 4 <> 0").select(name("", ".wav").alias("name"), F.sha2("props", 256).alias("sha256"))
    again = e.filter("event_id % 4 <> 0").select(name("_acc", ".silk").alias("name"), F.sha2(F.concat("props", F.when(n % 10 == 1, "x").otherwise("")), 256).alias("sha256"))
    rows = e.select(n.alias("msg_ref"), chat.alias("chat_id"), n.alias("server_id"), n.alias("local_id"), seconds.alias("timestamp"))
    return media.match_audio(rows, files.unionByName(again))


@query("""SELECT event_id AS msg_ref,
  CASE WHEN k < 2 OR k IN (4, 5) THEN 'ok' WHEN k = 2 THEN 'ambiguous' WHEN k = 6 THEN 'identity_unavailable' ELSE 'not_found' END AS status,
  CASE k WHEN 0 THEN '/m/' || event_id || '.wav' WHEN 1 THEN '/m/' || event_id || '.flac' WHEN 4 THEN cache WHEN 5 THEN cache END AS path,
  CASE k WHEN 0 THEN sha256(props) WHEN 1 THEN sha256(props || 'f') WHEN 4 THEN sha256(props || 'c') WHEN 5 THEN sha256(props || 'c') END AS sha256,
  CASE WHEN k < 2 OR k = 5 THEN 'message' WHEN k = 4 THEN 'cache' END AS evidence, CASE k WHEN 7 THEN 'cache_identity_mismatch' END AS reason
  FROM (SELECT *, event_id % 9 AS k, '/cache/' || md5('c' || user_id % 10) || '_' || event_id || '_' || epoch_us(ts) // 1000000 || '_' || event_id || '.silk' AS cache FROM events)""")
def resolve_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By turns: a decoded file before its source; a trusted ending of the same rank; two contents; a
    remote path; the cache alone; a path into the cache; no identity; another message's file; none."""
    e, n = readers.table(spark, sf_dir, "events").withColumn("k", F.col("event_id") % 9), F.col("event_id")
    chat, seconds = F.concat(F.lit("c"), F.col("user_id") % 10), times.epoch_of("ts")
    own = lambda ending: F.concat(F.lit("/m/"), n, F.lit(ending))
    cache = lambda shift: F.concat(F.lit("/cache/"), F.md5(chat), F.lit("_"), n, F.lit("_"), seconds + shift, F.lit("_"), n, F.lit(".silk"))
    has = lambda *ks: F.col("k").isin(*ks)
    entry = lambda path, rank, mark: F.struct(path.alias("path"), F.lit(rank).cast("int").alias("rank"), F.sha2(F.concat("props", F.lit(mark)), 256).alias("sha256"))
    listed = F.array(
        entry(F.when(has(0), own(".wav")), 0, ""), entry(F.when(has(0), own(".silk")), 1, "s"), entry(F.when(has(1), own(".mp3")), 1, "m"), entry(F.when(has(1), own(".flac")), 1, "f"),
        entry(F.when(has(2), own("a.wav")), 0, "a"), entry(F.when(has(2), own("b.wav")), 0, "b"), entry(F.when(has(3), F.concat(F.lit("https://x/"), n, F.lit(".wav"))), 0, "r"),
        entry(F.when(has(4), cache(0)), None, "c"), entry(F.when(has(5), cache(0)), 2, "c"), entry(F.when(has(7), cache(1)), 0, "o"),
    )
    every = e.select(n.alias("msg_ref"), F.explode(listed).alias("x")).select("msg_ref", "x.*").filter("path IS NOT NULL")
    rows = e.select(n.alias("msg_ref"), chat.alias("chat_id"), F.when(F.col("k") != 6, n).alias("server_id"), n.alias("local_id"), seconds.alias("timestamp"))
    return media.resolve_audio(rows, every.filter("rank IS NOT NULL").select("msg_ref", "path", "rank"), every.select("path", "sha256"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(make_timestamp((s + 28800) * 1000000), '%Y-%m') ELSE strftime(make_timestamp((s + 28800) * 1000000), '%Y-%m') END AS month FROM (SELECT event_id, epoch_us(ts) // 1000000 AS s FROM events)")
def message_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = times.epoch_of("ts")
    given = F.when(F.col("event_id") % 2 == 0, seconds * 1000).otherwise(seconds)
    return readers.table(spark, sf_dir, "events").select("event_id", times.message_month(given).alias("month"))


@query("SELECT event_id, concat_ws(',', CASE WHEN value / 20 > 1.6 THEN 'low_confidence' END, CASE WHEN user_id % 4 = 3 THEN 'probable_silence' END, CASE WHEN event_id % 5 = 0 THEN 'level_mismatch' END) AS reasons FROM events")
def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = readers.table(spark, sf_dir, "events")
    segment = F.struct((F.col("value") / -40).alias("avg_logprob"), F.when(F.col("user_id") % 4 == 3, 0.9).otherwise(0.1).alias("no_speech_prob"))
    reasons = on.review_reasons(F.array(segment, segment), F.lit("spoken words"), F.lit(10.0), F.when(F.col("event_id") % 5 == 0, 0.0005).otherwise(0.2))
    return e.select("event_id", F.array_join(reasons, ",").alias("reasons"))


def _varint(n: Column) -> Column:
    """A length as a number of one to five bytes, seven bits in each, the least first."""
    n = n.cast("bigint")
    digits = [F.shiftright(n, 7 * i) for i in range(6)]
    pairs = [F.lpad(F.hex(a % 128 + F.when(b > 0, 128).otherwise(0)), 2, "0") for a, b in zip(digits, digits[1:], strict=False)]
    return F.unhex(F.concat_ws("", pairs[0], *[F.when(a > 0, p) for a, p in zip(digits[1:], pairs[1:], strict=False)]))


@query("SELECT conv_id, turn, coalesce(text, '') AS text, CASE WHEN text = '' THEN 1 ELSE 0 END AS unknown, false AS malformed, false AS truncated FROM conversations")
def decode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts wrapped as field 45101 in field 1, and walked again."""
    field = F.unhex(F.lit("EA8216"))  # tag of field 45101, length-delimited
    d = readers.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.encode("text", "utf-8").alias("t"))
    inner = d.withColumn("i", F.concat(field, _varint(F.length("t")), "t"))
    wrapped = inner.select("conv_id", "turn", F.concat(F.unhex(F.lit("0A")), _varint(F.length("i")), "i").alias("payload"))
    found = payload.decode_payloads(wrapped)
    return found.select("conv_id", "turn", F.array_join("texts", "|").alias("text"), "unknown", "malformed", "truncated")


QUERIES, ORACLE_SQL = query.queries, query.sql
