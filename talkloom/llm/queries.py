"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import chat, decontaminate, language_id, language_model, lexical_search, packing, quality_classifier, quality_rules, simhash, spelling, suffix_dedup, tokens, toxicity
from talkloom.llm.common import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = remainder(F.col("doc_id"), 5) != 1
    scored = language_model.score_texts(table(spark, sf_dir, "documents"), learn)
    return scored.select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), suffix_dedup.DedupConfig(length=400))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS g FROM d, unnest(range(0, length(h) // 2 - 399)) AS t(i)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
isle AS (SELECT r, i, sum(f) OVER (PARTITION BY r ORDER BY i) AS k FROM (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS f FROM rep)),
span AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM isle GROUP BY r, k),
cut AS (SELECT r, a, b FROM span UNION ALL SELECT r, length(h) // 2, NULL FROM d),
piece AS (SELECT r, a, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a, b NULLS LAST), 0) AS s FROM cut),
kept AS (SELECT r, string_agg(substr(h, 2 * s + 1, 2 * (a - s)), '' ORDER BY a, s) AS k FROM piece JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, (length(h) - length(k)) // 2 AS n_removed, (SELECT count(*) FROM span WHERE span.r = d.r) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (r)
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_classifier.score_quality(docs, labels, lambda key: remainder(key, 5) != 0)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify_languages(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 3) != 1)
    return found.select("doc_id", (~F.col("learn")).alias("held_out"), "lang_pred", "score")


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = tokens.write_records(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    read = tokens.read_records(index)
    digest = F.crc32("ids")
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), digest.alias("ids_crc32"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
WITH item AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g, len(list_slice(w, i, i + 9)) AS k
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT r, i, k, list_slice(w, i, i + k - 1) AS g
  FROM doc, (SELECT DISTINCT k FROM win) AS ks, unnest(range(1, len(w) - k + 2)) AS t(i)),
hit AS (SELECT r, i, grams.k, item_id FROM grams JOIN win USING (g)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) AS t(p) GROUP BY r),
items AS (SELECT r, string_agg(id, ',' ORDER BY id) AS ids, count(*) AS n FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, labels, lambda key: remainder(key, 3) != 1)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted", "evidence_ids")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_host_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP8_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (SELECT r, i, list_slice(w, i, i + 2) AS g FROM doc, unnest(range(1, len(w) - 1)) AS t(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 3)) AS t(k) GROUP BY r),
c AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM doc LEFT JOIN rep USING (r)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, (n_words < 50)::INT AS f1, (100 * n_repeat_words > 50 * n_words)::INT AS f2,
         (100 * n_symbols > 10 * n_words)::INT AS f3, (100 * n_dup_lines > 30 * n_lines)::INT AS f4, (word_chars < 3 * n_words OR word_chars > 12 * n_words)::INT AS f5
  FROM c),
long AS (SELECT host, unnest([f1, f2, f3, f4, f5]) AS v, unnest([1, 2, 3, 4, 5]) AS k FROM f),
hosts AS (SELECT host, k, sum(v) AS bad, count(*) AS n, sum(v) / count(*) AS rate FROM long GROUP BY ALL),
moments AS (SELECT k, avg(rate) AS m, var_pop(rate) AS v FROM hosts GROUP BY k),
prior AS (SELECT k, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) ELSE 1000.0 END AS s FROM moments),
verdict AS (SELECT host, bool_and((bad + m * s) / (n + s) <= 0.5) AS ok FROM hosts JOIN prior USING (k) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept FROM f JOIN verdict USING (host)
"""


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), size=1024, end_id=2)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("item_id", "rank", "doc_id", "score")


OP11_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
item AS (
  SELECT row_number() OVER () AS q, item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
total AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM doc WHERE len(w) > 0),
posting AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting, total GROUP BY term, docs),
asked AS (SELECT q, term, count(*) AS k FROM (SELECT q, unnest(w) AS term FROM item) GROUP BY ALL),
scored AS (
  SELECT q, p.r, sum(k * x.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * docs) // terms))))::BIGINT AS score
  FROM asked JOIN posting p USING (term) JOIN weight x USING (term) JOIN doc d ON d.r = p.r, total GROUP BY q, p.r),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INT AS rank FROM scored JOIN doc USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (q) WHERE rank <= 20
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS tab),
run AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce(list_transform(range(octet_length(k)), lambda j: ('0x' || substr(hex(k), 2 * j + 1, 2))::BIGINT), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM (SELECT *, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS k FROM run), crc),
word AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS less FROM word, unnest(range(1, length(word) + 1)) AS t(i)),
hole AS (SELECT word, n, left(word, i - 1) || '*' || substr(word, i + 1) AS less FROM word, unnest(range(1, length(word) + 1)) AS t(i)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM hole a JOIN hole b USING (less) WHERE a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN word w ON c.less = w.word
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN word w ON c.less = w.word),
best AS (
  SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS k FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM word w LEFT JOIN best b ON b.word = w.word AND k = 1),
chain AS (
  SELECT word, word AS root, form AS up FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.up = f.word)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.up IS NULL
"""


#: Fixed value: a conversation of control strings that the contract adds to the table.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    rendered = chat.write_chats(chat.log_of_turns(turns.unionByName(added)))
    return chat.digest_chats(rendered).withColumnRenamed("conv", "conv_id")


OP13_SQL = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '{CONTROL_TEXT}'),
shown AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e') AS t,
         replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c') AS r FROM said),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss, sum(length(t) + length(r) + 14)::BIGINT AS formatted_chars
  FROM shown GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""


QUERIES = {
    "op1_class_lm": op1_class_lm,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality": op3_quality,
    "op4_language_id": op4_language_id,
    "op5_token_records": op5_token_records,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_pack": op9_pack,
    "op10_simhash": op10_simhash,
    "op11_lexical": op11_lexical,
    "op12_spelling": op12_spelling,
    "op13_chat": op13_chat,
}

ORACLE_SQL = {"op2_suffix_dedup": OP2_SQL, "op6_decontaminate": OP6_SQL, "op8_quality_rules": OP8_SQL, "op11_lexical": OP11_SQL, "op12_spelling": OP12_SQL, "op13_chat": OP13_SQL}
