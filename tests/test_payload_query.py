from talkloom.catalog import QUERIES


def test_decode_payloads_whole_texts(spark, tmp_path):
    texts = [unit * n for unit in ("x", "é") for n in (1, 60, 99, 101, 126, 127, 128, 5_000, 16_380, 16_384, 2_100_000)]
    rows = [(1, i, "user", t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = QUERIES["decode_payloads"](spark, str(tmp_path)).collect()
    assert {r.turn: r.text for r in found} == dict(enumerate(texts))
    assert not any(r.malformed or r.truncated for r in found)
