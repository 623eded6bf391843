"""A training corpus from raw documents: five stages, each one operator of :mod:`talkloom.llm`.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept.  All
but the last return the columns of ``documents``; other columns of the input are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import decontaminate, packing, quality_classifier, simhash, suffix_dedup
from talkloom.llm.common import in_blocks, remainder, scan_texts, write_side_files, written
from talkloom.llm.queries import table, tokenizer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from the labels of ``sf_dir``, from
    documents whose id has a remainder other than 0, as the query op3 does.

    Null and empty texts are scored like any other, whole texts count, repeated rows and rows
    without an id are scored one by one, further columns are left behind; with no labelled text
    all scores are equal; a score equal to the threshold stays.  An empty table gives an empty result.
    """
    learn = lambda key: remainder(key, 5) != 0
    scored = quality_classifier.score_quality(docs, table(spark, sf_dir, "labels"), learn, keep=COLUMNS)
    return scored.filter("predicted = 1").select(*COLUMNS)


def rows_of(copy: DataFrame, listed: DataFrame, stay: bool, docs: DataFrame) -> DataFrame:
    """The documents of ``copy`` (made by :func:`in_blocks`) that ``listed`` (block, rid) names, or
    with ``stay`` false all others; texts are not shuffled, each block reads its own list."""
    side = write_side_files(listed, "listed")

    def make():
        state = {"block": None, "rows": set()}

        def work(kept, texts):
            import pyarrow as pa

            mask = []
            for block, rid in zip(kept[-2].to_pylist(), kept[-1].to_pylist(), strict=True):
                if block != state["block"]:
                    rows = side.read(block, ["rid"])
                    state["block"], state["rows"] = block, set(rows.column("rid").to_pylist() if rows is not None else ())
                mask.append((rid in state["rows"]) == stay)
            mask = pa.array(mask, pa.bool_())
            columns = [c.filter(mask) for c in (kept[0], pa.array(texts, pa.string()), *kept[1:4])]
            yield columns

        return work

    fields = [("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
    return scan_texts(copy, "text", ["doc_id", "lang", "source", "n_chars", "block", "rid"], make, fields)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the least id stays (of equal ids, one row; an
    empty id comes first).

    Documents link whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.
    Null, empty and blank texts are one group; a text of fewer words is one shingle; whole texts
    count, however long.  An empty table gives an empty result.
    """
    copy = in_blocks(docs, [F.col(c) for c in COLUMNS], "documents")
    keyed = copy.select(F.struct("doc_id", "rid", "block").alias("key"), "text", "block", "rid")
    found = simhash.near_copies(keyed, shingle=5, similarity=0.8)
    survivors = found.filter(F.col("key").eqNullSafe(F.col("component_id"))).select("key.block", "key.rid")
    return rows_of(copy, survivors, True, docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 250 bytes (about fifty words) that occur elsewhere are cut out of all texts, at
    every place, the first as well; so of repeated rows nothing is left but rows.

    A null text comes back empty; shorter texts stay whole; texts of any length are cut whole; no
    place of a string comes before another, so there are no ties; a character that a cut goes through is gone.  An empty table gives an empty result.
    """
    config = suffix_dedup.DedupConfig(length=250)
    cut = suffix_dedup.remove_repeats(docs, config, keep=("doc_id", "lang", "source"), as_text=True)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("bigint").alias("n_chars"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts and an empty benchmark hold none; whole texts count, however long;
    repeated rows go or stay together; one window of one item is enough, so there are no ties; an
    empty table gives an empty result.
    """
    copy = in_blocks(docs, [F.col(c) for c in COLUMNS], "documents")
    found = decontaminate.find_contamination(copy, table(spark, sf_dir, "benchmark"), keep=("block", "rid"))
    return rows_of(copy, found.filter("n_hit > 0").select("block", "rid"), False, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one row for each piece of a document.

    A null or empty text is its end token alone; longer texts are cut into pieces, all of which
    are packed; repeated rows are packed one by one; pieces of equal length take their
    places in the order of tasks.  An empty table gives an empty result.
    """
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), size=1024, end_id=2)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("benchmark", benchmark),
    ("pack", pack),
]

#: SQL can express neither the classifier nor the fingerprints; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
