import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


#: Nulls, empty and blank texts, ties, repeated rows, a long text.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two words"), (5, "Two words"), (6, "ÄÖ ß é ñ 漢字"),
    (7, "a b c d e f g h i j k l m n o p " * 400), (None, "no id here at all"), (9, "x" * 3000), (10, "###!!! 123 %%%"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Columns whose names clash with those the operators make."""
    rows = [(i, t, None, None, 1, "word", 2) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n int, word string, score int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def data():
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    return folder
