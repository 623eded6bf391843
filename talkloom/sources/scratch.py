"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where none is named, a session that runs in one process (tests) gets a temporary one; a
    cluster must name its own (ValueError), since its machines do not share theirs.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="talkloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written there and read back: computed once, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/talkloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
