"""Shared folder, materialised tables and table reads of the llm operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables may have 0 rows and columns that clash with an operator's own; operators select what they need by name.
TABLES = "documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master, as in tests, may go without."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='folioforge-')}"
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_dir(spark)}/folioforge/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone
        pass


def materialize(df: DataFrame, label: str, instead: DataFrame | None = None) -> DataFrame:
    """df written to the shared folder and read back: later steps don't recompute it when an executor is lost.

    The files of a table that it takes the place of, made here before, are deleted.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    if instead is not None:
        _remove(df.sparkSession, instead._written)
    return out
