"""Tables and files that a run needs for a while, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in local mode without one, a temporary folder of the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = getattr(spark, "_docsieve_folder", None)
        if base is None:
            base = spark._docsieve_folder = "file://" + tempfile.mkdtemp(prefix="docsieve-")
    return base.rstrip("/")


def _at(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def put(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all."""
    part = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    fs, p = _at(spark, part)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(p, _at(spark, path)[1])


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing where there is none."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, as long as the session lives."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    fs, p = _at(spark, path)
    fs.delete(p, True)


def folder(spark: SparkSession, name: str) -> str:
    """A new path; what is written there goes when the driver ends."""
    path = f"{root(spark)}/docsieve-{name}-{uuid.uuid4().hex}"

    def clean() -> None:
        try:
            remove(spark, path)
        except Exception:  # the JVM is gone already: the folder is left to its owner
            return

    atexit.register(clean)
    return path


def write(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
