"""Folders for tables that a query writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="weblathe-")
    atexit.register(shutil.rmtree, folder, True)
    return folder


def _delete(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folder(spark: SparkSession) -> str:
    """A new folder that the whole cluster shares; it goes when the process ends.

    It lies below ``spark.checkpoint.dir``; where that is unset, and only in local mode, below a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    path = f"{base.rstrip('/')}/weblathe-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_file(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small text file, gzip where its name ends so. For fixed cases, not for data."""
    raw = "".join(f"{line}\n" for line in lines).encode()
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out = jvm.java.util.zip.GZIPOutputStream(out) if path.endswith(".gz") else out
    out.write(raw)
    out.close()
