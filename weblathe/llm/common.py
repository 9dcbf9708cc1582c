"""Input tables, shared-folder staging and word rules used by several operators."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: blank, tab, \n, \v, \f, \r. ``bytes.split()`` splits at exactly these.
SPACE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table through Spark, so any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="weblathe-")
    atexit.register(shutil.rmtree, folder, True)
    return folder


class Scratch:
    """Tables written to the folder that the whole cluster shares.

    A written table cuts lineage, survives lost executors and gives the planner its true size. The folder is
    ``spark.checkpoint.dir``; only where that is unset, and only in local mode, a temporary folder takes its place, one a
    process. Operators drop what no later plan reads; the tables that a returned DataFrame still reads go when the process
    ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = _local_folder()
        self.base = f"{base.rstrip('/')}/weblathe-{uuid.uuid4().hex}"
        self.names: list[str] = []
        atexit.register(self.drop, "")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        """Write ``df``, in folders by the columns ``by``, and return it as read back."""
        df.write.mode("overwrite").partitionBy(*by).parquet(self.path(name))
        self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later plan reads; an empty name stands for all of them."""
        if self.spark.sparkContext._jsc is None:
            return
        with contextlib.suppress(Py4JError, OSError):  # a gateway that is gone takes its scratch folder as it finds it
            for name in names:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.base)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop_others(self, *kept: str) -> None:
        """Delete all tables but these."""
        self.drop(*(n for n in dict.fromkeys(self.names) if n not in kept))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: Arrow counts rows, not bytes, and texts can be long."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
