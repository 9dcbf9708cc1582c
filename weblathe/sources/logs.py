"""Raw log files and stored resolution records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import RECORD_COLUMNS

#: What names of log files begin with, unless a site names its own.
LOG_PREFIXES = ("access_log",)
#: Fixed value: text files of records, as one file a month or as a folder a month.
RECORD_FILE = r"/(?:\d{4}-\d{2}|year_month=\d{4}-\d{2}/part-[^/]*)\.gz$"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def require(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise ValueError(f"no such directory: {path}")
    return path


def read_logs(spark: SparkSession, path: str, prefixes: Iterable[str] = LOG_PREFIXES) -> DataFrame:
    """file, line_id and value of every line of the gzip files in ``path`` whose names begin with a prefix, each file once.

    A gzip file is one task, so line_id ascends with the lines of a file.
    """
    lines = spark.read.option("pathGlobFilter", "{" + ",".join(f"{p}*.gz" for p in prefixes) + "}").text(require(spark, path))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_id"), "value")


def read_record_text(spark: SparkSession, path: str) -> DataFrame:
    """Records from tab-separated ``YYYY-MM.gz`` files or folders by month; lines without exactly seven fields are left out."""
    lines = spark.read.option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True).text(require(spark, path)).filter(F.col("_metadata.file_path").rlike(RECORD_FILE))
    fields = lines.select(F.split("value", "\t", -1).alias("f")).filter(F.size("f") == len(RECORD_COLUMNS))
    return fields.select(*(F.col("f")[k].alias(c) for k, c in enumerate(RECORD_COLUMNS)))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Stored records with their partition column year_month."""
    schema = ", ".join(f"{c} STRING" for c in (*RECORD_COLUMNS, "year_month"))
    return spark.read.schema(schema).parquet(require(spark, path))


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Partitions already stored: a listing of folder names."""
    if not exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return sorted(n.removeprefix("year_month=") for n in names if n.startswith("year_month="))


def new_months(df: DataFrame, path: str) -> DataFrame:
    """Rows of months that are not stored yet; stored months are never written again."""
    months = stored_months(df.sparkSession, path)
    return df.filter(~F.col("year_month").isin(*months)) if months else df


def write_records(df: DataFrame, path: str) -> None:
    """Append records by month, new months only."""
    new_months(df, path).select(*RECORD_COLUMNS, "year_month").write.mode("append").partitionBy("year_month").parquet(path)


def write_record_text(df: DataFrame, path: str) -> None:
    """Tab-separated records by month, gzip; a null field is written empty."""
    df.select(F.concat_ws("\t", *(F.coalesce(F.col(c), F.lit("")) for c in RECORD_COLUMNS)).alias("value"), "year_month").write.mode("overwrite").partitionBy("year_month").option("compression", "gzip").text(path)
