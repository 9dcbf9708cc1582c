"""Keyed chunk files: a key's line, its data lines, an empty line. And wide tables, plain counts, buckets and copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: A key of more lines than HOT is written as several chunks, by the first WIDTH characters of its lines.
HOT, WIDTH = 100_000, 7


def chunk_lines(df: DataFrame, key: str, *fields: str) -> DataFrame:
    """key, piece, place and value: the lines of chunk files, to be written in this order.

    A chunk is its key's line (place 0), its data lines (1) and an empty line (2). No chunk is held in memory: a hot key has
    one chunk a piece, and pieces follow each other as its lines do. Empty keys can't be told from a chunk's end: they raise.
    """
    key_ok = F.when(F.coalesce(F.col(key), F.lit("")) == "", F.raise_error(F.lit("a chunk needs a key"))).otherwise(F.col(key))
    lines = df.select(key_ok.alias("key"), F.concat_ws(",", *fields).alias("value"))
    hot = lines.groupBy(F.col("key").alias("_hot")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("_hot")
    lines = lines.join(hot, F.col("key") == F.col("_hot"), "left")
    lines = lines.select("key", F.when(F.col("_hot").isNull(), F.lit("")).otherwise(F.substring("value", 1, WIDTH)).alias("piece"), "value")
    ends = lines.select("key", "piece").distinct().select("key", "piece", F.explode(F.array(F.lit(0), F.lit(2))).alias("place"))
    ends = ends.withColumn("value", F.when(F.col("place") == 0, F.col("key")).otherwise(F.lit("")))
    data = lines.filter("value <> ''").select("key", "piece", F.lit(1).alias("place"), "value")
    return ends.unionByName(data)


def write_chunks(df: DataFrame, path: str, key: str = "key", fields: tuple[str, ...] = ("date", "count")) -> None:
    """Chunks sorted by key, then line, over all files."""
    rows = chunk_lines(df, key, *fields).repartitionByRange("key", "piece").sortWithinPartitions("key", "piece", "place", "value")
    rows.select("value").write.mode("overwrite").text(path)


def read_chunks(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """key and line of every data line; ``pattern`` is a regex that file names must match as a whole."""
    raw = spark.read.option("lineSep", "\n\n").text(path)
    if pattern:
        raw = raw.filter(F.regexp_extract("_metadata.file_path", "([^/]*)$", 1).rlike(f"^(?:{pattern})$"))
    return raw.select(F.explode(parsed("value")).alias("p")).select("p.key", "p.line")


def parsed(chunk: Column | str) -> Column:
    """The key and line of every data line of a chunk's text, as an array; none where it has no data line."""
    parts = F.filter(F.split(chunk, "\n"), lambda x: x != "")
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.struct(F.get(parts, F.lit(0)).alias("key"), x.alias("line")))


def read_counts(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """key, date, count from chunks of ``date,count`` lines."""
    fields = F.split("line", ",")
    return read_chunks(spark, path, pattern).select("key", fields[0].alias("date"), fields[1].cast("bigint").alias("count"))


def write_counts(df: DataFrame, path: str) -> None:
    """Plain ``date,count`` lines by date."""
    df.orderBy("date").select("date", "count").write.mode("overwrite").option("header", False).csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """A wide table as one CSV file with its header; such tables have one row a period."""
    df.coalesce(1).sortWithinPartitions("Date").write.mode("overwrite").option("header", True).csv(path)


def bucket(key: Column, hash_chars: int) -> Column:
    """The first ``hash_chars - 1`` upper-case hex digits of the key's MD5."""
    return F.upper(F.substring(F.md5(key), 1, hash_chars - 1))


def write_buckets(df: DataFrame, path: str, hash_chars: int, key: str = "key", fields: tuple[str, ...] = ("date", "count")) -> None:
    """Chunks in one folder a bucket."""
    rows = chunk_lines(df, key, *fields).withColumn("bucket", bucket(F.col("key"), hash_chars))
    rows.repartition("bucket").sortWithinPartitions("bucket", "key", "piece", "place", "value").select("value", "bucket").write.mode("overwrite").partitionBy("bucket").text(path)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Replace ``target`` by a copy of ``source``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    a, b = hadoop.Path(source), hadoop.Path(target)
    b.getFileSystem(conf).delete(b, True)
    hadoop.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)
