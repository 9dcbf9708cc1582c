"""The same plan over a stream of log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, lines
from ..operators.suffix import SuffixRules
from ..plans.stages import to_records


def stream_counts(spark: SparkSession, path: str, rules: SuffixRules, key: str = "domain", late: str = "1 day") -> DataFrame:
    """Daily counts of ``key`` over log files as they arrive; rows later than ``late`` are left out.

    Lines are read one by one, since a file's layout can't be known before its end.
    """
    text = spark.readStream.text(path).select(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("line_id"), "value")
    parsed = lines.parse_lines(text, "per_line").filter("layout IS NOT NULL")
    records = to_records(parsed, rules)
    timed = records.withColumn("ts", F.to_timestamp("date", "yyyy-MM-dd")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", "1 day"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("count")).select("key", dates.day(F.col("window.start")).alias("date"), "count")
