"""All-time tables from counts: series, pivots, maps and top-n tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.formats import CODES


def series(counts: DataFrame, filter_=None, repeated: bool = False) -> DataFrame:
    """key, date, count of all periods; empty keys have no series. ``repeated``: periods may come twice, and count once."""
    kept = counts.filter("key <> ''")
    kept = (filter_.keep(kept, "key") if filter_ else kept).select("key", "date", "count")
    return kept.distinct() if repeated else kept


def grouped(pairs: DataFrame, filter_=None) -> DataFrame:
    kept = pairs.filter("domain <> ''")
    return (filter_.keep(kept, "domain") if filter_ else kept).select("domain", "full_domain").distinct()


def domain_map(pairs: DataFrame) -> DataFrame:
    """full_domain, domain: one domain for each full domain, the last in order where there are several."""
    return pairs.filter("domain <> ''").groupBy("full_domain").agg(F.max("domain").alias("domain"))


def code_table(counts: DataFrame) -> DataFrame:
    """Date and one column for each code, 0 where it has no count, by date."""
    wide = counts.groupBy(F.col("date").alias("Date")).pivot("key", list(CODES)).agg(F.sum("count"))
    return wide.na.fill(0).orderBy("Date")


def top_names(counts: DataFrame, n: int) -> DataFrame:
    """key, total of all names that are among the n largest of any date; ties go by name."""
    ranked = counts.withColumn("_r", F.expr("row_number() OVER (PARTITION BY date ORDER BY count DESC, key)"))
    names = ranked.filter(F.col("_r") <= n).select("key").distinct()
    return counts.join(names, "key", "left_semi").groupBy("key").agg(F.sum("count").alias("total"))


def top_n(counts: DataFrame, n: int) -> DataFrame:
    """date, key, count for every date and every top name, 0 where it has none. Nothing runs before the result is read."""
    kept = counts.join(top_names(counts, n).select("key"), "key", "left_semi")
    by_key = kept.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("date", "count"))).alias("_counts"))
    # one row: the dates, of which a table has few
    dates = counts.select("date").distinct().agg(F.collect_list("date").alias("_dates"))
    cells = by_key.join(F.broadcast(dates)).select("key", "_counts", F.explode("_dates").alias("date"))
    return cells.select("date", "key", F.coalesce(F.col("_counts")[F.col("date")], F.lit(0)).cast("bigint").alias("count"))


def top_n_table(counts: DataFrame, n: int) -> DataFrame:
    """Date and one column for each top name, by descending total then name.

    The names are the table's header, so finding them is a job of its own; ``counts`` should be a stored table.
    """
    names = [r["key"] for r in top_names(counts, n).orderBy(F.desc("total"), "key").collect()]
    dates = counts.select(F.col("date").alias("Date")).distinct()
    if not names:
        return dates.orderBy("Date")
    led = counts.join(top_names(counts, n).select("key"), "key", "left_semi")
    wide = led.groupBy(F.col("date").alias("Date")).pivot("key", names).agg(F.sum("count"))
    return dates.join(wide, "Date", "left").na.fill(0).orderBy("Date")
