"""The query catalogue over the driver's tables.

The tables hold no resolution log, so ``surrogate`` makes one: an event gives the date and the identifier, the page that
its number points to gives the referrer, and error events have none. The queries go through the operators; the oracle
(``oracle.py``) is plain SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.formats import FILTERED_DOMAINS, RECORD_COLUMNS
from ..functions.referrer import parse_referrer
from ..operators import analysis, metrics
from ..operators.filters import ListedDomains
from ..operators.suffix import FALLBACK_RULES, SuffixRules, with_domain
from ..sources import chunks, logs, staging
from . import goldens, stages

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """A table of fewer splits than cores, dealt over the cores; a larger one stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, doi, referrer."""
    events = _spread(_read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    n = pages.count()
    joined = events.join(pages, F.pmod("event_id", F.lit(n)) == F.col("page_id"))
    referrer = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("url"))
    return joined.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.concat(F.lit("10.5555/"), F.col("user_id").cast("string")).alias("doi"), referrer.alias("referrer"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = with_domain(parse_referrer(surrogate(spark, sf_dir)), SuffixRules.build(spark, FALLBACK_RULES))
    return parsed.select("date", "doi", "code", "full_domain", "subdomains", "domain", "path")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rollup(records(spark, sf_dir))


def listed(spark: SparkSession) -> ListedDomains:
    return ListedDomains.build(spark, FALLBACK_RULES, domains=(*FILTERED_DOMAINS, "doi.org", "example.net"))


def _counts(key: str, grain: str) -> Query:
    return lambda s, d: metrics.by_key(base(s, d), key, grain)


def _top(key: str, grain: str, n: int, filtered: bool) -> Query:
    def query(s: SparkSession, d: str) -> DataFrame:
        return analysis.top_n(analysis.series(metrics.by_key(base(s, d), key, grain), listed(s) if filtered else None), n)

    return query


def top_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: top full domains by day, wide."""
    counts = staging.store(analysis.series(metrics.by_key(base(spark, sf_dir), "full_domain", "day")), f"{staging.folder(spark)}/counts")
    return analysis.top_n_table(counts, 10)


def _wide(key: str, grain: str, n: int, filtered: bool) -> Query:
    """A wide table as its CSV file has it: Date, place of the column (from 1), key and count."""

    def query(s: SparkSession, d: str) -> DataFrame:
        path = staging.folder(s)
        counts = staging.store(analysis.series(metrics.by_key(base(s, d), key, grain), listed(s) if filtered else None), f"{path}/counts")
        chunks.write_table(analysis.top_n_table(counts, n), f"{path}/table.csv")
        table = s.read.option("header", True).csv(f"{path}/table.csv")
        names = table.columns[1:]
        cells = [F.struct(F.lit(k).alias("place"), F.lit(name).alias("key"), F.col(f"`{name}`").cast("bigint").alias("count")) for k, name in enumerate(names, 1)]
        return table.select("Date", F.inline(F.array(*cells)))

    return query


def _code_table(grain: str) -> Query:
    return lambda s, d: analysis.code_table(metrics.by_key(base(s, d), "code", grain))


def _bucket(key: str, hash_chars: int) -> Query:
    def query(s: SparkSession, d: str) -> DataFrame:
        keys = records(s, d).select(F.col(key).alias("key")).distinct()
        return keys.select("key", chunks.bucket(F.col("key"), hash_chars).alias("bucket"))

    return query


def _month_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.by_key(base(spark, sf_dir), "domain", "month").filter("key <> ''")


def chunk_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly domain counts, written as chunk files and read again."""
    path = staging.folder(spark)
    chunks.write_chunks(_month_domains(spark, sf_dir), path)
    return chunks.read_counts(spark, path, ".*[.]txt")


def grouped_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full domains of each domain, written as chunk files and read again."""
    path = staging.folder(spark)
    chunks.write_chunks(analysis.grouped(metrics.grouped_full_domains(base(spark, sf_dir))), path, "domain", ("full_domain",))
    return chunks.read_chunks(spark, path).select(F.col("key").alias("domain"), F.col("line").alias("full_domain"))


def plain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts as a file of plain lines: their place in the file and their text."""
    path = staging.folder(spark)
    chunks.write_counts(metrics.all_counts(base(spark, sf_dir), "day"), path)
    lines = spark.read.text(path).coalesce(1).select(F.monotonically_increasing_id().alias("_n"), "value")
    return lines.select((F.expr("row_number() OVER (ORDER BY _n)") - 1).cast("bigint").alias("place"), "value")


def bucket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly domain counts, dealt into bucket folders and read again, with the folder that each was found in."""
    path = staging.folder(spark)
    chunks.write_buckets(_month_domains(spark, sf_dir), path, 3)
    buckets = spark.read.option("lineSep", "\n\n").text(path).select(F.regexp_extract("_metadata.file_path", "bucket=([^/]*)", 1).alias("bucket"), F.explode(chunks.parsed("value")).alias("p"))
    return buckets.select("p.key", "p.line", "bucket")


def copied_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly code table as a CSV file, copied over an older copy."""
    path = staging.folder(spark)
    chunks.write_table(_code_table("day")(spark, sf_dir), f"{path}/old.csv")
    chunks.write_table(_code_table("month")(spark, sf_dir), f"{path}/new.csv")
    chunks.copy(spark, f"{path}/old.csv", f"{path}/out.csv")
    chunks.copy(spark, f"{path}/new.csv", f"{path}/out.csv")
    table = spark.read.option("header", True).csv(f"{path}/out.csv")
    return table.select("Date", *(F.col(c).cast("bigint").alias(c) for c in table.columns[1:]))


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records of several years: dates, customers as identifiers, priorities as domains."""
    orders, none = _read(spark, sf_dir, "orders"), F.lit("")
    domain = F.concat(F.lower(F.regexp_extract("o_orderpriority", "([A-Z]+)", 1)), F.lit(".example.com"))
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    doi = F.concat(F.lit("10.5555/"), F.col("o_custkey").cast("string"))
    return orders.select(date.alias("date"), doi.alias("doi"), F.lit("H").alias("code"), domain.alias("full_domain"), none.alias("subdomains"), domain.alias("domain"), none.alias("path"), F.substring(date, 1, 7).alias("year_month"), "o_orderkey")


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by month, written twice: months of 1995 and before with even keys only, then all; stored months stay as they are."""
    path, records = staging.folder(spark), _order_records(spark, sf_dir)
    logs.write_records(records.filter("year_month < '1996-01' AND o_orderkey % 2 = 0"), path)
    logs.write_records(records, path)
    return logs.read_records(spark, path).groupBy("year_month").agg(F.count(F.lit(1)).alias("count"))


def _aggregated_twice(metric: str) -> Query:
    """The aggregate stage over even keys of 1995 and before, then over all records; months that it holds are not counted again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, records = staging.folder(spark), _order_records(spark, sf_dir)
        logs.write_records(records.filter("year_month < '1996-01' AND o_orderkey % 2 = 0"), f"{path}/processed")
        stages.aggregate(spark, path, 2, (metric,))
        records.filter("year_month < '1996-01'").select(*RECORD_COLUMNS, "year_month").write.mode("overwrite").partitionBy("year_month").parquet(f"{path}/processed")
        logs.write_records(records, f"{path}/processed")
        stages.aggregate(spark, path, 2, (metric,))
        return spark.read.parquet(f"{path}/aggregated/{metric}").drop("year_month")

    return query


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by month over several years: order dates as the log's dates, priorities as keys."""
    day = _read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderpriority").alias("key"))
    counts = day.groupBy("key", dates.project(F.col("date"), "month").alias("date")).agg(F.count(F.lit(1)).alias("count"))
    return analysis.top_n(counts, 2)


QUERIES: dict[str, Query] = {
    "referrer_parse": records,
    "rollup": base,
    "count_domain_day": _counts("domain", "day"),
    "count_domain_month": _counts("domain", "month"),
    "count_fulldomain_month": _counts("full_domain", "month"),
    "count_code_day": _counts("code", "day"),
    "count_code_month": _counts("code", "month"),
    "count_doi_month_cutoff": lambda s, d: metrics.doi_counts(records(s, d)),
    "count_doi_month_cutoff_60": lambda s, d: metrics.doi_counts(records(s, d), cutoff=60),
    "count_all_day": lambda s, d: metrics.all_counts(base(s, d), "day"),
    "count_all_month": lambda s, d: metrics.all_counts(base(s, d), "month"),
    "grouped_fulldomains": lambda s, d: metrics.grouped_full_domains(base(s, d)),
    "fulldomain_domain_map": lambda s, d: analysis.domain_map(metrics.grouped_full_domains(base(s, d))),
    "code_table_day": _code_table("day"),
    "code_table_month": _code_table("month"),
    "doi_series_month": lambda s, d: analysis.series(metrics.doi_counts(records(s, d))),
    "domain_unfiltered_day": lambda s, d: analysis.series(metrics.by_key(base(s, d), "domain", "day")),
    "domain_filtered_day": lambda s, d: analysis.series(metrics.by_key(base(s, d), "domain", "day"), listed(s)),
    "fulldomain_filtered_month": lambda s, d: analysis.series(metrics.by_key(base(s, d), "full_domain", "month"), listed(s)),
    "grouped_fulldomain_filtered": lambda s, d: analysis.grouped(metrics.grouped_full_domains(base(s, d)), listed(s)),
    "topn_domain_day_long": _top("domain", "day", 2, False),
    "topn_domain_day_long_filtered": _top("domain", "day", 2, True),
    "topn_fulldomain_month_long": _top("full_domain", "month", 10, False),
    "topn_fulldomain_month_long_filtered": _top("full_domain", "month", 10, True),
    "chunk_bucket_domain": _bucket("domain", 3),
    "chunk_bucket_fulldomain": _bucket("full_domain", 4),
    "chunk_bucket_doi": _bucket("doi", 5),
    "chunk_roundtrip": chunk_roundtrip,
    "chunk_roundtrip_grouped": grouped_chunks,
    "chunk_pattern": goldens.chunk_pattern,
    "plain_counts_file": plain_counts,
    "bucket_files": bucket_files,
    "copied_table": copied_table,
    "fulldomain_unfiltered_month": lambda s, d: analysis.series(metrics.by_key(base(s, d), "full_domain", "month")),
    "grouped_fulldomain_unfiltered": lambda s, d: analysis.grouped(metrics.grouped_full_domains(base(s, d))),
    "wide_topn_domain_day_10": _wide("domain", "day", 10, False),
    "wide_topn_domain_month_10_filtered": _wide("domain", "month", 10, True),
    "wide_topn_domain_month_100": _wide("domain", "month", 100, False),
    "wide_topn_fulldomain_day_3": _wide("full_domain", "day", 3, False),
    "topn_domain_month_100_long": _top("domain", "month", 100, False),
    "log_files": goldens.log_files,
    "process_counters": goldens.process_counters,
    "process_records": goldens.process_records,
    "quarantined_lines": goldens.quarantined_lines,
    "record_text_roundtrip": goldens.record_text_roundtrip,
    "suffix_list_file": goldens.suffix_list_file,
    "aggregate_incremental_all": _aggregated_twice("month-all"),
    "aggregate_incremental_doi": _aggregated_twice("month-doi"),
    "log_parse_sticky": goldens.log_parse,
    "log_parse_per_line": goldens.log_parse_per_line,
    "openurl_failure_metrics": goldens.failure_metrics,
    "date_formats": goldens.date_formats,
    "referrer_goldens": goldens.referrers,
    "referrer_goldens_compat": goldens.referrers_compat,
    "suffix_goldens": goldens.suffixes,
    "incremental_no_overwrite": incremental,
    "order_months_topn": order_months,
}
