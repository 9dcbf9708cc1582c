"""The four stages: logs to records, records to counts, counts to all-time tables, tables to distribution files.

Below the base folder: logs/, processed/ (records by month), aggregated/<metric>/ (counts by month), analyzed/ and
distribute/, and quarantine/ (lines that gave no record). Months already processed or aggregated are not written again;
analyses are always written anew.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, formats, lines, referrer
from ..operators import analysis, metrics
from ..operators.filters import Everything, ListedDomains
from ..operators.suffix import FALLBACK_RULES, SuffixRules, with_domain
from ..sources import chunks, logs


def annotate(parsed: DataFrame, rules: SuffixRules, compat: bool = False) -> DataFrame:
    """Every parsed line with its record, year_month and reason: why it gives no record, or null.

    Reasons: open_url (a request of another protocol, as expected), malformed, bad_date, tab.
    """
    dated = parsed.withColumn("_ts", dates.parse_date(F.col("date_raw"), check_weekday=compat))
    dated = dated.withColumn("date", dates.day(F.col("_ts"))).withColumn("year_month", F.substring("date", 1, 7))
    out = with_domain(referrer.parse_referrer(dated, compat=compat), rules, "host", strip_dot=not compat)
    tab = F.exists(F.array(*formats.RECORD_COLUMNS), lambda x: F.contains(x, F.lit("\t")))
    failed = F.col("layout").isNull()
    reason = F.when(failed & F.col("value").rlike(lines.OPEN_URL), "open_url").when(failed, "malformed").when(F.col("_ts").isNull(), "bad_date").when(tab, "tab")
    return out.select(*(c for c in ("file", "line_id", "value") if c in parsed.columns), *formats.RECORD_COLUMNS, "year_month", reason.alias("reason"))


def to_records(parsed: DataFrame, rules: SuffixRules, compat: bool = False) -> DataFrame:
    """Records and year_month from parsed lines; lines that give none go."""
    return annotate(parsed, rules, compat).filter("reason IS NULL").select(*formats.RECORD_COLUMNS, "year_month")


def _counters(stored: list[str]) -> list:
    """Aggregates over annotated lines."""
    reason = F.col("reason")
    kept = F.col("year_month").isin(*stored) & reason.isNull() if stored else F.lit(False)
    return [
        F.count(F.lit(1)).alias("total_lines"), F.coalesce(F.sum(F.length("value")), F.lit(0)).alias("total_chars"), F.count_if(reason.isin("open_url", "malformed")).alias("failed_lines"),
        F.count_if(reason == "open_url").alias("open_url_ignores"), F.count_if(reason == "bad_date").alias("bad_dates"), F.count_if(reason == "tab").alias("tab_skips"), F.count_if(kept).alias("stored_skips"),
    ]


def failures(parsed: DataFrame, rules: SuffixRules, compat: bool = False, stored: Iterable[str] = ()) -> DataFrame:
    """One row of counts over parsed lines: total_lines, total_chars, failed_lines, open_url_ignores, bad_dates, tab_skips, stored_skips."""
    return annotate(parsed, rules, compat).agg(*_counters(list(stored)))


def process(
    spark: SparkSession, base: str, rules: Iterable[str] = FALLBACK_RULES, mode: str = "sticky", compat: bool = False, prefixes: Iterable[str] = logs.LOG_PREFIXES
) -> dict[str, int]:
    """Logs to records of new months. Returns counts of lines, characters, failures, ignored requests, dates that can't be read,
    records with tabs, and records of months that are stored already.

    Lines that gave no record, but for ignored requests, are appended to quarantine/ with their reason; they are gathered by
    a second pass over the logs, which runs only where there are any.
    """
    seen, stored = Observation("lines"), logs.stored_months(spark, f"{base}/processed")
    lines_in = logs.read_logs(spark, f"{base}/logs", prefixes)
    annotated = annotate(lines.parse_lines(lines_in, mode), SuffixRules.build(spark, rules, blank=compat), compat)
    logs.write_records(annotated.observe(seen, *_counters(stored)).filter("reason IS NULL"), f"{base}/processed")
    counts = dict(seen.get)
    if counts["failed_lines"] - counts["open_url_ignores"] + counts["bad_dates"] + counts["tab_skips"]:
        bad = annotated.filter("reason IN ('malformed', 'bad_date', 'tab')")
        bad.select("file", "line_id", "value", "reason").write.mode("append").parquet(f"{base}/quarantine")
    return counts


def aggregate(spark: SparkSession, base: str, cutoff: int = metrics.CUTOFF, only: Iterable[str] = tuple(metrics.METRICS)) -> None:
    """Records to counts, each metric by month, new months only. Records are read once for all but the identifiers.

    Stored months are left out by the folders' names, before anything of them is read.
    """
    records = logs.read_records(spark, f"{base}/processed")

    def path(name: str) -> str:
        return f"{base}/aggregated/{name}"

    def store(df: DataFrame, name: str) -> None:
        df.write.mode("append").partitionBy("year_month").parquet(path(name))

    keyed = logs.new_months(records, path("rollup")).groupBy("year_month", "date", "code", "full_domain", "domain").agg(F.count(F.lit(1)).alias("count"))
    store(keyed, "rollup")
    base_counts = spark.read.schema("date STRING, code STRING, full_domain STRING, domain STRING, count BIGINT, year_month STRING").parquet(path("rollup"))
    month = F.substring("date", 1, 7).alias("year_month")
    for name in only:
        fresh = logs.new_months(base_counts, path(name))
        if name == "grouped-fulldomain":
            store(fresh.filter("domain <> ''").select("year_month", "domain", "full_domain").distinct(), name)
        elif name == "month-doi":
            store(fresh_identifiers(records, path(name), cutoff), name)
        else:
            store(metrics.METRICS[name](records, fresh).select("*", month), name)


def fresh_identifiers(records: DataFrame, path: str, cutoff: int = metrics.CUTOFF) -> DataFrame:
    """Identifier counts of the months that ``path`` doesn't hold; the folders of others are not read."""
    return metrics.doi_counts(logs.new_months(records, path), "month", cutoff).select("*", F.substring("date", 1, 7).alias("year_month"))


#: Series and tables of the analyze stage: (output, metric, kind, top n), each also filtered where ``{}`` stands.
ANALYSES = (
    ("day-code", "day-code", "codes", 0), ("month-code", "month-code", "codes", 0), ("month-{}-fulldomain", "month-fulldomain", "series", 0), ("day-{}-domain", "day-domain", "series", 0),
    ("{}-grouped-fulldomain", "grouped-fulldomain", "grouped", 0), ("fulldomain-domain", "grouped-fulldomain", "map", 0), ("month-doi", "month-doi", "series", 0),
    ("day-top-10-{}-domains", "day-domain", "top", 10), ("month-top-10-{}-domains", "month-domain", "top", 10), ("month-top-100-{}-domains", "month-domain", "top", 100),
)
#: Distribution: outputs dealt into buckets, with their hash_chars, and outputs copied.
BUCKETED = (("day-filtered-domain", 3), ("month-filtered-fulldomain", 4), ("filtered-grouped-fulldomain", 3), ("fulldomain-domain", 3), ("month-doi", 5))
COPIED = ("day-code", "month-code", "day-top-10-filtered-domains", "day-top-10-unfiltered-domains", "month-top-10-filtered-domains", "month-top-10-unfiltered-domains", "month-top-100-filtered-domains")


def _fields(name: str) -> tuple[str, tuple[str, ...]]:
    if "grouped" in name:
        return "domain", ("full_domain",)
    return ("full_domain", ("domain",)) if name == "fulldomain-domain" else ("key", ("date", "count"))


def analyses(spark: SparkSession, base: str, rules: Iterable[str] = FALLBACK_RULES, domains: Iterable[str] = formats.FILTERED_DOMAINS) -> dict[str, DataFrame]:
    """All analyses by output name. Filter lists are read from the base folder where they exist, beside ``domains``."""
    listed = ListedDomains.build(spark, rules, (f"{base}/filter-domain-names.txt", f"{base}/filter-full-domain-names.txt"), domains)
    out = {}
    for name, metric, kind, n in ANALYSES:
        counts = spark.read.parquet(logs.require(spark, f"{base}/aggregated/{metric}"))
        for flt in (Everything(), listed) if "{}" in name else (None,):
            own = name.format(flt.name) if flt else name
            if kind == "codes":
                out[own] = analysis.code_table(counts)
            elif kind == "series":
                out[own] = analysis.series(counts, flt)
            elif kind == "grouped":
                out[own] = analysis.grouped(counts, flt)
            elif kind == "map":
                out[own] = analysis.domain_map(counts)
            else:
                out[own] = analysis.top_n_table(analysis.series(counts, flt), n)
    return out


def analyze(spark: SparkSession, base: str, rules: Iterable[str] = FALLBACK_RULES, domains: Iterable[str] = formats.FILTERED_DOMAINS) -> None:
    for name, df in analyses(spark, base, rules, domains).items():
        if "Date" in df.columns:
            chunks.write_table(df, f"{base}/analyzed/{name}.csv")
        else:
            key, fields = _fields(name)
            chunks.write_chunks(df, f"{base}/analyzed/{name}.csv-chunks", key, fields)


def distribute(spark: SparkSession, base: str) -> None:
    for name, hash_chars in BUCKETED:
        rows = chunks.read_chunks(spark, logs.require(spark, f"{base}/analyzed/{name}.csv-chunks"))
        chunks.write_buckets(rows, f"{base}/distribute/{name}.csv-chunks", hash_chars, "key", ("line",))
    for name in COPIED:
        chunks.copy(spark, logs.require(spark, f"{base}/analyzed/{name}.csv"), f"{base}/distribute/{name}.csv")
