"""Counts over resolution records. All but the identifier counts come from one shared rollup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import project

CUTOFF = 5


def rollup(records: DataFrame) -> DataFrame:
    """date, code, full_domain, domain, count: small next to the records, and enough for every additive metric."""
    return records.groupBy("date", "code", "full_domain", "domain").agg(F.count(F.lit(1)).alias("count"))


def by_key(base: DataFrame, key: str, grain: str) -> DataFrame:
    """key, date, count from a rollup; counts are additive, so months are sums."""
    return base.groupBy(F.col(key).alias("key"), project(F.col("date"), grain).alias("date")).agg(F.sum("count").alias("count"))


def all_counts(base: DataFrame, grain: str) -> DataFrame:
    return base.groupBy(project(F.col("date"), grain).alias("date")).agg(F.sum("count").alias("count"))


def grouped_full_domains(base: DataFrame) -> DataFrame:
    """domain, full_domain pairs, each once; records without a domain have none."""
    return base.filter("domain <> ''").select("domain", "full_domain").distinct()


def doi_counts(records: DataFrame, grain: str = "month", cutoff: int = CUTOFF) -> DataFrame:
    """key, date, count of identifiers that reach ``cutoff`` in the period."""
    counts = records.groupBy(F.col("doi").alias("key"), project(F.col("date"), grain).alias("date")).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("count") >= cutoff)


#: name: function of (records, rollup).
METRICS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "day-domain": lambda r, b: by_key(b, "domain", "day"),
    "month-domain": lambda r, b: by_key(b, "domain", "month"),
    "month-fulldomain": lambda r, b: by_key(b, "full_domain", "month"),
    "day-fulldomain": lambda r, b: by_key(b, "full_domain", "day"),
    "day-code": lambda r, b: by_key(b, "code", "day"),
    "month-code": lambda r, b: by_key(b, "code", "month"),
    "grouped-fulldomain": lambda r, b: grouped_full_domains(b),
    "month-doi": lambda r, b: doi_counts(r),
    "day-all": lambda r, b: all_counts(b, "day"),
    "month-all": lambda r, b: all_counts(b, "month"),
}
