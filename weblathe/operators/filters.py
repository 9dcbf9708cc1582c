"""Domain filters: keep everything, or leave out listed domains and their subdomains."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import FILTERED_DOMAINS
from .suffix import SuffixRules, with_domain


@dataclass(frozen=True)
class Everything:
    name: str = "unfiltered"

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        return df


@dataclass(frozen=True)
class ListedDomains:
    """Leaves out rows whose key, or whose key's registrable domain, is listed. Hosts without a domain stay.

    The rules have no ``special`` suffix here, so special hosts go by exact match only.
    """

    listed: DataFrame
    rules: SuffixRules
    name: str = "filtered"

    @classmethod
    def build(cls, spark: SparkSession, rules: Iterable[str], files: Iterable[str] = (), domains: Iterable[str] = FILTERED_DOMAINS) -> ListedDomains:
        """``files`` are text files of domains, one a line; those that don't exist are passed over."""
        listed = spark.createDataFrame([(d,) for d in domains], "listed string")
        for path in files:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
                listed = listed.unionByName(spark.read.text(path).select(F.lower("value").alias("listed")))
        return cls(listed.distinct(), SuffixRules.build(spark, rules, special=False))

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        own = with_domain(df.select("*", F.col(key).alias("_key")).withColumnRenamed("domain", "_domain_in").withColumnRenamed("full_domain", "_full_in").withColumnRenamed("subdomains", "_sub_in"), self.rules, "_key", strip_dot=False)
        own = own.withColumnsRenamed({"domain": "_registrable", "full_domain": "_lower"}).drop("subdomains")
        own = own.withColumnsRenamed({"_domain_in": "domain", "_full_in": "full_domain", "_sub_in": "subdomains"})
        # two joins, so that a host without a domain can't match; the planner sizes the list
        own = own.join(self.listed, F.col("_lower") == F.col("listed"), "left_anti")
        own = own.join(self.listed, F.when(F.col("_registrable") != "", F.col("_registrable")) == F.col("listed"), "left_anti")
        return own.select(*df.columns)
