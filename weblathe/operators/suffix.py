"""Registrable domains by public-suffix rules.

The rules form a trie over labels from the right. Each host label is looked up by one broadcast join a depth (the joins
share one broadcast), so facts are never shuffled for it and hosts need no distinct pass. The walk takes the literal child
before a wildcard, never turns back, and needs one label beyond the node where it stops.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.referrer import settled

#: A small rule set for use without a list of one's own.
FALLBACK_RULES = ("com", "org", "net", "edu", "gov", "int", "mil", "info", "biz", "io", "it", "ly", "de", "fr", "es", "br", "com.br", "uk", "co.uk", "ac.uk", "org.uk", "jp", "co.jp", "ac.jp", "cn", "com.cn", "au", "com.au", "ca", "nl", "eu", "ru", "in", "ch", "se", "be", "at", "pl", "pt")
#: More nodes than this are no list of public suffixes, and too many to broadcast.
MOST_NODES = 500_000


@dataclass(frozen=True)
class SuffixRules:
    """Trie nodes as rows: path, is_leaf, wild (a wildcard child exists and is a leaf, or not, or null)."""

    nodes: DataFrame
    depth: int

    @classmethod
    def build(cls, spark: SparkSession, rules: Iterable[str], special: bool = True, blank: bool = False) -> SuffixRules:
        """``special`` adds the rule of that name; ``blank`` keeps an empty rule, so that a trailing dot is a label."""
        leaves: dict[str, bool] = {}
        for rule in [*rules, *(["special"] if special else []), *([""] if blank else [])]:
            labels = rule.split(".")
            for k in range(len(labels)):
                path = ".".join(labels[k:])
                leaves[path] = leaves.get(path, False) or k == 0
            if len(leaves) > MOST_NODES:
                raise ValueError("too many suffix rules")
        rows = [(p, leaf, leaves.get(f"*.{p}")) for p, leaf in sorted(leaves.items())]
        depth = max((p.count(".") + 1 for p in leaves), default=0)
        return cls(spark.createDataFrame(rows, "path string, is_leaf boolean, wild boolean"), depth)


def read_rules(spark: SparkSession, path: str) -> list[str]:
    """Rules of a suffix list file: lines but comments. A missing file raises."""
    lines = spark.read.text(path).filter("NOT startswith(value, '//') AND value <> ''").limit(MOST_NODES + 1).collect()
    return [r["value"] for r in lines]


def with_domain(df: DataFrame, rules: SuffixRules, host: str = "host", strip_dot: bool = True, keep_suffix: bool = False) -> DataFrame:
    """Add full_domain, subdomains and domain (all lower case) of a host column; no match gives two empty strings.

    ``strip_dot`` drops one trailing dot first; ``keep_suffix`` adds suffix, the public suffix that matched, or null.
    """
    name = F.lower(F.col(host))
    if strip_dot:
        name = F.regexp_replace(name, r"(.)\.$", "$1")
    df = df.withColumn("full_domain", name).withColumn("_labels", F.split("full_domain", r"\.", -1)).withColumn("_n", F.size("_labels"))
    taken: list[str] = []
    for k in range(1, rules.depth + 1):
        key = F.when(F.col("_n") >= k, F.substring_index("full_domain", ".", -k))
        node = rules.nodes.select(F.col("path").alias(f"_p{k}"), F.struct("is_leaf", "wild").alias(f"_m{k}"))
        # MOST_NODES bounds the nodes
        df = df.join(F.broadcast(node), key == F.col(f"_p{k}"), "left").drop(f"_p{k}")
        taken.append(f"_m{k}")
    depth, stop = F.lit(0), F.lit(None).cast("struct<is_leaf: boolean, wild: boolean>")
    for k, m in enumerate(taken, 1):
        # a node's ancestors are nodes too, so the deepest match is the end of the walk
        depth, stop = F.when(F.col(m).isNotNull(), F.lit(k)).otherwise(depth), F.coalesce(F.col(m), stop)
    df = df.withColumn("_depth", depth).withColumn("_stop", stop)
    wild = (F.col("_n") > F.col("_depth")) & F.col("_stop.wild").isNotNull()
    df = df.withColumn("_k", F.when(wild, F.col("_depth") + 1).otherwise(F.col("_depth"))).withColumn("_leaf", F.when(wild, F.col("_stop.wild")).otherwise(F.col("_stop.is_leaf")))
    found = (F.col("_k") > 0) & (F.col("_k") < F.col("_n")) & F.coalesce("_leaf", F.lit(False))
    last = lambda extra: F.expr(f"array_join(slice(_labels, _n - _k + {1 - extra}, _k + {extra}), '.')")
    df = df.withColumn("domain", F.when(found, last(1)).otherwise(F.lit("")))
    sub = F.expr("left(full_domain, length(full_domain) - length(domain) - 1)")
    subdomains = F.when(found & (F.length("full_domain") > F.length("domain") + 1), sub).otherwise(F.lit(""))
    suffix = [F.when(found, last(0)).alias("suffix")] if keep_suffix else []
    df = df.withColumn("_done", F.struct(F.col("full_domain"), subdomains.alias("subdomains"), F.col("domain"), *suffix))
    return settled(df.drop("_labels", "_n", "_depth", "_stop", "_k", "_leaf", *taken), "_done")
