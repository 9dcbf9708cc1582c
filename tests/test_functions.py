"""Column functions beyond the goldens of the catalogue."""

import random

from pyspark.sql import functions as F

from weblathe.functions import dates
from weblathe.functions.referrer import lenient_url
from weblathe.operators.suffix import SuffixRules, with_domain


def test_lenient_url_agrees_with_the_jdk(spark):
    """Random http, https and ftp URLs, against java.net.URL."""
    r = random.Random(5)
    parts = ["a", "b.com", "//", "@", ":", ":80", ":x", "?q=1", "#f", ".", "..", "\\", " ", "_", "|", "é", "/", "/p"]
    urls = [r.choice(("http:", "https:", "ftp:", "HTTP:")) + r.choice(("//", "//", "", "/")) + "".join(r.choice(parts) for _ in range(r.randint(0, 7))) for _ in range(400)]
    df = lenient_url(spark.createDataFrame([(u,) for u in urls], "u string"), "u", "out")
    for row in df.collect():
        try:
            url = spark._jvm.java.net.URL(row["u"])
            expected = (url.getProtocol(), url.getHost(), url.getPath())
        except Exception:
            expected = None
        assert (tuple(row["out"]) if row["out"] else None) == expected, row["u"]


def test_suffix_walk_agrees_with_a_trie(spark):
    rules = ["com", "uk", "co.uk", "a.b.com", "*.ck", "!www.ck", "x.y", "*.k.com"]
    trie: dict = {}
    for rule in rules:
        node = trie
        for label in reversed(rule.split(".")):
            node = node.setdefault(label, {})
        node[None] = True

    def domain(host):
        labels, node, path = host.split(".")[::-1], trie, []
        for label in labels:
            child = node.get(label, node.get("*"))
            if child is None:
                return ".".join([label, *path]) if None in node else ""
            node, path = child, [label, *path]
        return ""

    r = random.Random(3)
    hosts = [".".join(r.choice(("com", "uk", "co", "a", "b", "ck", "www", "x", "y", "k", "zz")) for _ in range(r.randint(1, 5))) for _ in range(300)]
    out = with_domain(spark.createDataFrame([(h,) for h in hosts], "host string"), SuffixRules.build(spark, rules, special=False), keep_suffix=True).collect()
    for row in out:
        assert row["domain"] == domain(row["host"]), row["host"]
        if row["domain"]:
            assert row["host"].endswith(row["domain"]) and row["domain"].endswith(row["suffix"])
            assert row["subdomains"] == row["host"][: -len(row["domain"]) - 1]


def test_projection():
    import pytest

    with pytest.raises(ValueError):
        dates.project(F.lit("2016-01-05"), "week")
