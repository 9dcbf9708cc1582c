"""Referrers to code, host and path.

URLs are read leniently, by what follows the scheme: blanks, underscores, pipes and backslashes pass, a port that is no
integer does not. ``parse_url`` and other RFC parsers reject such input, so the rules are spelled out as expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import formats as f
from .lines import BETWEEN

# Schemes that count as URLs; prefixes that stand for known programs.
SCHEMES = ("http", "https", "ftp", "file", "mailto", "jar", "jrt", "jmod")
PREFIXES = (("app:/readcube.swf", "readcube.special"), ("app:/library.swf", f.UNKNOWN_DOMAIN), ("app:/p", f.UNKNOWN_DOMAIN))


#: Scheme, authority (after two slashes, but not four) and path; query and fragment are cut off.
URL = r"^(?s)\s*(?i:url:)?([A-Za-z][A-Za-z0-9.+-]*):(?://(?!//)([^/?#]*))?([^?#]*).*$"
#: Host (bracketed or up to a colon) and what follows it, after user information.
AUTHORITY = r"^(?s)(?:[^@]*@)?(\[[^\]]*\]|[^:\[]*)(.*)$"


def lenient_url(df: DataFrame, source: str, out: str) -> DataFrame:
    """Add ``out``: a struct (scheme, host, path) of the URL in column ``source``, null where it is malformed or null.

    Each pattern runs once; a URL that does not fit stays in one part.
    """
    df = df.withColumn("_u", F.split(F.regexp_replace(F.rtrim(F.col(source)), URL, f"$1{BETWEEN}$2{BETWEEN}$3"), BETWEEN))
    authority, path = F.get("_u", F.lit(1)), F.get("_u", F.lit(2))
    # most authorities are plain names
    plain = ~authority.rlike(r"[@:\[]")
    df = df.withColumn("_v", F.when((F.size("_u") == 3) & ~plain, F.split(F.regexp_replace(authority, AUTHORITY, f"$1{BETWEEN}$2"), BETWEEN)))
    many = authority.rlike("@.*@")
    host = F.when(plain, authority).when(many, "").otherwise(F.get("_v", F.lit(0)))
    good_port = plain | many | F.get("_v", F.lit(1)).rlike(r"^(?::(?:\+?[0-9]{1,9})?)?$")
    scheme = F.lower(F.get("_u", F.lit(0)))
    good = (F.size("_u") == 3) & scheme.isin(*SCHEMES) & good_port & ((scheme != "jar") | F.contains(path, F.lit("!/")))
    struct = F.struct(scheme.alias("scheme"), host.alias("host"), path.alias("path"))
    return df.withColumn(out, F.when(good, struct)).drop("_u", "_v")


def settled(df: DataFrame, done: str) -> DataFrame:
    """The fields of struct ``done`` as columns, through a generator of one row.

    Filters above would else be pushed below and repeat the whole of the parsing, up to code that does not compile.
    """
    fields = df.schema[done].dataType.names
    return df.select(*(c for c in df.columns if c not in (done, *fields)), F.inline(F.array(F.col(done))))


def clean(referrer: Column) -> Column:
    """Strip a copied header name, and whatever stands before the first http(s) URL."""
    r = referrer
    for name in ("Referer:", "REFERER:"):
        r = F.when(F.startswith(referrer, F.lit(name)), F.regexp_replace(referrer, f"{name} *", "")).otherwise(r)
    return F.when(r.rlike("^https?://"), r).otherwise(F.regexp_replace(r, "^.*?(https?://.*)$", "$1"))


def parse_referrer(df: DataFrame, referrer: str = "referrer", compat: bool = False) -> DataFrame:
    """Add code, host (case kept) and path of column ``referrer``; a null counts as empty.

    Program prefixes get code W and their own domain; ``compat`` reads them as the malformed URLs they once passed for.
    """
    df = df.withColumn("_raw", F.coalesce(F.col(referrer), F.lit("")))
    df = df.withColumn("_r", clean(F.col("_raw")))
    weird = F.lit(None).cast("string")
    for prefix, domain in reversed(PREFIXES):
        weird = F.when(F.startswith("_r", F.lit(prefix)), F.lit(domain)).otherwise(weird)
    df = df.withColumn("_weird", weird)
    if compat:
        df = df.withColumn("_r", F.when(F.col("_weird").isNotNull(), F.concat(F.lit("weird://"), "_weird")).otherwise(F.col("_r"))).withColumn("_weird", F.lit(None).cast("string"))
    df = lenient_url(df, "_r", "_url")
    # only what is no URL is tried again
    df = lenient_url(df.withColumn("_again", F.when(F.col("_url").isNull() & F.col("_weird").isNull(), F.concat(F.lit("http://"), "_r"))), "_again", "_retry")
    row = lambda code, host, path="": F.struct(F.lit(code).alias("code"), (F.lit(host) if isinstance(host, str) else host).alias("host"), (F.lit(path) if isinstance(path, str) else path).alias("path"))
    scheme, url, retry, r = F.col("_url.scheme"), F.col("_url"), F.col("_retry"), F.col("_r")
    answer = (
        F.when(F.length("_raw") <= 1, row(f.NO_INFO, f.UNKNOWN_DOMAIN))
        .when(F.col("_weird").isNotNull(), row(f.WEIRD, F.col("_weird")))
        .when(scheme == "http", row(f.HTTP, url["host"], url["path"]))
        .when(scheme == "https", row(f.HTTPS, url["host"], url["path"]))
        .when(scheme == "ftp", row(f.FTP, url["host"], url["path"]))
        .when(scheme == "file", row(f.FILE, f.LOCAL_DOMAIN, url["path"]))
        .when(url.isNotNull(), row(f.UNKNOWN, f.UNKNOWN_DOMAIN, url["path"]))
        .when(r == "about:blank", row(f.NO_INFO, f.LOCAL_DOMAIN))
        .when(r.rlike(r"^[A-Z]:\\.*$"), row(f.FILE, f.LOCAL_DOMAIN))
        .when(F.startswith("_r", F.lit("mhtml:")), row(f.FILE, f.LOCAL_DOMAIN))
        .when(F.contains("_r", F.lit("dlvr.it")), row(f.UNKNOWN, "dlvr.it"))
        .when(F.contains("_r", F.lit("bit.ly")), row(f.UNKNOWN, "bit.ly"))
        .when(F.startswith("_r", F.lit("javascript:")), row(f.UNKNOWN, f.UNKNOWN_DOMAIN))
        .when(retry.isNotNull(), row(f.HTTP, retry["host"], retry["path"]))
        .otherwise(row(f.NO_INFO, f.UNKNOWN_DOMAIN))
    )
    df = df.withColumn("_a", answer)
    # never an empty host
    code = F.when(F.col("_a.host") == "", F.lit(f.UNKNOWN)).otherwise(F.col("_a.code"))
    host = F.when(F.col("_a.host") == "", F.lit(f.UNKNOWN_DOMAIN)).otherwise(F.col("_a.host"))
    df = df.withColumn("_done", F.struct(code.alias("code"), host.alias("host"), F.col("_a.path").alias("path")))
    return settled(df.drop("_raw", "_r", "_weird", "_url", "_again", "_retry", "_a"), "_done")
