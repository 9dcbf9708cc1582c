"""Fixed cases of the column functions, the stages and the file formats, as queries with their expected rows.

``EXPECTED`` holds what each query must return, written down by hand; the oracle turns it into VALUES.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, lines
from ..functions.formats import RECORD_COLUMNS
from ..functions.referrer import parse_referrer
from ..operators.suffix import SuffixRules, read_rules, with_domain
from ..sources import chunks, logs, staging
from .stages import failures, process

# Sample lines of both layouts, dates of every format, referrers of every kind and hosts.
#: Rules that the cases need.
RULES = ("com", "org", "edu", "gov", "br", "it", "ly", "uk", "co.uk", "io", "github.io", "us-east-1.elb.amazonaws.com", "*.ck", "!www.ck")
_R1A = '101.226.33.216 HTTP:HDL "2016-01-05 03:55:23.962-0500" 1 1 23ms 10.1002/AIC.14628 "200:0.na/10.1002" "http://www.sogou.com/"'
_R1B = '68.180.228.178 HTTP:HDL "2015-01-01 03:10:43.247Z" 1 1 195ms 10.1080/02732173.2012.628560 "200:0.na/10.1080" ""'
_R2 = '130.186.99.39 HTTP:HDL "2015-12-01 00:01:47.639+0100" 1 1 350ms 10.1016/j.anbehav.2009.06.021'
LOG = (("a", 0, "junk"), ("a", 1, _R1A), ("a", 2, _R2), ("b", 3, _R2), ("b", 4, _R1A), ("c", 5, _R1B), ("c", 6, "9.9.9.9 HTTP:OpenURL x"), ("c", 7, "no log line"))
_J2 = '10.1002/aic.14628 "200:0.na/10.1002" "http://www.sogou.com/"'
_READ_A1 = ("2016-01-05 03:55:23.962-0500", "10.1002/aic.14628", "http://www.sogou.com/")
_READ_R2 = ("2015-12-01 00:01:47.639+0100", "10.1016/j.anbehav.2009.06.021", "unknown.special")
_READ_B1 = ("2015-01-01 03:10:43.247Z", "10.1080/02732173.2012.628560", "")
_NONE = (None, None, None)
DATES = (
    ("2016-01-05 03:55:23.962-0500", "2016-01", "2016-01-05"), ("2015-01-01 03:10:43.247Z", "2015-01", "2015-01-01"), ("2016-01-05 03:55:23.962CET", "2016-01", "2016-01-05"),
    ("Tue Jan 05 03:55:23 EST 2016", "2016-01", "2016-01-05"), ("Tue Jan 05 03:55:23 UTC 2016", "2016-01", "2016-01-05"), ("Mon Jan 05 03:55:23 EST 2016", None, None),
    ("2015-12-01 00:01:47.639+0100", "2015-11", "2015-11-30"), ("yesterday", None, None),
)
#: (referrer, code, full_domain, subdomains, domain, path)
REFERRERS = (
    ("", "N", "unknown.special", "", "unknown.special", ""), ("-", "N", "unknown.special", "", "unknown.special", ""), ("http://www.sogou.com/", "H", "www.sogou.com", "www", "sogou.com", "/"),
    ("HTTPS://En.Wiki.org/x", "S", "en.wiki.org", "en", "wiki.org", "/x"), ("Referer: http://www.zetesis.it/people/parisia/", "H", "www.zetesis.it", "www", "zetesis.it", "/people/parisia/"),
    ("Feedspotbot: http://www.feedspot.com", "H", "www.feedspot.com", "www", "feedspot.com", ""), ("ask.com", "H", "ask.com", "", "ask.com", ""), ("ftp://x.org/p", "F", "x.org", "", "x.org", "/p"),
    ("file:///C:/x/y.htm", "L", "local.special", "", "local.special", "/C:/x/y.htm"), ("C:\\foo\\bar.htm", "L", "local.special", "", "local.special", ""), ("mhtml:file://C:\\a.mht", "L", "local.special", "", "local.special", ""),
    ("mhtml:http://x.com/a", "H", "x.com", "", "x.com", "/a"), ("about:blank", "N", "local.special", "", "local.special", ""), ("javascript:foo()", "U", "unknown.special", "", "unknown.special", ""),
    ("_bit=50f1;domain=.bit.ly;path=/; HttpOnly", "U", "bit.ly", "", "bit.ly", ""), ("dlvrId=bcf1; path=/; domain=dlvr.it", "U", "dlvr.it", "", "dlvr.it", ""), ("mailto:a@b.com", "U", "unknown.special", "", "unknown.special", "a@b.com"),
    ("http:///reload/10.1007/B", "U", "unknown.special", "", "unknown.special", "/reload/10.1007/B"), ("android-app://com.google.x", "H", "android-app", "", "", "//com.google.x"),
    ("app:/readcube.swf", "W", "readcube.special", "", "readcube.special", ""), ("app:/p822.swf", "W", "unknown.special", "", "unknown.special", ""), ("http://wiki/wiki/display", "H", "wiki", "", "", "/wiki/display"),
    ("http://130.186.99.39/x", "H", "130.186.99.39", "", "", "/x"), ("http://user:pw@Host.COM:8080/a/b?q=1#f", "H", "host.com", "", "host.com", "/a/b"), ("http://exa_mple.com/a|b?q", "H", "exa_mple.com", "", "exa_mple.com", "/a|b"),
    ("unknown.special", "H", "unknown.special", "", "unknown.special", ""),
)
COMPAT = tuple(r if not r[0].startswith("app:") else (r[0], "H", "weird", "", "", "//readcube.special" if "readcube" in r[0] else "//unknown.special") for r in REFERRERS)
SUFFIXES = (
    ("abc.def.co.uk", "def.co.uk", "abc"), ("a.github.io", "a.github.io", ""), ("github.io", "", ""), ("www.amazonaws.com", "", ""), ("www.ck", "", ""), ("foo.ck", "", ""), ("x.foo.ck", "x.foo.ck", ""), ("wiki", "", ""),
    ("130.186.99.39", "", ""), ("sfx.carli.illinois.edu", "illinois.edu", "sfx.carli"), ("www.ncbi.nlm.nih.gov", "nih.gov", "www.ncbi.nlm"), ("unknown.special", "unknown.special", ""), ("example.com.", "example.com", ""), ("x.us-east-1.elb.amazonaws.com", "x.us-east-1.elb.amazonaws.com", ""),
)


#: Lines of a file d: a date that can't be read, a tab in the path, and a good one.
_BAD_DATE = _R1B.replace("2015-01-01 03:10:43.247Z", "some day")
_TAB = _R1B.replace('""', '"http://x.org/a\tb"')
_GOOD = _R1B.replace('""', '"https://En.Wiki.org/x"')
MORE = (("d", 8, _BAD_DATE), ("d", 9, _TAB), ("d", 10, _GOOD))
_CHARS = sum(len(v) for _, _, v in (*LOG, *MORE))
_RECORD_B = ("10.1080/02732173.2012.628560",)
PROCESSED = (
    ("2016-01-05", "10.1002/aic.14628", "H", "www.sogou.com", "www", "sogou.com", "/", "2016-01"),
    ("2015-11-30", "10.1016/j.anbehav.2009.06.021", "H", "unknown.special", "", "unknown.special", "", "2015-11"),
    ("2016-01-05", _J2, "H", "unknown.special", "", "unknown.special", "", "2016-01"),
    ("2015-01-01", *_RECORD_B, "N", "unknown.special", "", "unknown.special", "", "2015-01"),
    ("2015-01-01", *_RECORD_B, "S", "en.wiki.org", "en", "wiki.org", "/x", "2015-01"),
)
QUARANTINED = (("a", "junk", "malformed"), ("a", _R2, "malformed"), ("c", "no log line", "malformed"), ("d", _BAD_DATE, "bad_date"), ("d", _TAB, "tab"))
#: A suffix list as a file, and hosts with their domain and public suffix.
LIST_FILE = ("// a comment", "com", "", "// another", "co.uk", "*.ck", "!www.ck", "uk")
LISTED = (
    ("a.b.com", "b.com", "com"), ("x.y.co.uk", "y.co.uk", "co.uk"), ("z.uk", "z.uk", "uk"), ("co.uk", "", None), ("a.b.ck", "a.b.ck", "b.ck"), ("b.ck", "", None), ("wiki", "", None), ("x.org", "", None),
)


def _values(rows: tuple, names: str) -> str:
    cell = lambda v: "CAST(NULL AS VARCHAR)" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") AS v({names})"


EXPECTED: dict[str, str] = {
    "log_parse_sticky": _values((("a", 0, *_NONE), ("a", 1, *_READ_A1), ("a", 2, *_NONE), ("b", 3, *_READ_R2), ("b", 4, _READ_A1[0], _J2, "unknown.special"), ("c", 5, *_READ_B1), ("c", 6, *_NONE), ("c", 7, *_NONE)), "file, line_id, date_raw, doi, referrer"),
    "log_parse_per_line": _values((("a", 0, *_NONE), ("a", 1, *_READ_A1), ("a", 2, *_READ_R2), ("b", 3, *_READ_R2), ("b", 4, *_READ_A1), ("c", 5, *_READ_B1), ("c", 6, *_NONE), ("c", 7, *_NONE)), "file, line_id, date_raw, doi, referrer"),
    "openurl_failure_metrics": _values((("total_lines", 11), ("total_chars", sum(len(v) for _, _, v in (*LOG, *MORE))), ("failed_lines", 4), ("open_url_ignores", 1), ("bad_dates", 1), ("tab_skips", 1), ("stored_skips", 1)), "counter, n"),
    "process_counters": _values(
        (("total_lines", 11, 11), ("total_chars", _CHARS, _CHARS), ("failed_lines", 4, 4), ("open_url_ignores", 1, 1), ("bad_dates", 1, 1), ("tab_skips", 1, 1), ("stored_skips", 0, 5)), "counter, first_run, second_run"
    ),
    "process_records": _values(PROCESSED, "date, doi, code, full_domain, subdomains, domain, path, year_month"),
    "quarantined_lines": _values(tuple(sorted((file, value, reason) for file, value, reason in QUARANTINED)), "file, value, reason"),
    "log_files": _values(tuple((file, value) for file, _, value in (*LOG, *MORE)), "file, value"),
    "suffix_list_file": _values(LISTED, "host, domain, suffix"),
    "chunk_pattern": _values((("a", "2015-01-01", 1), ("a", "2015-01-02", 2), ("b", "2015-01-01", 3)), "key, date, count"),
    "record_text_roundtrip": _values(PROCESSED, "date, doi, code, full_domain, subdomains, domain, path, year_month").replace("SELECT *", "SELECT date, doi, code, full_domain, subdomains, domain, path"),
    "date_formats": _values(DATES, "date_raw, year_month, date"),
    "referrer_goldens": _values(REFERRERS, "referrer, code, full_domain, subdomains, domain, path"),
    "referrer_goldens_compat": _values(COMPAT, "referrer, code, full_domain, subdomains, domain, path"),
    "suffix_goldens": _values(SUFFIXES, "host, domain, subdomains"),
}


def _log(spark: SparkSession, rows: tuple = LOG) -> DataFrame:
    return spark.createDataFrame(rows, "file string, line_id int, value string")


def _base(spark: SparkSession) -> str:
    """A new base folder with the fixed lines as log files, beside a file that is no log."""
    base = staging.folder(spark)
    for name in dict.fromkeys(f for f, _, _ in (*LOG, *MORE)):
        staging.write_file(spark, f"{base}/logs/access_log-{name}.gz", [v for f, _, v in (*LOG, *MORE) if f == name])
    staging.write_file(spark, f"{base}/logs/error_log-a.gz", ["no access"])
    return base


_NAME = "regexp_extract(file, 'access_log-([a-z])', 1) AS file"


def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the log files that are found, with their file."""
    return logs.read_logs(spark, f"{_base(spark)}/logs").selectExpr(_NAME, "value")


def process_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the process stage counts on its first run, and on a second one when every month is stored."""
    base = _base(spark)
    first, second = process(spark, base, RULES), process(spark, base, RULES)
    return spark.createDataFrame([(k, n, second[k]) for k, n in first.items()], "counter string, first_run bigint, second_run bigint")


def process_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored records after two runs of the process stage."""
    base = _base(spark)
    process(spark, base, RULES)
    process(spark, base, RULES)
    return logs.read_records(spark, f"{base}/processed")


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that the process stage kept aside."""
    base = _base(spark)
    process(spark, base, RULES)
    return spark.read.parquet(f"{base}/quarantine").selectExpr(_NAME, "value", "reason")


def record_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as text by month, read again, beside lines without seven fields and a file of another name."""
    path = staging.folder(spark)
    logs.write_record_text(spark.createDataFrame(PROCESSED, ", ".join(f"{c} string" for c in (*RECORD_COLUMNS, "year_month"))), path)
    staging.write_file(spark, f"{path}/2014-12.gz", ["short\trow"])
    staging.write_file(spark, f"{path}/notes.gz", ["\t".join("abcdefg")])
    return logs.read_record_text(spark, path)


def suffix_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains and public suffixes by a list read from a file."""
    path = f"{staging.folder(spark)}/list.txt"
    staging.write_file(spark, path, list(LIST_FILE))
    hosts = spark.createDataFrame([(h,) for h, _, _ in LISTED], "host string")
    return with_domain(hosts, SuffixRules.build(spark, read_rules(spark, path)), keep_suffix=True).select("host", "domain", "suffix")


def chunk_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the chunk files whose names match: a header without lines, several empty lines, a key in two files."""
    path = staging.folder(spark)
    staging.write_file(spark, f"{path}/2015-01-day-domain.csv-chunks", ["a", "2015-01-01,1", "", "", "none", "", "b", "2015-01-01,3", ""])
    staging.write_file(spark, f"{path}/2015-02-day-domain.csv-chunks", ["a", "2015-01-02,2"])
    staging.write_file(spark, f"{path}/2015-01-month-domain.csv-chunks", ["a", "2015-01-01,9", ""])
    return chunks.read_counts(spark, path, r"\d{4}-\d{2}-day-domain\.csv-chunks")


def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_lines(_log(spark)).select("file", "line_id", "date_raw", "doi", "referrer")


def log_parse_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.parse_lines(_log(spark), "per_line").select("file", "line_id", "date_raw", "doi", "referrer")


def failure_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the fixed lines, as if 2015-11 were stored."""
    row = failures(lines.parse_lines(_log(spark, (*LOG, *MORE))), SuffixRules.build(spark, RULES), stored=("2015-11",))
    return row.unpivot([], row.columns, "counter", "n")


def date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = dates.parse_date(F.col("date_raw"), check_weekday=True)
    return spark.createDataFrame([(d[0],) for d in DATES], "date_raw string").select("date_raw", dates.year_month(ts).alias("year_month"), dates.day(ts).alias("date"))


def _referrers(spark: SparkSession, compat: bool) -> DataFrame:
    df = spark.createDataFrame([(r[0],) for r in REFERRERS], "referrer string")
    return with_domain(parse_referrer(df, compat=compat), SuffixRules.build(spark, RULES)).select("referrer", "code", "full_domain", "subdomains", "domain", "path")


def referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _referrers(spark, False)


def referrers_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _referrers(spark, True)


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.createDataFrame([(s[0],) for s in SUFFIXES], "host string")
    return with_domain(df, SuffixRules.build(spark, RULES)).select("host", "domain", "subdomains")
