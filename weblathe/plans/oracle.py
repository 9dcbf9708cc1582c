"""DuckDB SQL for the catalogue: plain SQL over the driver's tables, sharing nothing with the operators."""

from __future__ import annotations

from . import goldens

RES = r"""
log AS (SELECT strftime(e.ts, '%Y-%m-%d') AS date, '10.5555/' || CAST(e.user_id AS VARCHAR) AS doi, CASE WHEN e.event_type = 'error' THEN '' ELSE p.url END AS referrer
        FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)),
parts AS (SELECT *, CASE WHEN referrer = '' THEN 'unknown.special' ELSE lower(regexp_extract(referrer, '^[a-z]+://([^/?#:]+)', 1)) END AS full_domain FROM log),
named AS (SELECT *, CASE WHEN referrer = '' THEN 'unknown.special' ELSE regexp_extract(full_domain, '([^.]+\.[^.]+)$', 1) END AS domain FROM parts),
res AS (SELECT date, doi, CASE WHEN referrer = '' THEN 'N' WHEN referrer LIKE 'https://%' THEN 'S' WHEN referrer LIKE 'http://%' THEN 'H' END AS code, full_domain,
  CASE WHEN length(full_domain) > length(domain) THEN substr(full_domain, 1, length(full_domain) - length(domain) - 1) ELSE '' END AS subdomains, domain,
  CASE WHEN referrer = '' THEN '' ELSE regexp_extract(referrer, '^[a-z]+://[^/?#]+([^?#]*)', 1) END AS path FROM named)"""
_MONTH = "substr(date, 1, 7) || '-01'"
_KEPT = "domain NOT IN ('doi.org', 'unknown.special', 'example.net')"


def _with(select: str) -> str:
    return f"WITH {RES} {select}"


def _count(key: str, grain: str, where: str = "true") -> str:
    date = "date" if grain == "day" else _MONTH
    return f"SELECT {key} AS key, {date} AS date, count(*) AS count FROM res WHERE {where} GROUP BY 1, 2"


def _codes(grain: str) -> str:
    date = "date" if grain == "day" else _MONTH
    return _with(f'SELECT {date} AS "Date", ' + ", ".join(f"count(*) FILTER (WHERE code = '{c}') AS \"{c}\"" for c in "FHLNSUW") + " FROM res GROUP BY 1")


def _top(counts: str, n: int, prefix: str = "") -> str:
    return f"""WITH {prefix} c AS ({counts}), top AS (SELECT DISTINCT key FROM (SELECT key, row_number() OVER (PARTITION BY date ORDER BY count DESC, key) AS r FROM c) WHERE r <= {n})
SELECT d.date, top.key, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM (SELECT DISTINCT date FROM c) d CROSS JOIN top LEFT JOIN c ON c.date = d.date AND c.key = top.key"""


def _wide(counts: str, n: int) -> str:
    return f"""WITH {RES}, c AS ({counts}), top AS (SELECT DISTINCT key FROM (SELECT key, row_number() OVER (PARTITION BY date ORDER BY count DESC, key) AS r FROM c) WHERE r <= {n}),
placed AS (SELECT key, CAST(row_number() OVER (ORDER BY sum(count) DESC, key) AS INTEGER) AS place FROM c JOIN top USING (key) GROUP BY key)
SELECT d.date AS "Date", placed.place, placed.key, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM (SELECT DISTINCT date FROM c) d CROSS JOIN placed LEFT JOIN c ON c.date = d.date AND c.key = placed.key"""


_ORDERS = "SELECT strftime(o_orderdate, '%Y-%m') AS ym, '10.5555/' || CAST(o_custkey AS VARCHAR) AS doi, o_orderkey AS k FROM orders"


def _bucket(key: str, n: int) -> str:
    return _with(f"SELECT DISTINCT {key} AS key, upper(substr(md5({key}), 1, {n})) AS bucket FROM res")


SQL: dict[str, str] = {
    "referrer_parse": _with("SELECT date, doi, code, full_domain, subdomains, domain, path FROM res"),
    "rollup": _with("SELECT date, code, full_domain, domain, count(*) AS count FROM res GROUP BY ALL"),
    "count_domain_day": _with(_count("domain", "day")),
    "count_domain_month": _with(_count("domain", "month")),
    "count_fulldomain_month": _with(_count("full_domain", "month")),
    "count_code_day": _with(_count("code", "day")),
    "count_code_month": _with(_count("code", "month")),
    "count_doi_month_cutoff": _with(_count("doi", "month") + " HAVING count(*) >= 5"),
    "count_doi_month_cutoff_60": _with(_count("doi", "month") + " HAVING count(*) >= 60"),
    "count_all_day": _with("SELECT date, count(*) AS count FROM res GROUP BY 1"),
    "count_all_month": _with(f"SELECT {_MONTH} AS date, count(*) AS count FROM res GROUP BY 1"),
    "grouped_fulldomains": _with("SELECT DISTINCT domain, full_domain FROM res WHERE domain <> ''"),
    "fulldomain_domain_map": _with("SELECT full_domain, max(domain) AS domain FROM res WHERE domain <> '' GROUP BY 1"),
    "code_table_day": _codes("day"),
    "code_table_month": _codes("month"),
    "doi_series_month": _with(_count("doi", "month") + " HAVING count(*) >= 5"),
    "domain_unfiltered_day": _with(_count("domain", "day", "domain <> ''")),
    "domain_filtered_day": _with(_count("domain", "day", _KEPT)),
    "fulldomain_filtered_month": _with(_count("full_domain", "month", _KEPT)),
    "grouped_fulldomain_filtered": _with(f"SELECT DISTINCT domain, full_domain FROM res WHERE {_KEPT}"),
    "topn_domain_day_long": _top(_count("domain", "day"), 2, RES + ","),
    "topn_domain_day_long_filtered": _top(_count("domain", "day", _KEPT), 2, RES + ","),
    "topn_fulldomain_month_long": _top(_count("full_domain", "month"), 10, RES + ","),
    "topn_fulldomain_month_long_filtered": _top(_count("full_domain", "month", _KEPT), 10, RES + ","),
    "chunk_bucket_domain": _bucket("domain", 2),
    "chunk_bucket_fulldomain": _bucket("full_domain", 3),
    "chunk_bucket_doi": _bucket("doi", 4),
    "chunk_roundtrip": _with(_count("domain", "month", "domain <> ''")),
    "incremental_no_overwrite": f"WITH o AS ({_ORDERS}) SELECT ym AS year_month, count(*) AS count FROM o WHERE ym >= '1996-01' OR k % 2 = 0 GROUP BY 1",
    "aggregate_incremental_all": f"WITH o AS ({_ORDERS}) SELECT ym || '-01' AS date, count(*) AS count FROM o WHERE ym >= '1996-01' OR k % 2 = 0 GROUP BY 1",
    "aggregate_incremental_doi": f"""WITH o AS ({_ORDERS}), once AS (SELECT doi AS key, ym || '-01' AS date, count(*) AS count, ym FROM o WHERE ym < '1996-01' AND k % 2 = 0 GROUP BY ALL),
again AS (SELECT doi AS key, ym || '-01' AS date, count(*) AS count FROM o WHERE ym NOT IN (SELECT ym FROM once WHERE count >= 2) GROUP BY ALL)
SELECT key, date, count FROM once WHERE count >= 2 UNION ALL SELECT key, date, count FROM again WHERE count >= 2""",
    "chunk_roundtrip_grouped": _with("SELECT DISTINCT domain, full_domain FROM res WHERE domain <> ''"),
    "plain_counts_file": _with("SELECT row_number() OVER (ORDER BY date) - 1 AS place, date || ',' || count(*) AS value FROM res GROUP BY date"),
    "bucket_files": _with(f"SELECT key, date || ',' || count AS line, upper(substr(md5(key), 1, 2)) AS bucket FROM ({_count('domain', 'month', "domain <> ''")})"),
    "copied_table": _codes("month"),
    "fulldomain_unfiltered_month": _with(_count("full_domain", "month")),
    "grouped_fulldomain_unfiltered": _with("SELECT DISTINCT domain, full_domain FROM res WHERE domain <> ''"),
    "wide_topn_domain_day_10": _wide(_count("domain", "day", "domain <> ''"), 10),
    "wide_topn_domain_month_10_filtered": _wide(_count("domain", "month", _KEPT), 10),
    "wide_topn_domain_month_100": _wide(_count("domain", "month", "domain <> ''"), 100),
    "wide_topn_fulldomain_day_3": _wide(_count("full_domain", "day"), 3),
    "topn_domain_month_100_long": _top(_count("domain", "month", "domain <> ''"), 100, RES + ","),
    "order_months_topn": _top("SELECT o_orderpriority AS key, strftime(o_orderdate, '%Y-%m') || '-01' AS date, count(*) AS count FROM orders GROUP BY 1, 2", 2),
    **goldens.EXPECTED,
}
