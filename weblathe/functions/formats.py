"""Schemas and fixed values of resolution records."""

from __future__ import annotations

# One-letter codes of how a referrer was understood.
HTTP, HTTPS, FILE, FTP, UNKNOWN, NO_INFO, WEIRD = "H", "S", "L", "F", "U", "N", "W"
CODES = (FTP, HTTP, FILE, NO_INFO, HTTPS, UNKNOWN, WEIRD)
UNKNOWN_DOMAIN, LOCAL_DOMAIN = "unknown.special", "local.special"
#: Domains that the filtered outputs leave out by default; a site adds its own by parameter or by file.
FILTERED_DOMAINS = (UNKNOWN_DOMAIN,)

RECORD_COLUMNS = ("date", "doi", "code", "full_domain", "subdomains", "domain", "path")
RECORD_SCHEMA = ", ".join(f"{c} STRING" for c in RECORD_COLUMNS)
GRAINS = ("day", "month")
