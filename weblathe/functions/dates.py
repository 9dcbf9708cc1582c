"""Log dates to UTC days and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# What zone names of the first format stand for, and the formats.
ZONES = (("EST", "-05:00"), ("EDT", "-04:00"))
NAMED, ZONED, OFFSET = "MMM dd HH:mm:ss zzz yyyy", "yyyy-MM-dd HH:mm:ss.SSSz", "yyyy-MM-dd HH:mm:ss.SSSZ"


def parse_date(raw: Column, check_weekday: bool = False) -> Column:
    """Timestamp of a log date in any of its formats, null if it has none, whatever the session's time zone.

    Formats: ``Tue Jan 05 03:55:23 EST 2016`` and ``2016-01-05 03:55:23.962`` with a zone name, ``Z``, ``-05:00`` or
    ``-0500``. ``check_weekday`` also rejects a weekday that the date does not have.
    """
    zoned = raw
    for name, offset in ZONES:
        zoned = F.replace(zoned, F.lit(name), F.lit(offset))
    named = F.when(raw.rlike("^[A-Za-z]{3} "), F.try_to_timestamp(F.regexp_replace(zoned, "^[A-Za-z]{3} ", ""), F.lit(NAMED)))
    if check_weekday:
        written = F.concat_ws(" ", F.regexp_extract(raw, r"([0-9]{4})$", 1), F.regexp_extract(raw, r"^[A-Za-z]{3} ([A-Za-z]{3} [0-9]{2})", 1))
        named = F.when(F.date_format(F.try_to_timestamp(written, F.lit("yyyy MMM dd")), "EEE") == F.substring(raw, 1, 3), named)
    return F.coalesce(named, F.try_to_timestamp(raw, F.lit(ZONED)), F.try_to_timestamp(raw, F.lit(OFFSET)))


def day(ts: Column) -> Column:
    """``YYYY-MM-DD`` in UTC."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")).cast("string")


def year_month(ts: Column) -> Column:
    """``YYYY-MM`` in UTC."""
    return F.substring(day(ts), 1, 7)


def project(date: Column, grain: str) -> Column:
    """A ``YYYY-MM-DD`` string at a grain: the day itself or the first of its month."""
    if grain == "day":
        return date
    if grain == "month":
        return F.concat(F.substring(date, 1, 7), F.lit("-01"))
    raise ValueError(f"unknown grain {grain!r}")
