"""Dates and validity intervals as native column expressions; a time without a zone is in UTC, whatever the session's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(?::(\d{2}(?:\.\d{1,6})?))?(?:Z|([+-]\d{2}):?(\d{2}))?)?$"
_MAIL = r"(\d{1,2}) ([A-Z][a-z]{2}) (\d{4}) (\d{2}:\d{2}:\d{2}) (GMT|UTC|[+-]\d{4})$"


def parse_time(raw: Column) -> Column:
    """Timestamp of an ISO 8601 date and time (extended form) or of a mail date; null if it is neither."""
    x = F.trim(raw)
    part = lambda k, other: F.when(F.regexp_extract(x, _ISO, k) == "", other).otherwise(F.regexp_extract(x, _ISO, k))
    iso = F.concat(part(1, None), F.lit("T"), part(2, "00:00"), F.lit(":"), part(3, "00"), part(4, "+00"), F.lit(":"), part(5, "00"))
    zone = F.regexp_replace(F.regexp_extract(x, _MAIL, 5), "GMT|UTC", "+0000")
    mail = F.concat_ws(" ", *[F.regexp_extract(x, _MAIL, k) for k in (1, 2, 3, 4)], zone)
    return F.coalesce(F.when(x.rlike(_ISO), F.try_to_timestamp(iso)), F.when(x.rlike(_MAIL), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss xx"))))


def _first_time(text: Column, pattern: str) -> Column:
    return F.get(F.filter(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), parse_time), lambda t: t.isNotNull()), F.lit(0))


def published(html: Column) -> Column:
    """The first readable "datePublished" of a page's JSON-LD; escaped key names are not recognised."""
    return _first_time(html, r'(?i)"datePublished"\s*:\s*"([^"]+)"')


def sitemap_lastmod(xml: Column) -> Column:
    return _first_time(xml, "(?i)<lastmod>([^<]+)</lastmod>")


#: Sources of valid_from, the most authoritative first.
SOURCES = ("http_last_modified", "schema_org_date_published", "sitemap_lastmod", "wayback_first_seen", "license_effective_date", "fetched_at")


def validity(times: dict[str, Column], ends: list[Column]) -> Column:
    """valid_from, valid_to and valid_from_source, from the times by source and possible ends; an end that is not later than the start leaves it open."""
    held = [(s, times[s]) for s in SOURCES if s in times]
    start = F.coalesce(*[t for _, t in held])
    source = F.coalesce(*[F.when(t.isNotNull(), s) for s, t in held])
    end = F.array_min(F.array(*ends)) if ends else F.lit(None).cast("timestamp")
    return F.struct(start.alias("valid_from"), F.when(end > start, end).alias("valid_to"), source.alias("valid_from_source"))
