"""URL, HTML, identity and personal-data rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of tracking parameters.
TRACKING = r"^(utm_.*|gclid|fbclid|mc_eid|mc_cid|igshid|ref|ref_src|ref_url)$"


def canonical_url(url: Column) -> Column:
    """Lower scheme and host without user or default port, parameters decoded, sorted as (name, value) and encoded as a form;
    tracking and blank parameters and the fragment go. Null unless the scheme is http or https and the port a number."""
    parts = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    clean = F.regexp_replace(F.regexp_replace(url, r"(?U)^[\s\x00-\x20]+|[\s\x1c-\x1f]+$", ""), "[\t\r\n]", "")
    scheme, place, path, query = (F.regexp_extract(clean, parts, i) for i in range(1, 5))
    scheme, place = F.lower(scheme), F.regexp_replace(place, "^.*@", "")
    # A bracketed address loses its brackets; the port follows the first colon outside of them.
    place = F.regexp_replace(place, r"^\[([^\]]*)\]", "$1]")
    bracketed = place.contains("]")
    host = F.lower(F.when(bracketed, F.substring_index(place, "]", 1)).otherwise(F.substring_index(place, ":", 1)))
    port = F.when(bracketed, F.regexp_extract(place, r"\]:(.*)$", 1)).otherwise(F.regexp_extract(place, "^[^:]*:(.*)$", 1))
    number = F.when(port.rlike("^[0-9]{1,9}$"), port.cast("int"))
    usual = F.when(scheme == "http", 80).otherwise(443)
    place = F.when((port == "") | (number == usual), host).otherwise(F.concat(host, F.lit(":"), number))
    # A lone percent sign stands for itself.
    plain = lambda x: F.url_decode(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"))
    form = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]*=(?s:.+)"))
    pairs = F.transform(pairs, lambda p: F.struct(plain(F.substring_index(p, "=", 1)).alias("k"), plain(F.regexp_replace(p, "^[^=]*=", "")).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).rlike(TRACKING)))
    kept = F.array_join(F.transform(kept, lambda p: F.concat(form(p["k"]), F.lit("="), form(p["v"]))), "&")
    out = F.concat(scheme, F.lit("://"), place, F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))
    return F.when(scheme.isin("http", "https") & ((port == "") | (number <= 65535)), out)


def content_id(x: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(x, 256))


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_text(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " "))


def emails(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?U)(\b[\w.+-]+@[\w-]+\.[\w.-]+\b)")))


def valid_ipv4(text: Column) -> Column:
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\b(?:\d{1,3}\.){3}\d{1,3}\b)")))
    return F.filter(found, lambda x: F.forall(F.split(x, r"\."), lambda p: p.cast("int") <= 255))


def cards(text: Column) -> Column:
    """Distinct digit groups of 13 to 19 digits that pass the Luhn check."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(\b(?:\d[ -]?){13,19}\b)")), lambda x: F.regexp_replace(x, "[^0-9]", "")))
    return F.filter(found, lambda x: F.length(x).between(13, 19) & F.call_function("luhn_check", x))
