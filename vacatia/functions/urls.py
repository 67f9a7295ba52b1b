"""URLs: canonical forms, ids and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that only track.
TRACKING = r"^(?:utm_|fbclid|gclid|ref|source|u_sr_id|ta_source|traceinfo)"


def _params(c: Column) -> Column:
    return F.filter(F.split(F.regexp_extract(c, r"\?([^#]*)", 1), "&"), lambda p: p.rlike("^[^=]+=.+") & ~p.rlike(TRACKING))


def canonical(c: Column, sort: bool = False) -> Column:
    """Scheme and host in lower case; no fragment, tracking or blank parameters, nor a last slash."""
    head = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    params = F.array_sort(_params(c)) if sort else _params(c)
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.concat(head, path, query)


def url_hash(c: Column) -> Column:
    return F.md5(canonical(c).cast("binary"))


def shard(hash_: Column, n: int) -> Column:
    return F.pmod(F.conv(F.substring(hash_, 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def job_id(c: Column) -> Column:
    """Six or more digits of the path, a number before .html, or 12 digits of the URL's hash."""
    digits = F.regexp_extract(c, r"(\d{6,})", 1)
    page = F.regexp_extract(c, r"/(\d+)\.html", 1)
    pick = lambda x: F.when(x != "", x)
    return F.coalesce(pick(digits), pick(page), F.substring(F.md5(c.cast("binary")), 1, 12))


def content_hash(html: Column) -> Column:
    """SHA-256 of the visible text without counts and ages that change by the hour."""
    from vacatia.functions.text import visible_text

    s = F.regexp_replace(F.lower(visible_text(html)), r"\d+\s*(?:seconds?|minutes?|hours?|days?|weeks?|months?)\s+ago|\d+\s*views?", "")
    return F.sha2(F.trim(F.regexp_replace(s, r"\s+", " ")).cast("binary"), 256)


def field_hashes(fields: Column) -> Column:
    """SHA-256 of each value of a map, by key."""
    return F.transform_values(fields, lambda _, v: F.sha2(v.cast("binary"), 256))


def canonical_json_hash(fields: Column, volatile: tuple[str, ...] = ()) -> Column:
    """SHA-256 of a map as JSON with sorted keys, without volatile ones."""
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*volatile)) if volatile else fields
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept)))).cast("binary"), 256)
