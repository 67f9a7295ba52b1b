"""Rules of reports and ledgers that differ from the pipeline's own on purpose."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacatia.functions.text import contains_any, has_term

# Markers that a report takes for empty, tracking parameters by their whole names, texts without experience.
REPORT_EMPTY = ("", "n/a", "na", "null", "none", "-", "--", "đang cập nhật", "updating", "0", "[]", "{}")
TRACKING_NAMES = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "src", "medium", "ref", "referrer")
NONE_ASKED = ("không yêu cầu", "no experience", "chưa có")
# Old city names and the words that show them, in order.
UNKNOWN_CITY = "Không xác định"
CITIES = (
    ("Hồ Chí Minh", ("hồ chí minh", "hcm", "tp.hcm", "sài gòn", "quận 1", "bình thạnh", "tân bình")), ("Hà Nội", ("hà nội", "hn", "cầu giấy", "ba đình", "nam từ liêm", "đống đa")),
    ("Đà Nẵng", ("đà nẵng", "dn", "ngũ hành sơn")), ("Bình Dương", ("bình dương", "dĩ an", "thủ dầu một")), ("Đồng Nai", ("đồng nai", "biên hòa")),
    ("Hải Phòng", ("hải phòng",)), ("Cần Thơ", ("cần thơ",)), ("Remote", ("remote", "từ xa", "toàn quốc", "online")),
)


def is_empty(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*REPORT_EMPTY)


def batch_id(day: Column, source: Column, n: Column) -> Column:
    """day_source_n, the number in three places."""
    return F.format_string("%s_%s_%03d", F.date_format(day, "yyyy-MM-dd"), F.lower(source), n)


def tracked_url(c: Column) -> Column:
    """A URL without fragment, tracking or blank parameters (by whole names), these in order; the root path stays."""
    part = lambda p: F.regexp_extract(F.trim(c), p, 1)
    pairs = F.filter(F.split(part(r"\?([^#]*)"), "&"), lambda p: p.rlike("^[^=]+=.+") & ~F.lower(F.substring_index(p, "=", 1)).isin(*TRACKING_NAMES))
    query = F.array_join(F.array_sort(pairs), "&")
    path = F.regexp_replace(part(r"^[^:]+://[^/?#]*([^?#]*)"), "/+$", "")
    return F.concat(part(r"^([^:]+://[^/?#]*)"), F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def least_experience(c: Column) -> Column:
    """The lower bound of a text's years; 0 where none are asked for."""
    s = F.lower(c)
    n, unit = r"(\d+(?:[.,]\d+)?)", r"(?:năm|years?|yrs?)"
    got = F.coalesce(*[F.nullif(F.regexp_extract(s, p, 1), F.lit("")) for p in (rf"{n}\s*(?:-|–|~|đến|to)\s*\d+(?:[.,]\d+)?\s*{unit}", rf"{n}\s*(?:\+\s*)?{unit}")])
    return F.when(contains_any(s, NONE_ASKED), 0.0).otherwise(F.replace(got, F.lit(","), F.lit(".")).try_cast("double"))


def old_city(c: Column) -> Column:
    """The first city whose words a text has; else the text, trimmed."""
    rules = [(F.coalesce(c, F.lit("")) == "", F.lit(UNKNOWN_CITY)), *((has_term(F.lower(c), words), F.lit(name)) for name, words in CITIES)]
    return reduce(lambda acc, r: F.when(*r) if acc is None else acc.when(*r), rules, None).otherwise(F.trim(c))


def only(fields: Column, names: tuple[str, ...]) -> Column:
    """The named entries of a map: the fields whose change counts."""
    return F.map_filter(fields, lambda k, _: k.isin(*names))
