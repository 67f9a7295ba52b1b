"""Ordered rules: level, family, relevance, null kinds, employment type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacatia.functions import terms as T
from vacatia.functions.arrays import distinct_ci, lookup, merge_ci
from vacatia.functions.text import contains_any, has_exact_term, has_term, java_quote

CANONICAL = {v: k for k, vs in T.SKILLS.items() for v in (k.lower(), *vs)}


def _first(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = reduce(lambda acc, r: F.when(*r) if acc is None else acc.when(*r), rules, None)
    return out.otherwise(otherwise)


def is_null(c: Column) -> Column:
    """NULL, or a text that says there is no value."""
    return c.isNull() | F.lower(F.trim(c)).isin(*T.NULL_MARKERS)


def null_kind(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return (
        F.when(c.isNull(), "EXPLICIT_NONE").when(s == "nan", "EXPLICIT_NAN").when(s.isin("[]", "{}"), "EMPTY_CONTAINER").when(s.isin("0", "0.0"), "NUMERIC_ZERO")
        .when(s == "", "WHITESPACE_ONLY").when(s.isin("thỏa thuận", "thoả thuận", "cạnh tranh", "thương lượng"), "NEGOTIABLE_MARKER").when(s.isin(*T.NULL_MARKERS), "TEXT_PLACEHOLDER").otherwise("VALID")
    )


def level(raw: Column, title: Column, years: Column) -> Column:
    """struct(level, source: raw|title|kinh_nghiem): the raw text, else the title, else the years asked for (with gaps)."""
    out = lambda v, s: F.struct(F.lit(v).alias("level"), F.lit(s).alias("source"))
    rules = [(has_term(raw, words), out(v, "raw")) for v, words in T.LEVEL_OF_RAW]
    rules += [(has_term(title, words), out(v, "title")) for v, words in T.LEVEL_OF_TITLE]
    bands = (("Mới tốt nghiệp", years == 0), ("Junior", years.between(1, 2)), ("Middle", years.between(3, 4)), ("Senior", years >= 5))
    rules += [(F.coalesce(test, F.lit(False)), out(v, "kinh_nghiem")) for v, test in bands]
    return _first(rules, F.struct(F.lit(T.UNKNOWN_LEVEL).alias("level"), F.lit(None).cast("string").alias("source")))


def level_conflict(level_: Column, low: Column, high: Column) -> Column:
    most = F.coalesce(high, low)
    return F.coalesce((level_.isin("Senior", "Trưởng nhóm/Quản lý") & (most < 2)) | (level_.isin("Thực tập", "Mới tốt nghiệp") & (low >= 3)), F.lit(False))


def family(title: Column, skills: Column) -> Column:
    """struct(family, source: title|skills|none)."""
    out = lambda v, s: F.struct(F.lit(v).alias("family"), F.lit(s).alias("source"))
    rules = [(has_term(title, words), out(v, "title")) for v, words, _ in T.FAMILIES]
    rules += [(F.coalesce(F.arrays_overlap(skills, F.array(*map(F.lit, held))), F.lit(False)), out(v, "skills")) for v, _, held in T.FAMILIES if held]
    return _first(rules, out(T.OTHER_FAMILY, "none"))


def relevance(title: Column, skills: Column) -> Column:
    """it, non_it or unknown: words of the title; both kinds or neither leave it to the number of technical skills."""
    t = F.trim(F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"(?U)\s+", " "))
    tech = F.size(F.array_intersect(F.transform(F.coalesce(skills, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), F.array(*map(F.lit, T.TECH_SKILLS))))
    it, other = has_exact_term(t, T.IT_WORDS), has_exact_term(t, T.OTHER_WORDS)
    return F.when(it & other, "unknown").when(it, "it").when(other, "non_it").when(tech >= T.MIN_TECH_SKILLS, "it").otherwise("unknown")


def relevance_of_unknown(title: Column, skills: Column, description: Column) -> Column:
    """it for a known family and at least two skills of the description, else non_it."""
    found = skills_in_text(description)
    return F.when((family(title, canonical(merge_ci(found, skills)))["family"] != T.OTHER_FAMILY) & (F.size(found) >= 2), "it").otherwise("non_it")


def canonical(skills: Column) -> Column:
    """Skills under their canonical names; unknown ones stay as written."""
    return distinct_ci(lookup(F.filter(skills, lambda x: x != ""), CANONICAL))


def skills_in_text(text: Column) -> Column:
    """Canonical skills that a text names, sorted. Words end at anything but ASCII letters, digits, _ # and +."""
    s = F.lower(F.coalesce(text, F.lit("")))
    hit = lambda words: s.rlike(r"(?<![a-zA-Z0-9_#+])(?:" + "|".join(java_quote(w) for w in words) + r")(?![a-zA-Z0-9_#+])")
    return F.array_sort(F.array_compact(F.array(*[F.when(hit(words), F.lit(k)) for k, words in T.SKILLS.items()])))


def tag_skills(tags: Column, company: Column) -> Column:
    """Tags that may be skills: up to four words, no category of work, not the company's name."""
    name = F.lower(F.trim(F.coalesce(company, F.lit(""))))
    ok = lambda x: (x != "") & (F.size(F.split(x, r"\s+")) <= 4) & ~x.rlike(f"(?iu){T.CATEGORY_TAGS}") & ~((F.length(name) > 3) & F.contains(F.lower(x), name))
    return distinct_ci(F.filter(F.transform(tags, lambda x: F.trim(x)), ok))


def all_skills(tags: Column, description: Column, company: Column) -> Column:
    return merge_ci(skills_in_text(description), tag_skills(tags, company))


def benefits(items: Column, description: Column) -> Column:
    """Benefits that the items or the description name, in the dictionary's order."""
    s = F.lower(F.concat_ws(" ", F.array_join(items, " "), description))
    return F.array_compact(F.array(*[F.when(contains_any(s, words), F.lit(k)) for k, words in T.BENEFITS.items()]))


def employment(c: Column) -> Column:
    s = F.lower(F.trim(c))
    return (
        F.when(c.isNull(), "missing").when(contains_any(s, ("toàn thời gian", "full_time", "full time", "nhân viên chính thức")), "full_time")
        .when(contains_any(s, ("bán thời gian", "part_time", "part time")), "part_time").when(contains_any(s, ("thực tập", "intern", "internship")), "intern").otherwise("other")
    )


def ordinal(level_: Column) -> Column:
    table = F.create_map(*[F.lit(x) for i, v in enumerate(T.SENIORITY) for x in (v, i)])
    return F.coalesce(F.try_element_at(table, level_), F.lit(-1)).cast("byte")
