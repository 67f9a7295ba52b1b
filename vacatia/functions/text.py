"""Text functions: Column -> Column, JVM-side. Unicode classes ((?U)) wherever words may have accents."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacatia.functions import terms as T

#: A word with inner dots, dashes and underscores.
TOKEN = r"(?U)\b[\w\d_.-]+\b"
BULLET = r"(?U)^\s*(?:[-–•*+▪▫➢]|(?:\d+[.)]))\s*"

# letters with marks and their plain letter, from Unicode's decompositions of the Latin blocks
_MARKED = [(c, p) for c in map(chr, range(0xC0, 0x1EFA)) if (p := unicodedata.normalize("NFD", c)[0]) != c and p.isascii()]
_FROM, _TO = "".join(c for c, _ in _MARKED) + "đĐ", "".join(p for _, p in _MARKED) + "dD"


def java_quote(term: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}#&~ -])", lambda m: "\\" + m[0] if m[0] != " " else m[0], term)


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def collapse(c: Column) -> Column:
    """Runs of white space as one space; NULL if nothing is left."""
    return empty_to_null(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def fold(c: Column) -> Column:
    """Lower case, no accents, đ as d, all but a-z and 0-9 as a space."""
    plain = F.regexp_replace(F.translate(F.lower(F.coalesce(c, F.lit(""))), _FROM, _TO), r"\p{Mn}", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def fold_py(s: str) -> str:
    """fold() of a literal, for dictionaries."""
    s = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn").replace("đ", "d")
    return re.sub(r"[^a-z0-9]+", " ", s).strip()


def slug(c: Column) -> Column:
    """A column name's part: c# and .net spelt out, folded, with underscores."""
    s = F.lower(F.coalesce(c, F.lit("")))
    for a, b in (("c#", "csharp"), (".net", "dotnet"), ("c++", "cpp")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.coalesce(empty_to_null(F.replace(fold(s), F.lit(" "), F.lit("_"))), F.lit("unknown"))


def identity_key(company: Column, title: Column) -> Column:
    one = lambda c: F.replace(fold(c), F.lit(" "), F.lit("-"))
    return F.concat(one(company), F.lit("__"), one(title))


def strip_html(c: Column) -> Column:
    """HTML as text: breaks and block ends are lines, other tags a space, common entities decoded once."""
    s = F.regexp_replace(c, r"(?i)<\s*br\s*/?>|</\s*(?:p|li|tr|div)\s*>", "\n")
    s = F.regexp_replace(s, r"<[^>]+>", " ")
    s = F.regexp_replace(s, "&(?:nbsp|#160|#xa0);", " ")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.regexp_replace(F.translate(s, " ​", " "), r"[ \t]+", " ")
    lines = F.filter(F.transform(F.split(s, r"\r?\n|\r"), lambda x: F.trim(x)), lambda x: x != "")
    return empty_to_null(F.array_join(lines, "\n"))


def visible_text(c: Column) -> Column:
    """Page text without scripts, styles and tags, on one line."""
    s = F.regexp_replace(c, r"(?is)<(script|style|noscript)[^>]*>.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"(?s)<[^>]*>", " "), r"\s+", " "))


def stitch_bullets(lines: Column) -> Column:
    """Lines as items: a bullet starts one, and so does a line after a finished one; other lines continue the last."""
    clean = F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")
    fold_ = lambda acc, x: F.when(
        (F.size(acc) == 0) | x.rlike(BULLET) | F.element_at(acc, -1).rlike(r"[.:;!]$"), F.concat(acc, F.array(x))
    ).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(F.element_at(acc, -1), F.lit(" "), x))))
    # the guard keeps element_at from an empty array
    safe = lambda acc, x: F.when(F.size(acc) == 0, F.array(x)).otherwise(fold_(acc, x))
    return F.aggregate(clean, F.array().cast("array<string>"), safe)


def clean_lines(c: Column) -> Column:
    """Lines without bullets or numbers, of at least two characters with a letter or digit; <li> bodies where there are any."""
    items = F.regexp_extract_all(c, F.lit(r"(?is)<li[^>]*>(.*?)</li>"), F.lit(1))
    lines = F.when(F.size(items) > 0, items).otherwise(F.split(F.coalesce(strip_html(c), F.lit("")), "\n"))
    bare = F.transform(lines, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", ""), BULLET, "")))
    return F.filter(bare, lambda x: (F.length(x) >= 2) & x.rlike(r"[\p{L}\p{N}]"))


def has_term(c: Column, words: Iterable[str]) -> Column:
    """A whole word of the list, a plural s allowed, in any case. One alternation for the list."""
    return F.coalesce(c.rlike(r"(?iuU)(?<!\w)(?:" + "|".join(java_quote(w) for w in words) + r")s?(?!\w)"), F.lit(False))


def has_exact_term(c: Column, words: Iterable[str]) -> Column:
    """A whole word of the list, where + and # belong to words (c++, c#); c in lower case."""
    alternatives = "|".join(java_quote(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    return F.coalesce(c.rlike(rf"(?U)(?<![\w+#])(?:{alternatives})(?![\w+#])"), F.lit(False))


def contains_any(c: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0))


def metrics(c: Column) -> Column:
    """struct(words, chars, sentences, ttr, is_stub)."""
    s = F.trim(F.coalesce(c, F.lit("")))
    words = F.regexp_extract_all(s, F.lit(TOKEN), F.lit(0))
    distinct = F.size(F.array_distinct(F.transform(words, F.lower)))
    sentences = F.size(F.filter(F.split(s, r"[.!?\n]+"), lambda x: F.trim(x) != ""))
    return F.struct(
        F.size(words).alias("words"), F.length(s).alias("chars"), sentences.alias("sentences"),
        F.when(F.size(words) > 0, F.round(distinct / F.size(words), 3)).otherwise(0.0).alias("ttr"), (F.size(words) < T.MIN_WORDS).alias("is_stub"),
    )


def company_name(c: Column) -> Column:
    """A company's name without legal words and punctuation, lower case."""
    s = F.lower(F.coalesce(c, F.lit("")))
    for w in T.LEGAL_WORDS:
        s = F.regexp_replace(s, rf"(?iuU)\b{w}\b", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def company_block(c: Column) -> Column:
    return F.regexp_replace(company_name(c), r"^(cty|ctcp|cong ty|công ty)\s+", "")


def clean_title(c: Column) -> Column:
    """A title without a leading [city] tag and a trailing salary."""
    s = F.regexp_replace(F.trim(c), r"(?iuU)^\[(?:hn|hcm|hà nội|hồ chí minh|toàn quốc|sg|đn|dn)[\w\s/,|–-]*\]\s*", "")
    s = F.regexp_replace(s, r"(?iuU)[-–|]\s*(?:lương|thu nhập|upto|up to)\s*[\d\s.,Mmtrđ-]+$", "")
    return F.coalesce(empty_to_null(F.trim(s)), c)


def to_vietnamese(c: Column) -> Column:
    for en, vi in T.EN_VI:
        c = F.regexp_replace(c, rf"(?iuU)\b{java_quote(en)}\b", vi)
    return c


def language_by_markers(c: Column) -> Column:
    """vi, en or bilingual, by telling words; accents decide the rest."""
    s = F.lower(c)
    n = lambda words: reduce(lambda a, b: a + b, [F.contains(s, F.lit(w)).cast("int") for w in words])
    vi, en = n(T.VI_MARKERS), n(T.EN_MARKERS)
    accents = s.rlike(f"[{T.VI_LETTERS}]")
    return F.when((vi >= 3) & (en == 0), "vi").when((en >= 3) & (vi == 0), "en").when((vi > 0) & (en > 0), "bilingual").when(accents, "vi").otherwise("en")


def language_by_letters(c: Column, *without: Column) -> Column:
    """en if under 1 % of the letters have Vietnamese marks; vi without letters. Texts of `without` don't count."""
    s = F.coalesce(c, F.lit(""))
    for part in without:
        s = F.when(F.coalesce(part, F.lit("")) != "", F.replace(s, part, F.lit(" "))).otherwise(s)
    s = F.regexp_replace(s, r"(?iuU)chi tiết công việc|\btại\b", " ")
    # most letters are ASCII and go in runs: only the rest is looked at one by one
    rest = F.regexp_replace(s, r"[\x00-\x7F]+", "")
    letters = F.length(F.regexp_replace(s, "[^A-Za-z]+", "")) + F.regexp_count(rest, F.lit(r"\p{L}"))
    marked = F.regexp_count(F.lower(rest), F.lit(f"[{T.VI_LETTERS}]"))
    return F.when(letters == 0, "vi").when(marked / letters < 0.01, "en").otherwise("vi")
