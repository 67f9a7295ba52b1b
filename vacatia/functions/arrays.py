"""Array folds that keep order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_ci(c: Column) -> Column:
    """Distinct but for case; the first spelling stays, in place."""
    lower = F.transform(c, F.lower)
    return F.filter(c, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def merge_ci(*arrays: Column) -> Column:
    return distinct_ci(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]))


def split_list(c: Column) -> Column:
    """Items of a text list: separated by , | ; / or bullets, trimmed, without blanks and repeats."""
    return distinct_ci(F.filter(F.transform(F.split(c, r"[,|;/•]"), lambda x: F.trim(x)), lambda x: x != ""))


def lookup(c: Column, pairs: dict[str, str]) -> Column:
    """Each item's value by its lower case; items without one stay. pairs must be a bounded dictionary."""
    table = F.create_map(*[F.lit(x) for kv in sorted(pairs.items()) for x in kv])
    return F.transform(c, lambda x: F.coalesce(F.try_element_at(table, F.lower(F.trim(x))), F.trim(x)))
