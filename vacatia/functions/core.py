"""Building blocks of larger expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once: without it, an expression that is used often grows the plan each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def record(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])
