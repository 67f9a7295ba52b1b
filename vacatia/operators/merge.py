"""Joins that plan or merge: upserts, diffs, calendars, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(base: DataFrame, updates: DataFrame, key: str, newer: str) -> DataFrame:
    """Rows of both by key; of two the newer, on a tie the update. One shuffle: a union and max_by, no join."""
    both = base.withColumn("_tier", F.lit(0)).unionByName(updates.withColumn("_tier", F.lit(1)), allowMissingColumns=True)
    fields = [c for c in both.columns if c not in (key, "_tier")]
    picked = both.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(newer, "_tier")).alias("_r"))
    return picked.select(key, *[f"_r.{c}" for c in fields])


def version_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, old, new, change: added|removed|changed)."""
    j = old.withColumnRenamed(value, "old").withColumn("_o", F.lit(True)).join(new.withColumnRenamed(value, "new").withColumn("_n", F.lit(True)), keys, "full")
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return j.withColumn("change", change).filter("change is not null").select(*keys, "old", "new", "change")


def calendar(days: DataFrame, others: DataFrame, counts: DataFrame, on: list[str], count: str) -> DataFrame:
    """Counts for every day and other value, 0 where there are none. days and others are small lists."""
    return days.crossJoin(F.broadcast(others)).join(counts, on, "left").withColumn(count, F.coalesce(F.col(count), F.lit(0)))


def days_between(df: DataFrame, day: Column) -> DataFrame:
    """(day): all days from the first to the last."""
    return df.agg(F.min(day).alias("a"), F.max(day).alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
