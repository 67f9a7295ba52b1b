"""Contracts and counters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class NotConserved(ValueError):
    """Rows came or went without a rule that says so."""


@dataclass
class StepReport:
    """Counts of a step: rows in and out, and of each rule (action drop, flag or modify). Read after the step's action has run."""

    step: str
    observed: dict[str, Observation] = field(default_factory=dict)
    actions: dict[str, str] = field(default_factory=dict)

    def count(self, df: DataFrame, name: str, test: Column | None = None, action: str = "flag") -> DataFrame:
        """df, counted when it runs: rows, or rows that pass the test."""
        o = Observation(f"{self.step}-{name}")
        self.observed[name], self.actions[name] = o, action
        return df.observe(o, F.count(F.lit(1)).alias("n") if test is None else F.count_if(test).alias("n"))

    def counts(self) -> dict[str, int]:
        return {k: int(o.get["n"]) for k, o in self.observed.items()}

    def check(self, before: str = "in", after: str = "out") -> None:
        n = self.counts()
        dropped = sum(v for k, v in n.items() if self.actions[k] == "drop")
        if n[before] != n[after] + dropped:
            raise NotConserved(f"{self.step}: {n[before]} in, {n[after]} out, {dropped} dropped")


def examples(df: DataFrame, rule: str, id_: str, n: int = 3) -> DataFrame:
    """(rule, id) of the first n ids of each rule."""
    from pyspark.sql import Window as W

    return df.withColumn("_n", F.row_number().over(W.partitionBy(rule).orderBy(id_))).filter(F.col("_n") <= n).select(rule, id_)


def require(df: DataFrame, columns: list[str], forbidden: list[str] = ()) -> DataFrame:
    if df.columns != list(columns) or set(forbidden) & set(df.columns):
        raise ValueError(f"columns {df.columns} are not {list(columns)}")
    return df


def require_numeric(df: DataFrame, id_: str) -> DataFrame:
    odd = [c for c, t in df.dtypes if c != id_ and t not in ("tinyint", "smallint", "int", "bigint", "float", "double")]
    if odd:
        raise ValueError(f"not numeric: {odd}")
    return df


def issue(df: DataFrame, level: str, name: str, test: Column, subject: str) -> DataFrame:
    """(level, issue, subject, n) of the subjects with rows that fail a test."""
    return df.filter(test).groupBy(F.col(subject).cast("string").alias("subject")).agg(F.count("*").alias("n")).select(F.lit(level).alias("level"), F.lit(name).alias("issue"), "subject", "n")
