"""Writers. Spark's commit protocol makes each write whole or absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lines(df: DataFrame, path: str) -> None:
    """A JSON object a line, text as it is."""
    df.write.mode("overwrite").json(path)


def parquet(df: DataFrame, path: str, columns: list[str], write: bool = True) -> DataFrame:
    """The columns in order; write=False only plans it (a dry run)."""
    out = df.select(*columns)
    if write:
        out.write.mode("overwrite").parquet(path)
    return out


def by_source(df: DataFrame, path: str, source: str = "source_platform") -> None:
    """A folder a source; a hot source is several files, since rows stay in their tasks."""
    df.write.mode("overwrite").partitionBy(source).parquet(path)


def snapshots(df: DataFrame, path: str) -> None:
    """Immutable versions, appended under source and day."""
    df.write.mode("append").partitionBy("source_platform", "day").json(path)


def csv(df: DataFrame, path: str) -> None:
    """A header and lists as JSON."""
    nested = {c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))}
    df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns]).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def canonical_key(c: Column) -> Column:
    """An object key without scheme, bucket, doubled slashes and the old prefix; NULL for cache files."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^[a-z0-9]+://[^/]+/+", ""), "/{2,}", "/"), "^(?:data/)?collection/", "raw/")
    return F.when(~s.rlike(r"(?:^|/)(?:__pycache__|\.cache|\.DS_Store)|\.tmp$"), s)


def markdown(df: DataFrame, most: int = 200) -> str:
    """A small report as a table."""
    rows = df.limit(most).collect()
    head = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    return "\n".join([*head, *(f"| {' | '.join('' if v is None else str(v) for v in r)} |" for r in rows)])
