"""Feature columns with reversible dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacatia.functions.text import fold_py, slug


def column_name(value: str) -> str:
    s = value.lower().replace("c#", "csharp").replace(".net", "dotnet").replace("c++", "cpp")
    return fold_py(s).replace(" ", "_") or "unknown"


def one_hot(column: Column, prefix: str, values: list[str]) -> list[Column]:
    return [F.coalesce((column == v).cast("byte"), F.lit(0).cast("byte")).alias(f"{prefix}__{column_name(v)}") for v in values]


def vocabulary(df: DataFrame, items: Column, least: int, most: int) -> list[tuple[str, str]]:
    """(slug, longest spelling) of the most frequent items; counted once a row, ties by slug. At most `most` rows come back."""
    once = df.select(F.explode(F.array_distinct(F.transform(items, lambda x: F.struct(slug(x).alias("slug"), x.alias("item"))))).alias("x")).select("x.*")
    counts = once.groupBy("slug").agg(F.count("*").alias("n"), F.max_by("item", F.struct(F.length("item"), "item")).alias("item"))
    return [(r["slug"], r["item"]) for r in counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "slug").limit(most).collect()]


def multi_hot(items: Column, prefix: str, slugs: list[str]) -> list[Column]:
    """A column for each slug, and how many distinct others a row has."""
    held = F.array_distinct(F.transform(F.coalesce(items, F.array().cast("array<string>")), slug))
    known = F.array(*[F.lit(s) for s in slugs]) if slugs else F.array().cast("array<string>")
    return [*[F.array_contains(held, s).cast("byte").alias(f"{prefix}__{s}") for s in slugs], F.size(F.array_except(held, known)).alias(f"{prefix}s__other_count")]


def numeric(columns: list[str]) -> list[Column]:
    """float32 with a flag for what is missing."""
    out = []
    for c in columns:
        v = F.col(c).try_cast("float")
        out += [v.alias(c), v.isNull().cast("byte").alias(f"{c}__missing")]
    return out


def dictionary(df: DataFrame) -> DataFrame:
    """(column, type) of a feature table, all numeric but the id."""
    rows = [(c, t) for c, t in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "column string, type string")
