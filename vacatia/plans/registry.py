"""Queries of a module, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Queries(dict):
    """name -> (query, SQL or None). Use add(sql) as a decorator; the function's name is the query's."""

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            self[f.__name__] = (f, sql)
            return f

        return put


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """spread: deal the rows out where the files give fewer tasks than there are cores; for work that costs more than moving rows."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and 2 * df.rdd.getNumPartitions() <= cores else df
