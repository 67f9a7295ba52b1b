"""All named queries of the library, and SQL for their oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.functions import terms as T
from vacatia.functions import text
from vacatia.operators import dedup
from vacatia.plans.registry import table

Query = Callable[[SparkSession, str], DataFrame]

#: Modules of vacatia.plans, each with QUERIES: name -> (query, SQL or None).
MODULES: tuple[str, ...] = ("relational", "profiles", "texts", "entities", "monitoring", "postings", "reports", "sites")


def _all() -> dict[str, tuple[Query, str | None]]:
    out: dict[str, tuple[Query, str | None]] = {}
    for m in MODULES:
        for name, pair in importlib.import_module(f"vacatia.plans.{m}").QUERIES.items():
            if name in out:
                raise ValueError(f"two queries are named {name}")
            out[name] = pair
    return out


def queries() -> dict[str, Query]:
    return {"flagship": flagship, **{k: q for k, (q, _) in _all().items()}}


def oracle_sql() -> dict[str, str]:
    return {"flagship": FLAGSHIP_SQL, **{k: s for k, (_, s) in _all().items() if s}}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of at least 30 words, the longest of each text's copies, counted by source and language."""
    docs = table(spark, sf_dir, "documents", spread=True).withColumn("words", text.word_count(F.col("text"))).filter(F.col("words") >= T.MIN_WORDS)
    slim = docs.select("doc_id", "source", "lang", "words", F.md5(F.col("text").cast("binary")).alias("copy"))
    best = dedup.latest(slim, ["copy"], [F.desc("words"), F.asc("doc_id")])
    return best.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("words").alias("words")).orderBy("source", "lang")


FLAGSHIP_SQL = r"""with d as (select doc_id, source, lang, md5(text) as copy, len(regexp_extract_all(text, '[\p{L}\p{N}_][\p{L}\p{N}_.-]*[\p{L}\p{N}_]|[\p{L}\p{N}_]'))::bigint as words from documents),
    b as (select * from d where words >= 30 qualify row_number() over (partition by copy order by words desc, doc_id) = 1)
    select source, lang, count(*) as n, sum(words)::bigint as words from b group by source, lang"""
