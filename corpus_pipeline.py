"""The corpus pipeline: stages over documents, each on what its predecessor kept.

Toxic documents go, one document of each class of near copies stays, documents that hold benchmark passages go, secrets
are replaced in the texts that stay, and the rest is sampled to target weights.

Cases: a null or empty text is kept by the first four stages (it scores the share of toxic labels, is linked with nothing,
matches no item, holds no secret) and drawn with its cell's probability; rows with a null id are kept and judged by their texts;
of rows equal in id and text one stays; of equally good documents of a class the smallest id stays; a very long text is read
whole; an empty table goes through all stages and stays empty; extra columns pass through, whatever their names, but for those
that the last stage adds (n_tokens, topic, probability, weight), which replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacatia.llm import decontaminate, mixing, neardup, secrets, toxicity
from vacatia.llm.common import materialize, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what scores as toxic; learnt from the labels that op8 may learn from."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id", 4, 2))
    return toxicity.reject(docs, toxicity.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each class over 5-word shingles at a similarity of 0.8."""
    return neardup.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold at least half of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put marks in the place of secrets, and the new length in n_chars."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample half of the tokens towards the target marginals."""
    return mixing.sample(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("secret_scans", secret_spans),
    ("mixing", mix),
]

#: Iterative stages (components, raking) and a learned score: not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
