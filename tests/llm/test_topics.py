"""Topics are learnt from all texts."""

import numpy as np
from pyspark.sql import functions as F

from vacatia.llm import mixing


def test_topics_count_every_text(spark):
    """Frequencies, means of languages and centres of 5,000 texts, the same in any order."""
    words = np.random.default_rng(1).integers(0, 40, (5000, 6))
    rows = [(i, ("en", "de", "xx")[0 if i % 3 else 1] if i % 500 else "xx", " ".join(f"w{k + 40 * (i % 4)}" for k in w)) for i, w in enumerate(words.tolist())] + [(-1, "en", ""), (-2, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    topics = mixing.fit_topics(df, "text", "doc_id", "lang")
    held = np.zeros(mixing.FEATURES)
    for _, _, text in rows[:5000]:
        raw = np.frombuffer(text.encode(), np.uint8)
        held[np.unique(mixing.features(mixing.Words(raw, np.array([0, len(raw)]), mixing.SPACE)))] += 1
    assert np.allclose(topics.idf, np.log(5000 / np.maximum(held, 1)) + 1)
    assert topics.centres.shape[1] == mixing.TOPICS and set(topics.taken) == {"en", "de", None}  # 10 texts of xx share the rest's mean
    again = mixing.fit_topics(df.orderBy(F.xxhash64("doc_id")).repartition(7), "text", "doc_id", "lang")
    assert (again.centres == topics.centres).all() and (again.idf == topics.idf).all()


def test_mix_reads_texts_once(spark, sf):
    """Without their texts the same rows are drawn, with the same topics, and from the counts alone; counts of any size."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "text")
    many = spark.createDataFrame([(-k, "s", "en", f"{'often ' * k}seldom") for k in (254, 255, 256, 70_000)] + [(-1, None, None, None)], docs.schema)
    a, b = (mixing.sample(docs.union(many), with_text=w).drop("text") for w in (True, False))
    assert "ArrowEvalPython" in a._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in b._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(a.collect()) == sorted(b.collect()) and a.columns == b.columns
    plan = mixing.op6_mix(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan


def test_counts_are_packed(spark):
    """A row a slice of texts, and the counts of every text come back whole."""
    rows = [(i, "a b " * i + "c") for i in (0, 1, 254, 255, 256, 3000)] + [(7, ""), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("lang", F.lit("en"))
    got = mixing.counted(df, "text", "lang").toArrow().combine_chunks().to_batches()[0]
    at, tf, first = mixing.unpacked(got, 0)
    assert got.num_rows == 1 and np.diff(first).tolist() == [1, 3, 3, 3, 3, 3, 0, 0]
    assert [sorted(tf[first[i] : first[i + 1]].tolist()) for i in range(6)] == [[1]] + [[1, i, i] for i in (1, 254, 255, 256, 3000)]
    assert mixing.packed(got, 0, "n", "<i8").tolist() == [1, 3, 509, 511, 513, 6001, 0, 0]
