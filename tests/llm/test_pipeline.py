"""The corpus pipeline, stage by stage against the operators' plain versions."""

import brute
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from vacatia.llm import toxicity
from vacatia.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {"in": docs}
    for name, stage in pipeline.STAGES:
        docs = out[name] = materialize(stage(spark, docs, sf), name)
    return out


def read(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert all(stages[name].columns == COLUMNS for name, _ in pipeline.STAGES[:-1])


def test_toxic_rows_go(spark, sf, stages):
    said = {r["doc_id"] for r in toxicity.op8_toxicity(spark, sf).filter("predicted = 1").collect()}
    assert read(stages["toxicity"]).keys() == read(stages["in"]).keys() - said


def test_one_of_each_class_stays(stages):
    before = read(stages["toxicity"])
    component = brute.components({i: brute.shingles(r["text"], 5) for i, r in before.items()})
    assert read(stages["near_duplicates"]).keys() == {i for i in before if component[i] == i}


def test_benchmark_passages_go(spark, sf, stages):
    items = [brute.words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    keep = set()
    for i, r in read(stages["near_duplicates"]).items():
        doc = brute.words(r["text"])
        grams = {tuple(doc[j : j + 4]) for j in range(len(doc) - 3)}
        if not any(any(tuple(t[j : j + 4]) in grams for j in range(len(t) - 3)) and brute.tiling(doc, t, 4) >= 0.5 * len(t) for t in items):
            keep.add(i)
    assert read(stages["decontamination"]).keys() == keep


def test_secrets_are_replaced(stages):
    before, after = read(stages["decontamination"]), read(stages["secret_scans"])
    assert before.keys() == after.keys()
    marks = ("[ASSIGN]", "[ACCESS]", "[HEX]")
    for i, r in after.items():
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == before[i]["text"] or any(m in r["text"] for m in marks)


def test_sample_and_run(spark, sf, stages):
    got = read(stages["mixing"])
    assert got.keys() <= read(stages["secret_scans"]).keys()
    total = sum(len((r["text"] or "").split()) for r in read(stages["secret_scans"]).values())
    assert 0.3 < sum(r["n_tokens"] for r in got.values()) / total < 0.7
    assert read(pipeline.run(spark, sf)).keys() == got.keys()


def test_empty_table(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("false")
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), name)
    assert docs.count() == 0


def test_odd_rows(spark, sf):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "token = 'abcdefabcdefabcdef12'", None, "a", 5), (3, "word " * 20_000, "en", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), name)
    got = docs.orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3] and got[2]["text"] == "[ASSIGN]'"
