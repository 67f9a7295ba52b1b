"""Queries against their SQL on odd rows."""

import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows_of

import __spark_entry__


def both(spark, folder, query, **tables):
    """Rows of a query and of its SQL over the given tables."""
    duck = duckdb.connect()
    for name, t in tables.items():
        pq.write_table(t, folder / f"{name}.parquet")
        duck.execute(f"create view {name} as select * from '{folder / name}.parquet'")
    return rows_of(__spark_entry__.queries()[query](spark, str(folder)).toPandas()), rows_of(duck.execute(__spark_entry__.oracle_sql()[query]).df())


def test_language_stopwords(spark, tmp_path):
    texts = [None, "", "123", "abc1 x9", "_a_", "cho thue nha", "trong kinh doanh", "trońg chó kinh́", "cho1 trong2 x", "KİNH TRONG", "Mức", "中文", "trong中 cho中 a", "đ", "hello there"]
    got, want = both(spark, tmp_path, "language_stopwords", documents=pa.table({"doc_id": range(len(texts)), "text": texts}))
    assert got == want


NAMES = ["red ring", "ring red", "red  ring", "blue bolt", "red ring cap", "", None, "a b c d e f g h", "a b c d e f g"]


@pytest.mark.parametrize("query", ["fuzzy_pairs_jaccard", "tfidf_pairs"])
def test_pairs_of_copies(spark, tmp_path, query):
    """Copies, an id that repeats, rows without a brand; and no pair of rows is shuffled or counted, only pairs of classes."""
    rows = [(i, NAMES[i % 9] if NAMES[i % 9] != "red  ring" else "ring cap", None if i % 17 == 5 else f"Brand#{i % 2}", "LARGE" if i % 4 else "SMALL") for i in range(180)]
    rows += [r for r in rows[:40] if r[1]] if query == "fuzzy_pairs_jaccard" else []
    part = pa.table(dict(zip(["p_partkey", "p_name", "p_brand", "p_type"], map(list, zip(*[r for r in rows if r[1]], strict=True)), strict=True)))
    got, want = both(spark, tmp_path, query, part=part)
    assert got == want and len(got) > 100
    plan = __spark_entry__.queries()[query](spark, str(tmp_path))._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"a#\d+L? < b#\d+L?", plan).start() < plan.index("Aggregate")
