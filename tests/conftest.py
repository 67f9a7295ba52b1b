import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# executors' Python workers import the package too
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows_of(frame):
    """Rows as sorted tuples that compare across engines: floats rounded, whole floats as ints, nulls as None."""

    def norm(v):
        if v is None or v != v:
            return "None"
        if isinstance(v, bool):
            return str(v)
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            v = round(v, 6)
            return str(int(v)) if v == int(v) else str(v)
        return str(v)

    cols = sorted(frame.columns)
    return sorted(tuple(norm(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False))


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return lambda sql: c.execute(sql).df()
