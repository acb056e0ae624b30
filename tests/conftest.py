import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="spark-")
    os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.local.dir", scratch)
        .config("spark.checkpoint.dir", f"file://{scratch}/checkpoints").config("spark.sql.warehouse.dir", f"{scratch}/warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows_of(frame):
    """Rows as sorted tuples of text, columns by name."""
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v):
            return "~"
        if isinstance(v, float) or (hasattr(v, "dtype") and v.dtype.kind == "f"):
            return f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(cell(v) for v in r) for r in frame.itertuples(index=False))


def same(spark_frame, duck_frame):
    a, b = spark_frame.toPandas(), duck_frame
    assert sorted(a.columns) == sorted(b.columns)
    for c in a.columns:  # whole numbers beside nulls become floats in pandas
        if {a[c].dtype.kind, b[c].dtype.kind} <= set("iuf") and a[c].dtype != b[c].dtype:
            a[c], b[c] = a[c].astype(float), b[c].astype(float)
    assert rows_of(a) == rows_of(b)


@pytest.fixture(scope="session")
def check_same():
    return same
