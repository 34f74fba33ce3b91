import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="tests-")
    builder = SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    builder = builder.config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{folder}/shared").config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(SMALL)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return con


def same(df, rel) -> None:
    """A DataFrame and a DuckDB relation have the same columns and rows, in any order."""
    columns = sorted(df.columns)
    assert sorted(rel.columns) == columns
    at = [list(rel.columns).index(c) for c in columns]

    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    a = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    b = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert a == b
