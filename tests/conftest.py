import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hiresight.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="hiresight-tests",
                      extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from hiresight.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def one_col(spark, values, expr, dtype="string"):
    """Evaluate a Column function over a small list of inputs."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r["y"] for r in df.select("i", expr("x").alias("y")).orderBy("i").collect()]
