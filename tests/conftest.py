import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("local[4]", 4, **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def same_as_sql(spark):
    """Asserts that a query and its SQL give the same rows over the smallest test tables."""
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{folder}/{f}'")

    def plain(v):
        import pandas as pd

        if pd.isna(v):
            return ""
        return f"{v:.6f}" if isinstance(v, float) and v != int(v) else str(int(v)) if isinstance(v, (int, float)) else str(v)

    def check(query, sql):
        mine, theirs = query(spark, folder).toPandas(), con.sql(sql).df()
        columns = sorted(mine.columns)
        assert columns == sorted(theirs.columns)
        rows = lambda d: sorted(tuple(plain(v.item() if hasattr(v, "item") else v) for v in r) for r in d[columns].astype(object).itertuples(index=False))
        assert rows(mine) == rows(theirs)

    return check
