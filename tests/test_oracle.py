"""Every query with SQL gives DuckDB's rows; the others give rows with a stable schema."""

import duckdb
import pandas as pd
import pytest

from stemfold.plans import QUERIES, SQL
from tests.conftest import TINY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TINY}/{t}.parquet'")
    return con


def rows(df):
    def text(v):
        if pd.isna(v):
            return "~"
        if isinstance(v, bool) or hasattr(v, "dtype") and v.dtype == bool:
            return str(bool(v))
        try:
            return f"{float(v):.9g}"
        except (TypeError, ValueError):
            return str(v)

    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(text(v) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, TINY).toPandas()
    assert len(got.columns)
    if name in SQL:
        assert rows(got) == rows(duck.execute(SQL[name]).fetchdf())
