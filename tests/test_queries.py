"""Every registered engine query with SQL, against that SQL in DuckDB."""

import os

import duckdb
import pandas as pd
import pytest

from sluice.plans import extensions  # noqa: F401  registers its queries, too
from sluice.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def text(v):
    if hasattr(v, "__len__") and not isinstance(v, str):
        return str([int(x) if hasattr(x, "item") else x for x in v])
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return "null"
    out = f"{v:.6g}" if isinstance(v, float) else str(v)
    return out.removesuffix(".0")


def rows(frame):
    return sorted(tuple(map(text, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_gives_what_its_sql_gives(spark, sql, name):
    got, want = registry.QUERIES[name](spark, DATA).toPandas(), sql.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
