"""Every registered query of the library against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from strandline import registry
from tests.conftest import SF

_seen: dict = {}
NAMES = [n for n, f in registry.QUERIES.items() if _seen.setdefault((f, registry.ORACLE.get(n)), n) == n]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def shown(x):
    if pd.api.types.is_scalar(x) and pd.isna(x):
        return "null"
    if hasattr(x, "isoformat"):
        return pd.Timestamp(x).isoformat()
    return f"{float(x):.9g}" if isinstance(x, (bool, int, float)) or hasattr(x, "dtype") else str(x)


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(map(shown, r)) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name not in registry.ORACLE:
        assert len(got)
        return
    want = duck.execute(registry.ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
