"""Every registered query of the library against its SQL on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tessera import plans
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)]
    out = []
    for r in frame.astype(object).itertuples(index=False):
        out.append(tuple(None if pd.isna(v) else round(float(v), 6) + 0.0 if isinstance(v, (int, float, np.number)) else str(v) for v in r))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_matches_sql(spark, con, name):
    got, want = plans.QUERIES[name](spark, SF).toPandas(), con.sql(plans.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
