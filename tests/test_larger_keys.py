"""Queries on tables whose keys are larger than the width of a code, so that units share geocodes."""

import duckdb
import pytest

from tessera import plans
from tests.conftest import SF
from tests.test_queries import TABLES, rows


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    """The smallest tables with their customers repeated under keys of seven digits, and SQL over them."""
    folder = tmp_path_factory.mktemp("large")
    c = duckdb.connect()
    for t in TABLES:
        if t in ("customer", "orders"):
            key, copies = ("c_custkey", 2) if t == "customer" else ("o_custkey", 1)
            moved = f"1000000 + {key} * 100 + {key} % 10 + i * 50 as {key}"
            c.sql(f"copy (select * exclude(i) replace({moved}) from '{SF}/{t}.parquet', (select unnest(range({copies})) as i)) to '{folder}/{t}.parquet' (format parquet)")
        else:
            (folder / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
        c.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c, str(folder)


@pytest.mark.parametrize("name", ["geo_restore_block_code", "spine_tribal_hierarchy"])
def test_units_that_share_a_code_keep_their_own_row(spark, large, name):
    con, folder = large
    assert con.sql(f"select max(n) from (select count(*) as n from ({plans.ORACLES['spine_tribal_hierarchy']}) group by geocode)").fetchall()[0][0] > 1
    assert rows(plans.QUERIES[name](spark, folder).toPandas()) == rows(con.sql(plans.ORACLES[name]).df())
