"""Every catalogue query with oracle SQL agrees with DuckDB on sf0.001."""

import os

import duckdb
import pytest

from lifetab.plans import catalog
from lifetab.plans.tables import TABLES

from .conftest import SF


def _canon(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 6) + 0.0)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = catalog.QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_canon(r[c]) for c in cols) for r in sdf.collect())
    rel = con.execute(catalog.SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    drows = sorted(tuple(_canon(r[idx[c]]) for c in cols) for r in rel.fetchall())
    assert srows == drows
