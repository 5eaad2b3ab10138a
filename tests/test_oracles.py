"""Every registered query of the engine against its SQL on the smallest tables."""

import duckdb
import pytest

from kinweave.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    cell = lambda v: f"{v:.5f}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(v) for v in r) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def db(tiny):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, tiny, db, name):
    got, want = catalog.queries()[name](spark, tiny).toPandas(), db.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
