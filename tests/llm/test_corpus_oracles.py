"""The corpus queries that have SQL, against it."""

import duckdb
import pytest

from kinweave.llm import queries


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(str, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, tiny, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    got, want = queries.queries()[name](spark, tiny).toPandas(), db.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
