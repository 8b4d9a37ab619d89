"""Every registered query against its SQL counterpart on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import rows_of

TEXTS = entry.oracle_sql()
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_but_the_model_fits_has_sql():
    assert set(entry.QUERIES) - set(TEXTS) == ROWS_ONLY and not set(TEXTS) - set(entry.queries())


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, con, sf_dir, name):
    frame = entry.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    assert got[1]
    if name in TEXTS:
        cursor = con.execute(TEXTS[name])
        assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
