"""Every named query against its SQL twin on the smallest tables."""

import duckdb
import oracle
import pytest

from gleaner.catalog import load

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, sf_dir, con, name):
    message, ok = oracle.compare(spark, con, name, sf_dir, QUERIES, ORACLES)
    assert ok, message
    assert "EMPTY" not in message


def test_every_sql_parses():
    for name, sql in ORACLES.items():
        assert duckdb.extract_statements(sql), name
