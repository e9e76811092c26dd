"""Each dealt query that SQL can express against its twin on the smallest tables."""

import oracle
import pytest

from gleaner.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    message, ok = oracle.compare(spark, oracle.connect(sf_dir), name, sf_dir, QUERIES, ORACLES)
    assert ok and "EMPTY" not in message, message


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
