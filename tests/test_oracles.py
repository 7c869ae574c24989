"""Every registered query with an oracle matches its SQL on sf0.001."""

from __future__ import annotations

import pytest

from quire.registry import all_oracles, all_queries
from quire.checks import compare, schema_problems
from tests.conftest import SF_SMALL

ORACLES = all_oracles()
QUERIES = all_queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    got = sdf.toPandas()
    want = duck_small.sql(ORACLES[name]).df()
    problems = schema_problems(sdf, duck_small, ORACLES[name]) + compare(got, want)
    assert not problems, problems
