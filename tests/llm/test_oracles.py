"""Queries that SQL can express equal their DuckDB SQL."""

import pytest

from quire.checks import duck_connection, schema_problems
from quire.llm.oracles import ORACLE
from quire.llm.queries import QUERIES
from tests.llm.common import collected, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duck_connection(SF)
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert schema_problems(df, con, ORACLE[name]) == []
    assert collected(df) == table(con.execute(ORACLE[name]).fetchall(), columns)
