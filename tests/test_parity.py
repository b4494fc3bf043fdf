"""Every registered query against its DuckDB SQL on the same tables."""

import pytest

from oracle_check import compare, duck
from snapweave.oracle import ORACLE
from snapweave.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con)
    if name not in ORACLE:
        assert res["spark_rows"] >= 0
        return
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["match"], res
