"""Queries of this subpackage against their DuckDB SQL."""

import pytest

from loomtrace.llm.queries import ORACLES, QUERIES

from tests.llm.helpers import same_as_duckdb


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    same_as_duckdb(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)


def test_each_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
