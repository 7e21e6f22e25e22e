"""Queries with a SQL twin agree with DuckDB at sf0.01; all are registered."""

import re

import pytest

from cairn.llm import queries
from tests.conftest import SF_ORACLE
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_oracle(spark, name):
    n, problems = compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF_ORACLE)
    assert n and not problems, f"{name}: {problems}"


def test_one_query_for_each_operator():
    import __spark_entry__ as entry

    numbers = [int(m[1]) for x in entry.queries() if (m := re.match(r"op(\d+)_", x))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
