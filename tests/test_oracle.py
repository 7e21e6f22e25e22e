"""Every registered query with an oracle agrees with DuckDB at sf0.01; every
query without one at least runs and yields a stable schema."""

import pytest

from cairn.plans import registry
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle import compare

Q = registry.queries()
O = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(O))
def test_matches_oracle(spark, name):
    n, problems = compare(spark, name, Q[name], O[name], SF_ORACLE)
    assert not problems, f"{name}: {problems}"


@pytest.mark.parametrize("name", sorted(set(Q) - set(O)))
def test_rows_only(spark, name):
    df = Q[name](spark, SF_SMALL)
    schema = df.schema
    assert df.count() >= 0
    assert Q[name](spark, SF_SMALL).schema == schema


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 25
