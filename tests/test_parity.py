"""Every named query against its SQL form on the smallest tables."""

import sys

import pytest

import __spark_entry__ as entry_module
from tests.conftest import DATA

sys.path.insert(0, "scripts")
from scripts.compare import compare  # noqa: E402

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "signal_id" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(name, spark, duck):
    _, result = compare(spark, duck, name, QUERIES[name], ORACLES.get(name), DATA)
    assert result.startswith(("ok", "rows only")), result
