"""Every registered query against its SQL oracle."""

import pytest

import __spark_entry__ as entry_module
from oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    """But for those of the training-data operators that SQL cannot express."""
    with_oracle = entry_module.oracle_sql().keys()
    assert with_oracle <= entry_module.queries().keys()
    for name in entry_module.queries().keys() - with_oracle:
        assert name == "pipeline" or name.startswith("op"), name


@pytest.mark.parametrize("name", entry_module.oracle_sql())
def test_query_equals_oracle(spark, tables, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    assert difference(result, tables, entry_module.oracle_sql()[name]) is None


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["query", "uri", "score", "score_text"]
    assert 0 < result.count() <= 20 * len(entry_module.WORDS)
