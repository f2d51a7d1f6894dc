import re

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.CORPUS_SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert compare(spark, con, sf, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_one_query_for_each_operator():
    numbers = [re.match(r"op(\d+)_", n) for n in entry.CORPUS if n != "pipeline"]
    assert sorted(int(m[1]) for m in numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
