from __future__ import annotations

import pytest
from compare import difference, tables

from orderwatch.plans.answers import ANSWERS
from orderwatch.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return tables(sf_dir)


def test_every_query_has_an_answer():
    assert QUERIES.keys() == ANSWERS.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ANSWERS[name]) is None
