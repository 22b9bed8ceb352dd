"""Every named query against its SQL statement, on whole tables."""

import re
from pathlib import Path

import pytest
from compare import connect, difference
from oracle.queries import ORACLES
from tallyworks.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


def test_statements_stand_on_their_own():
    for path in Path(__file__).parents[1].glob("oracle/*.py"):
        assert not re.search(r"(import|from) tallyworks", path.read_text())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert difference(result, duck, ORACLES[name]) is None
