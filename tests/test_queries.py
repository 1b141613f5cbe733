"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from tillhouse.plans.oracles import ORACLES
from tillhouse.plans.queries import QUERIES
from compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLES[name]) == ""


def test_entry(spark):
    first = entry.entry(spark).first()
    assert first["amount"] >= 1 and first["product_id"] > first["product_id_2"]
