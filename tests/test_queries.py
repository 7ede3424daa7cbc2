"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from check import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, sf_dir, name):
    same, message = compare(spark, con, name, sf_dir)
    assert same, message


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
