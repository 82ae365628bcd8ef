"""Registered queries against their SQL twins at the smallest scale.

ALL_QUERIES=1 runs every query; by default a spread of quick ones.
"""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, open_tables

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "band_route",
    "batch_assign",
    "export_json_lines",
    "gnb_fit",
    "latest_decision",
    "matching_words",
    "missing_patterns",
    "page_script_extract",
    "solve_puzzle",
    "threshold_grid",
    "wordlist_scan",
]
NAMES = sorted(entry.queries()) if os.environ.get("ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def con():
    return open_tables(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert compare(spark, con, name, entry.queries()[name], sql, SF_DIR) is None


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
