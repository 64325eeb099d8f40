"""The registered queries: contract checks, and a few oracles end to end.

``python tests/oracle.py 0.01`` compares every query with its SQL.
"""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from oracle import compare, connect  # noqa: E402

SMALL = "/root/testdata/sf0.001"
CHOSEN = ["impute_linear", "sliding_windows", "knn_accuracy", "lof_score", "incident_detection", "interval_recall", "verdict_summary"]

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 90


@needs_data
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns and df.count() >= 0


@needs_data
@pytest.mark.parametrize("name", CHOSEN)
def test_against_sql(spark, name):
    problem, _ = compare(spark, connect(SMALL), contract.queries()[name], contract.oracle_sql()[name], SMALL)
    assert problem is None
