"""Every registered query against its SQL twin, on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
from workloads import REGISTRY  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, name):
    good, text = compare.compare(spark, name, SF)
    # At this size some results are legitimately empty on both sides.
    assert good or text.startswith("0 rows"), text


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert len(frame.columns) == 34 and frame.count() > 0
