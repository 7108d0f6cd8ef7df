"""Plan shape: no pairs, no Python, anti joins where the semantics say so."""

import re

import pytest

from conftest import SF_SMALL
from ledgerwarden.plans.catalog import QUERIES


def plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_python(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_anti_joins(spark):
    assert "LeftAnti" in plan(spark, "report_next_day")
    assert "LeftAnti" in plan(spark, "blacklist_append")
    null_aware = plan(spark, "not_in_null_aware")        # an ordinary anti join beside a counted state
    assert "LeftAnti" in null_aware and not re.search(r"LeftAnti.*, true\b", null_aware)


def test_guessing_lags_share_one_window(spark):
    p = plan(spark, "rule_guessing")
    assert len(re.findall(r"\bWindow \[", p)) == 1


def test_report_joins_bridge_once(spark):
    p = plan(spark, "fraud_report")
    # cards, accounts, clients, blacklist: each customer-derived scan appears once
    assert len(re.findall(r"FileScan parquet \[c_custkey", p)) <= 4


def test_sequence_windows_are_split_by_time(spark):
    """Skew safety reaches the physical plan: windows never partition by the card / key alone."""
    for name in ("rule_cities", "rule_guessing_3d"):
        p = plan(spark, name)
        assert re.search(r"Exchange hashpartitioning\(card_num#\d+, _band#\d+L?", p)
        assert not re.search(r"Window \[[^\n]*windowspecdefinition\(card_num#\d+, [a-z_]+#\d+ ASC", p)
    p = plan(spark, "scd2_from_log")
    assert re.search(r"hashpartitioning\(o_custkey#\d+L?, _bk#\d+L?", p)
