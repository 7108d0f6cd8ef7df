"""ledgerwarden: a Spark-native versioned warehouse (SCD2) and fraud mart.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
native joins, aggregates, windows and expressions; only ``plans.state``,
``plans.daily`` and ``streaming`` write anything.
"""

from ledgerwarden.operators.facts import append_new, append_unique
from ledgerwarden.operators.keys import keys_absent
from ledgerwarden.operators.owner import OwnerAsOf, owner_bridge
from ledgerwarden.operators.report import accumulate, fraud_report
from ledgerwarden.operators.rules import (
    all_rules,
    rule_account,
    rule_cities,
    rule_guessing,
    rule_passport,
)
from ledgerwarden.operators.scd2 import (
    cogroup_snapshot,
    initial_history,
    scd2_as_of,
    scd2_check,
    scd2_from_log,
    scd2_from_snapshots,
    scd2_merge,
    scd2_merge_snapshot,
)
from ledgerwarden.operators.versions import resolve, validity
from ledgerwarden.session import build_session, checkpoint_dir

__all__ = [
    "OwnerAsOf", "accumulate", "all_rules", "append_new", "append_unique", "build_session",
    "checkpoint_dir", "cogroup_snapshot", "fraud_report", "initial_history", "keys_absent",
    "owner_bridge", "resolve", "rule_account", "rule_cities", "rule_guessing", "rule_passport",
    "scd2_as_of", "scd2_check", "scd2_from_log", "scd2_from_snapshots", "scd2_merge",
    "scd2_merge_snapshot", "validity",
]
