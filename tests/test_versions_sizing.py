"""Version resolution modes and the broadcast size bound."""

import datetime as dt

from ledgerwarden.operators.sizing import broadcast_if_small, measured_bytes
from ledgerwarden.operators.versions import resolve, validity
from ledgerwarden.schemas import CARDS_HIST

T = dt.datetime
FF = dt.datetime(9999, 12, 31)


def hist(spark):
    return spark.createDataFrame([
        ("C1", "A1", T(2024, 1, 1), T(2024, 1, 9, 23, 59, 59), "N"),
        ("C1", "A2", T(2024, 1, 10), FF, "N"),
        ("C2", "A3", T(2024, 1, 1), T(2024, 1, 4, 23, 59, 59), "N"),
        ("C2", "A3", T(2024, 1, 5), FF, "Y")], CARDS_HIST)


def test_resolve_modes(spark):
    h = hist(spark)
    assert resolve(h, "all").count() == 4
    assert sorted(r.account_num for r in resolve(h, "current").collect()) == ["A2"]
    assert resolve(h, "live").count() == 3
    at = sorted(r.account_num for r in resolve(h, "as_of", T(2024, 1, 3)).collect())
    assert at == ["A1", "A3"]
    assert sorted(r.account_num for r in resolve(h, "as_of", T(2024, 1, 6)).collect()) == ["A1"]


def test_validity_half_open_and_extended(spark):
    rows = {(r.account_num): (r._valid_from, r._valid_until)
            for r in validity(hist(spark), ["card_num"], extend_first=True).collect()}
    assert rows["A1"] == (T(1, 1, 1), T(2024, 1, 10))
    assert rows["A2"] == (T(2024, 1, 10), FF)
    assert "Y" not in [r.delete_flg for r in validity(hist(spark), ["card_num"]).collect()]


def test_broadcast_bound(spark):
    df = spark.createDataFrame([("x" * 10, 1), ("y" * 30, 2)], "s string, n long")
    assert measured_bytes(df) == 2 * (8 + 30 + 24)
    hinted = broadcast_if_small(df, max_bytes=1 << 20)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(df, max_bytes=10)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()
