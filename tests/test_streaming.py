"""availableNow ingest: each landed file is loaded once, across restarts."""

import os
from decimal import Decimal

import pytest

from ledgerwarden.plans.daily import RunOptions
from ledgerwarden.plans.state import Warehouse
from ledgerwarden.schemas import TRANSACTIONS_FACT
from ledgerwarden.streaming import ingest_transactions, run_on_arrival

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + "".join(rows))


def test_files_loaded_once(spark, scratch):
    src, out, ck = scratch + "/in", scratch + "/out", scratch + "/ckpt"
    land(src, "transactions_01032021.txt", ["1;2021-03-01 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    land(src, "transactions_02032021.txt", ["2;2021-03-02 10:00:00;7,25;C2;PAYMENT;REJECT;T1\n"])
    ingest_transactions(spark, src, out, ck)
    ingest_transactions(spark, src, out, ck)          # nothing new: no duplicates
    land(src, "transactions_03032021.txt", ["3;2021-03-03 10:00:00;1,00;C3;WITHDRAW;SUCCESS;T2\n"])
    land(src, "terminals_03032021.txt", ["x;y;z;w\n"])  # other feed: ignored
    ingest_transactions(spark, src, out, ck)
    rows = sorted((r.trans_id, r.amt, str(r.business_date)) for r in spark.read.parquet(out).collect())
    assert rows == [("1", Decimal("10.5"), "2021-03-01"), ("2", Decimal("7.25"), "2021-03-02"),
                    ("3", Decimal(1), "2021-03-03")]


def test_daily_runs_on_arrival(spark, scratch):
    src, ck = scratch + "/in", scratch + "/ckpt"
    wh = Warehouse(spark, scratch + "/wh")
    opt = RunOptions()
    land(src, "transactions_02032021.txt", ["2;2021-03-02 10:00:00;7,25;C2;PAYMENT;REJECT;T1\n"])
    land(src, "transactions_01032021.txt", ["1;2021-03-01 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    run_on_arrival(spark, src, wh, checkpoint=ck, options=opt)
    m = wh.latest()
    assert m.run_id == 2 and [f.rsplit("/", 1)[1] for f in m.consumed_files] == [
        "transactions_01032021.txt", "transactions_02032021.txt"]
    run_on_arrival(spark, src, wh, checkpoint=ck, options=opt)      # nothing new
    assert wh.latest().run_id == 2
    land(src, "transactions_03032021.txt", ["3;2021-03-03 10:00:00;1,00;C3;WITHDRAW;SUCCESS;T2\n"])
    run_on_arrival(spark, src, wh, checkpoint=ck, options=opt)
    m = wh.latest()
    assert m.run_id == 3 and m.run_ts == "2021-03-04 02:38:00"
    assert sorted(r.trans_id for r in wh.fact(m, "transactions", TRANSACTIONS_FACT).collect()) == ["1", "2", "3"]


@pytest.mark.parametrize("cap", [1, 2, 1000])
def test_file_cap_only_throttles(spark, scratch, cap):
    src = f"{scratch}/in{cap}"
    for i in range(3):
        land(f"{src}/d={'abc'[i]}", "transactions_01032021.txt",      # one name in three folders, one business day
             [f"{i};2021-03-01 1{i}:00:00;10,5;C{i};PAYMENT;SUCCESS;T1\n"])
    wh = Warehouse(spark, f"{scratch}/wh{cap}")
    run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck{cap}", max_files_per_trigger=cap)
    m = wh.latest()
    assert (m.run_id, m.report_date, len(m.consumed_files)) == (1, "2021-03-02", 3)
    assert sorted(r.trans_id for r in wh.fact(m, "transactions", TRANSACTIONS_FACT).collect()) == ["0", "1", "2"]
    land(f"{src}/d=late", "transactions_01032021.txt", ["9;2021-03-01 09:00:00;1,5;C9;PAYMENT;SUCCESS;T1\n"])
    run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck{cap}", max_files_per_trigger=cap)
    late = wh.latest()
    assert (late.run_id, late.report_date, len(late.consumed_files)) == (2, "2021-03-02", 4)
    assert wh.fact(late, "transactions", TRANSACTIONS_FACT).count() == 4


def test_undated_file_fails_loudly(spark, scratch):
    src = f"{scratch}/in"
    land(src, "transactions_extra.txt", ["1;2021-03-01 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    land(src, "transactions_01032021.txt", ["2;2021-03-01 10:00:00;10,5;C1;PAYMENT;SUCCESS;T1\n"])
    wh = Warehouse(spark, f"{scratch}/wh")
    for _ in range(2):                        # and again on the next call: the rows are not forgotten
        with pytest.raises(ValueError, match="transactions_extra"):
            run_on_arrival(spark, src, wh, checkpoint=f"{scratch}/ck")
    assert wh.latest().run_id == 1
