"""Benchmark the headline plans.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 5). Each query: one warm-up (whose shuffle bytes are read
from the event log and reported as ``shuffle_mb``), then the median of
BENCH_REPS timed runs that bring the whole result to the driver as Arrow
batches (``toArrow()``; the baseline timed ``collect()``, whose per-row
Python conversion would dominate these small results).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerwarden.plans.catalog import QUERIES  # noqa: E402
from ledgerwarden.session import build_session, scratch_path  # noqa: E402

# the two SCD2 history builders, plus the CDC merge and the as-of lookup.
HEADLINE = ["rule_passport", "rule_account", "rule_cities", "rule_guessing_3d", "fraud_report",
            "scd2_merge_snapshot", "scd2_merge_cdc", "scd2_from_log", "scd2_as_of", "fraud_report_as_of", "scd2_merge_log",
            "report_incremental"]
#: Plans that write warehouses: fewer repetitions, like the daily run.
WRITING = {"report_incremental"}


def daily_run_once(spark, sf_dir: str) -> None:
    """One full daily run (dimensions, facts, report) into a fresh warehouse
    folder under the shared checkpoint directory."""
    import datetime as dt
    import uuid

    from pyspark.sql import functions as F

    from ledgerwarden.plans.daily import DayFeeds, RunOptions, run_day
    from ledgerwarden.plans.state import Warehouse
    from ledgerwarden.sources import fixtures as fx

    def audited(df):
        return (df.withColumn("create_dt", F.expr("TIMESTAMP_NTZ'2023-12-01 00:00:00'"))
                  .withColumn("update_dt", F.expr("CAST(NULL AS TIMESTAMP_NTZ)")))

    wh = Warehouse(spark, scratch_path(spark, "bench", uuid.uuid4().hex))
    feeds = DayFeeds(
        cards=audited(fx.cards(spark, sf_dir).withColumnRenamed("account_num", "account")),
        accounts=audited(fx.accounts(spark, sf_dir).withColumnRenamed("account_num", "account")),
        clients=audited(fx.clients(spark, sf_dir)), terminals=fx.terminals(spark, sf_dir),
        blacklist=fx.blacklist(spark, sf_dir), transactions=fx.transactions(spark, sf_dir))
    run_day(wh, feeds, dt.datetime(2024, 1, 31, 2, 38), RunOptions(guessing_within="3 days"))


def fraud_report_four_chains(spark, sf_dir: str):
    """The report with the owner chain joined inside each rule (the reference's
    shape), for comparison with the shared single join of ``fraud_report``."""
    from ledgerwarden.operators.report import accumulate
    from ledgerwarden.operators.rules import rule_account, rule_cities, rule_guessing, rule_passport
    from ledgerwarden.plans.catalog import REPORT_DT, _bridge
    from ledgerwarden.sources import fixtures as fx

    tx, term, br = fx.transactions(spark, sf_dir), fx.terminals(spark, sf_dir), _bridge(spark, sf_dir)
    cand = (rule_passport(tx, br, REPORT_DT).unionByName(rule_account(tx, br, REPORT_DT))
            .unionByName(rule_cities(tx, term, br, "1 hour", REPORT_DT))
            .unionByName(rule_guessing(tx, br, "3 days", 3, REPORT_DT)))
    return accumulate(cand)


def shuffle_mb(log_dir: str) -> dict[str, float]:
    """Shuffle bytes written per job description ("warmup:<query>") from the event log."""
    import glob
    import json as js

    try:
        import zstandard
    except ImportError:  # pragma: no cover
        zstandard = None
    desc, out = {}, {}
    for f in sorted(glob.glob(os.path.join(log_dir, "*", "events*")) + glob.glob(os.path.join(log_dir, "*.zstd"))):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            if zstandard is None:
                continue
            raw = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            e = js.loads(line)
            if e["Event"] == "SparkListenerStageSubmitted":
                d = (e.get("Properties") or {}).get("spark.job.description", "")
                desc[e["Stage Info"]["Stage ID"]] = d
            elif e["Event"] == "SparkListenerTaskEnd":
                d = desc.get(e["Stage ID"], "")
                if d.startswith("warmup:"):
                    m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    out[d[7:]] = out.get(d[7:], 0) + m.get("Shuffle Bytes Written", 0)
    return {k: round(v / 1e6, 2) for k, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = [n for n in sys.argv[1:] if n != "daily_run"] or ([] if sys.argv[1:] else HEADLINE)
    import tempfile
    log_dir = tempfile.mkdtemp(prefix="lw-bench-eventlog-")   # local bench only
    spark = build_session(f"local[{cpus}]", app="ledgerwarden-bench", shuffle_partitions=cpus,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    times, rows = {}, {}
    plans = dict(QUERIES)
    if not sys.argv[1:]:
        names = names + ["fraud_report_four_chains"]
        plans["fraud_report_four_chains"] = fraud_report_four_chains
    for name in names:
        q = plans[name]
        spark.sparkContext.setJobDescription(f"warmup:{name}")
        rows[name] = q(spark, sf_dir).toArrow().num_rows
        spark.sparkContext.setJobDescription(None)
        runs = []
        for _ in range(max(1, reps // 2) if name in WRITING else reps):
            t0 = time.perf_counter()
            q(spark, sf_dir).toArrow()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    if not sys.argv[1:] or "daily_run" in sys.argv[1:]:
        daily_run_once(spark, sf_dir)
        runs = []
        for _ in range(max(1, reps // 2)):
            t0 = time.perf_counter()
            daily_run_once(spark, sf_dir)
            runs.append(time.perf_counter() - t0)
        times["daily_run"] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    spark.stop()
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rows": rows, "shuffle_mb": shuffle_mb(log_dir),
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "reps": reps}))


if __name__ == "__main__":
    main()
