"""Transaction files -> typed Parquet fact, once per file (S6, S7, S8, D9 re-aimed).

The reference picks one file by name, rewrites its commas, loads it row by row
and renames it to ``.backup`` after the commit. Here a file stream source does
the bookkeeping: its checkpoint (in the shared checkpoint folder) records
which files were consumed, the Parquet file sink commits each micro-batch
atomically through its own log, and a restart after a lost executor or driver
resumes without loading a file twice. ``availableNow`` processes whatever has
landed and stops, which fits a daily schedule.

Rules need the previous transactions of a card (``lead``/``lag``), which
streams refuse outside time windows, so the report runs on the batch fact
(``plans.daily``); the stream only lands the data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerwarden.schemas import TRANSACTIONS_RAW
from ledgerwarden.session import scratch_path
from ledgerwarden.sources.feeds import TX_SEP, business_date, clean_transactions


def ingest_transactions(spark: SparkSession, source_dir: str, target_dir: str,
                        checkpoint: str | None = None, pattern: str = "*transactions*",
                        max_files_per_trigger: int | None = None):
    """Run an ``availableNow`` stream from ``source_dir`` to ``target_dir``.

    Output rows carry the fact columns plus ``source_file`` and
    ``business_date`` (parsed from the file name); the sink is partitioned by
    ``business_date``. Returns the finished ``StreamingQuery``.
    """
    ckpt = checkpoint or scratch_path(spark, "streams", "transactions")
    reader = (spark.readStream.schema(TRANSACTIONS_RAW).option("header", True).option("sep", TX_SEP)
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir).withColumn("source_file", F.col("_metadata.file_name"))
    typed = clean_transactions(raw, keep=["source_file"]).withColumn(
        "business_date", business_date("source_file"))
    q = (typed.writeStream.format("parquet").option("path", target_dir)
         .option("checkpointLocation", ckpt).partitionBy("business_date")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_on_arrival(spark: SparkSession, source_dir: str, wh, feeds_for=None,
                   checkpoint: str | None = None, run_time=None, options=None,
                   pattern: str = "*transactions*", max_files_per_trigger: int | None = None, undated: str = "raise"):
    """Land what has arrived, then one ``plans.daily.run_day`` per business date.

    A stream lands the files (of all sub-folders) once each, as text with their full
    path, in a folder beside its checkpoint, and notes their names in an index;
    ``max_files_per_trigger`` only throttles that landing. A replayed
    micro-batch writes its own folder again.
    After that the indexed files that the warehouse's ledger does not have are grouped by the
    date in their names, whatever triggers they came in, and run in date
    order; ``feeds_for(date)`` may supply a day's other feeds. Files of a date
    that has been run before are late: they are loaded and reported without
    other feeds and without moving the report date. An arrival with nothing new
    meets file names only; of landed rows, those of new files are read.

    Rows that cannot be typed are refused and kept by the run (``operators.quarantine``).
    A landed file without a date in its name: ``undated="raise"`` raises ``ValueError`` after all
    dated days have run, and its rows stay landed and unconsumed; ``"quarantine"``
    puts its rows among the refused ones, once, and settles the file.
    Returns the finished ``StreamingQuery``.
    """
    import datetime as dt

    from ledgerwarden.plans.daily import DayFeeds, run_day

    if undated not in ("raise", "quarantine"):
        raise ValueError(f"undated is raise or quarantine, not {undated!r}")
    at = run_time or dt.time(2, 38)
    ckpt = checkpoint or scratch_path(spark, "streams", "daily_runs")
    landing, index = f"{ckpt}/landing", f"{ckpt}/arrived"

    reader = (spark.readStream.schema(TRANSACTIONS_RAW).option("header", True).option("sep", TX_SEP)
              .option("pathGlobFilter", pattern).option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir).withColumn("source_file", F.col("_metadata.file_path"))

    def land(batch, epoch_id):
        folder = f"{landing}/epoch={epoch_id}"
        batch.write.mode("overwrite").parquet(folder)
        name = F.element_at(F.split("source_file", "/"), -1)
        files = batch.sparkSession.read.schema("source_file string").parquet(folder).distinct()
        (files.select(F.col("source_file").alias("path"), business_date(name).alias("business_date"),
                      F.lit(folder).alias("folder")).coalesce(1).write.mode("overwrite").parquet(f"{index}/epoch={epoch_id}"))

    q = raw.writeStream.foreachBatch(land).option("checkpointLocation", f"{ckpt}/stream").trigger(availableNow=True).start()
    q.awaitTermination()

    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(index)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return q                                   # nothing has ever arrived
    arrived = spark.read.schema("path string, business_date date, folder string").parquet(index)
    prev = wh.latest()
    settled = wh.known_files(prev, arrived.select("path")).distinct()
    fresh = arrived.join(settled, "path", "left_anti").collect()              # the files that are new
    if not fresh:
        return q
    days = sorted({r.business_date for r in fresh if r.business_date is not None})
    name = F.element_at(F.split("path", "/"), -1)
    ledger = wh.ledger_rows(prev).select(F.coalesce("business_date", business_date(name)).alias("day"))
    ran = {r.day for r in ledger.where(F.col("day").isin(days)).distinct().collect()} if days else set()
    raw_schema = f"{TRANSACTIONS_RAW.simpleString()[len('struct<'):-1].replace(':', ' ').replace(',', ', ')}, source_file string"

    def rows_of(files):
        folders = sorted({r.folder for r in files})
        rows = spark.read.schema(raw_schema).parquet(*folders)
        return rows.where(F.col("source_file").isin([r.path for r in files])).select(*TRANSACTIONS_RAW.fieldNames())

    for day in days:
        own = sorted((r for r in fresh if r.business_date == day), key=lambda r: r.path)
        late = day in ran
        feeds = feeds_for(day) if feeds_for and not late else DayFeeds()
        feeds.transactions, feeds.transactions_raw = None, rows_of(own)
        feeds.files = [r.path for r in own]
        feeds.dates = {r.path: day for r in own}
        last = wh.latest().run_ts
        when = dt.datetime.combine(day + dt.timedelta(days=1), at)
        if late and last:
            when = max(when, dt.datetime.fromisoformat(last))
        run_day(wh, feeds, when, options, advance=not late)
    without = sorted((r for r in fresh if r.business_date is None), key=lambda r: r.path)
    if without and undated == "raise":
        raise ValueError(f"{len(without)} landed files have no business date in their names, "
                         f"e.g. {[r.path for r in without[:3]]}")
    if without:
        _quarantine_files(wh, rows_of(without), [r.path for r in without])
    return q


def _quarantine_files(wh, rows, paths: list[str]) -> None:
    """A run that only moves the rows of files without a date among the refused ones and settles the files."""
    import datetime as dt

    from ledgerwarden.operators.quarantine import refused_rows
    from ledgerwarden.plans.state import next_manifest
    from ledgerwarden.schemas import TRANSACTIONS_FACT

    prev = wh.latest()
    m = next_manifest(prev, dt.datetime.fromisoformat(prev.run_ts) if prev.run_ts else dt.datetime(1970, 1, 1))
    wh.append_fact(m, "transactions", wh.spark.createDataFrame([], TRANSACTIONS_FACT),
                   refused_rows(rows, "undated_file", "transactions"))
    wh.settle_files(m, [(p, None) for p in paths], "undated")
    wh.settle_counts(m)
    wh.publish(m)
