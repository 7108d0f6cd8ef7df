"""Run state on plain Parquet: immutable run directories + a log of runs.

Parquet has no UPDATE/MERGE, so a history is split into
``<table>/run=<id>-<attempt>/_part=closed`` (append-only closed versions) and
``<table>/run=<id>-<attempt>/_part=current`` (the open rows, rewritten by each
run that touches the table). Facts and the report append one directory per
run; transactions and the report are partitioned by day (``day=<date of the event>``)
inside it. A run writes all of its directories first and its record
``_runs/<id>.json`` last; readers follow the newest record and read only the
folders it leads to, so an unfinished attempt is invisible and its retry (a new
attempt token) writes beside it. Two attempts racing for one run id cannot
both publish: the record is created without overwrite. Nothing is read and overwritten in
the same job. All paths go through the Hadoop file system of the root, so a
shared folder (HDFS, object store) works the same as a local one.

A record holds what its run changed (folders added and dropped), so its size
does not grow with the number of runs. Every ``CHECKPOINT_EVERY`` runs the whole
state is written beside it; a reader starts from the last whole state and
applies the records after it. The files that runs have consumed are rows of a
ledger, the table ``files``; what runs refused are the rows of ``rejected``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwarden.functions.columns import is_open
from ledgerwarden.schemas import (
    SEED_REPORT_DATE,
    SEED_WATERMARK_ACCOUNTS,
    SEED_WATERMARK_CARDS,
    SEED_WATERMARK_CLIENTS,
)

PART = "_part"
DAY = "day"
DAILY = {"transactions": "trans_date", "report": "event_dt"}   # facts written by day, and the time that gives the day


#: Why a row is refused (or, for ``rounded_amount``, loaded with a loss and kept as it came, too).
REASONS = ("null_key", "null_time", "unreadable_time", "unreadable_amount", "rounded_amount", "undated_file")
#: Runs between two whole states.
CHECKPOINT_EVERY = 16
LOADED, LEDGER, REJECTED = "loaded", "files", "rejected"
FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("business_date", T.DateType()),
                      T.StructField("run_id", T.LongType()), T.StructField("place", T.IntegerType()),
                      T.StructField("status", T.StringType())])


@dataclass
class Manifest:
    """The state after a run. ``base`` is the state it was made from, ``ledger`` reads its consumed files."""
    run_id: int
    parent: int | None
    run_ts: str
    report_date: str
    watermarks: dict[str, str]
    tables: dict[str, dict] = field(default_factory=dict)
    attempt: str = ""
    report_basis: str = ""      # the options the report was built with; other options need a full rescan
    counts: dict[str, dict] = field(default_factory=dict)      # per feed of this run: rows loaded and refused, by reason
    indexed: bool = False       # every transaction is in the day index (``plans.incremental``)
    old_files: list[str] = field(default_factory=list)         # consumed before there was a ledger
    base: dict | None = field(default=None, repr=False, compare=False)
    ledger: object = field(default=None, repr=False, compare=False)

    def folder(self) -> str:
        """This attempt's folder name: a retried run never meets a crashed one's files."""
        return f"run={self.run_id:09d}-{self.attempt}"

    @staticmethod
    def seed() -> "Manifest":
        return Manifest(run_id=0, parent=None, run_ts="", report_date=SEED_REPORT_DATE.isoformat(),
                        watermarks={"cards": SEED_WATERMARK_CARDS.isoformat(sep=" "),
                                    "accounts": SEED_WATERMARK_ACCOUNTS.isoformat(sep=" "),
                                    "clients": SEED_WATERMARK_CLIENTS.isoformat(sep=" ")}, indexed=True)

    @property
    def consumed_files(self) -> list[str]:
        """Every consumed file, for inspection; runs ask the ledger for their own files only."""
        return self.old_files + (self.ledger.consumed(self) if self.ledger else [])

    def _small(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("tables", "base", "ledger", "old_files")}

    def to_json(self) -> str:
        """The whole state."""
        return json.dumps({**self._small(), "tables": self.tables, "old_files": self.old_files}, indent=1, sort_keys=True)

    def record(self) -> str:
        """What the run changed: per table and list of folders, those added and dropped; single values as they are."""
        changes: dict[str, dict] = {}
        before = self.base or {}
        for name, now in self.tables.items():
            old = before.get(name, {})
            for key, value in now.items():
                if isinstance(value, list):
                    was, has = set(old.get(key, [])), set(value)
                    step = {"add": [p for p in value if p not in was], "drop": sorted(was - has)}
                    if step["add"] or step["drop"] or key not in old:
                        changes.setdefault(name, {})[key] = step
                elif old.get(key) != value or key not in old:
                    changes.setdefault(name, {})[key] = {"set": value}
        return json.dumps({**self._small(), "changes": changes}, indent=1, sort_keys=True)

    def after(self, rec: dict) -> "Manifest":
        """The state after the record ``rec``, whose parent this is."""
        tables = json.loads(json.dumps(self.tables))
        for name, keys in rec["changes"].items():
            t = tables.setdefault(name, {})
            for key, step in keys.items():
                if "set" in step:
                    t[key] = step["set"]
                else:
                    drop = set(step["drop"])
                    t[key] = [p for p in t.get(key, []) if p not in drop] + step["add"]
        return Manifest(**{k: v for k, v in rec.items() if k != "changes"}, tables=tables, old_files=list(self.old_files))

    @staticmethod
    def from_json(text: str) -> "Manifest":
        """A whole state; one written before there was a ledger lists its files itself."""
        told = json.loads(text)
        return Manifest(**{k: v for k, v in told.items() if k != "consumed_files"},
                        **({"old_files": told["consumed_files"]} if "consumed_files" in told else {}))


def observed(seen: Observation) -> dict:
    """The metrics of a finished observation; none where the plan turned out empty and observed nothing."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {}


class Warehouse:
    """Tables under ``root``; state = the newest manifest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._seen: list[tuple] = []            # observations of writes not yet settled
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- manifests ---------------------------------------------------------------------------
    def _runs_dir(self):
        return self._Path(f"{self.root}/_runs")

    def latest(self) -> Manifest:
        """The state of the newest run that can be read back to a whole state; broken records at the end are skipped."""
        d = self._runs_dir()
        if not self._fs.exists(d):
            return Manifest.seed()
        ids = [int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(d)
               if s.getPath().getName().endswith(".json")]
        found = (self.state(i) for i in sorted(ids, reverse=True))
        return next((m for m in found if m is not None), None) or Manifest.seed()

    def state(self, run_id: int, checkpoints: bool = True) -> Manifest | None:
        """The state after a run, from the last whole state and the records since; None where one is broken."""
        chain: list[dict] = []
        while True:
            if run_id == 0:
                m = Manifest.seed()
                break
            told = self._parsed(run_id)
            if told is None:
                return None
            if "tables" in told:                            # a run's file from before records is a whole state
                m = Manifest.from_json(json.dumps(told))
                break
            whole = self._checkpoint(told) if checkpoints else None
            if whole is not None:
                m = whole
                break
            chain.append(told)
            run_id = told["parent"] or 0
        for told in reversed(chain):
            m = m.after(told)
        m.ledger = self
        return m

    def _manifest_path(self, run_id: int):
        return self._Path(f"{self.root}/_runs/{run_id:09d}.json")

    def _checkpoint_path(self, run_id: int):
        return self._Path(f"{self.root}/_runs/_whole/{run_id:09d}.json")

    def _checkpoint(self, record: dict) -> Manifest | None:
        """The whole state beside a record; None where there is none, it is broken or of another attempt."""
        if record["run_id"] % CHECKPOINT_EVERY:
            return None
        told = self._json(self._checkpoint_path(record["run_id"]))
        return Manifest.from_json(json.dumps(told)) if told and told.get("attempt") == record["attempt"] else None

    def _parsed(self, run_id: int) -> dict | None:
        """The record of a run; None where the file is empty or broken."""
        told = self._json(self._manifest_path(run_id))
        return told if told and told.get("run_id") == run_id and ("tables" in told or "changes" in told) else None

    def _json(self, path) -> dict | None:
        """The JSON object in a file; None where there is no file or it is broken (other read errors are raised)."""
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() != "ChecksumException":
                raise
            return None
        finally:
            stream.close()
        try:
            told = json.loads(text)
        except ValueError:
            return None
        return told if isinstance(told, dict) else None

    def publish(self, m: Manifest) -> None:
        """Make the run's record visible as a whole; fails if the run id is published (two writers of one run).

        It is written under ``_runs/_tmp`` and renamed without overwriting. The
        rename is atomic on HDFS and local file systems; on object stores it
        is a copy, so there one writer at a time has to be ensured outside. A
        broken file of the id (which readers skip) is replaced. A whole state, where
        one is due, follows; without it (a crash between) readers go further back.
        """
        target = self._manifest_path(m.run_id)
        self._put(target, m.record(), self._fs.exists(target) and self._parsed(m.run_id) is None)
        m.ledger = self
        if m.run_id % CHECKPOINT_EVERY == 0:
            self._fs.mkdirs(self._checkpoint_path(m.run_id).getParent())
            self._put(self._checkpoint_path(m.run_id), m.to_json(), True)

    def _put(self, target, text: str, overwrite: bool) -> None:
        jvm = self.spark.sparkContext._jvm
        tmp = self._Path(f"{self.root}/_runs/_tmp/{uuid.uuid4().hex}")
        out = self._fs.create(tmp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        how = jvm.org.apache.hadoop.fs.Options.Rename
        flags = self.spark.sparkContext._gateway.new_array(how, 1)
        flags[0] = how.OVERWRITE if overwrite else how.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            tmp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getUri(),
            self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(self._fs.makeQualified(tmp), self._fs.makeQualified(target), flags)

    # -- consumed files ----------------------------------------------------------------------
    def ledger_rows(self, m: Manifest) -> DataFrame:
        """The ledger: path, business_date, run_id, place, status of every file that a run has settled."""
        return self.fact(m, LEDGER, FILES)

    def consumed(self, m: Manifest) -> list[str]:
        return [r.path for r in self.ledger_rows(m).where(F.col("status") == LOADED).orderBy("run_id", "place").select("path").collect()]

    def known_files(self, m: Manifest, files: DataFrame) -> DataFrame:
        """Those of ``files`` (a column path) that a run has settled."""
        known = files.join(self.ledger_rows(m).select("path"), "path", "left_semi")
        if m.old_files:
            old = self.spark.createDataFrame([(p,) for p in m.old_files], "path string")
            known = known.unionByName(files.join(old, "path", "left_semi"))
        return known

    def settle_files(self, m: Manifest, files: list[tuple], status: str = LOADED) -> None:
        """Append (path, business_date) rows to the ledger in this run's folder."""
        if files:
            rows = [(p, d, m.run_id, i, status) for i, (p, d) in enumerate(files)]
            self.append_fact(m, LEDGER, self.spark.createDataFrame(rows, FILES).coalesce(1))

    # -- tables --------------------------------------------------------------------------------
    def _read(self, dirs: list[str], schema: T.StructType) -> DataFrame:
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*dirs)

    def history(self, m: Manifest, name: str, schema: T.StructType) -> DataFrame:
        t = m.tables.get(name, {})
        closed = self._read(t.get("closed", []), schema)
        current = self._read([t["current"]] if t.get("current") else [], schema)
        return closed.unionByName(current)

    def open_rows(self, m: Manifest, name: str, schema: T.StructType) -> DataFrame:
        t = m.tables.get(name, {})
        return self._read([t["current"]] if t.get("current") else [], schema)

    def fact(self, m: Manifest, name: str, schema: T.StructType, where: Column | None = None) -> DataFrame:
        """A fact's rows; ``where`` (on ``day``) keeps the partitions of some days of a fact written by day."""
        return self._parts(m.tables.get(name, {}).get("parts", []), name, schema, where)

    def _parts(self, parts: list[str], name: str, schema: T.StructType, where: Column | None = None) -> DataFrame:
        if name not in DAILY or not parts:
            return self._read(parts, schema)
        found = None
        for inner in (False, True):         # folders written with and without refused rows beside the loaded ones
            own = [p for p in parts if p.endswith(f"/{PART}={LOADED}") == inner]
            if not own:
                continue
            levels = ["run", PART] if inner else ["run"]
            by_day = T.StructType([*schema.fields, *[T.StructField(x, T.StringType()) for x in levels],
                                   T.StructField(DAY, T.DateType())])
            rows = self.spark.read.schema(by_day).option("basePath", f"{self.root}/{name}").parquet(*own)
            rows = (rows if where is None else rows.where(where)).select(*schema.fieldNames())
            found = rows if found is None else found.unionAll(rows)
        return found

    def added(self, prev: Manifest, m: Manifest, name: str, schema: T.StructType) -> DataFrame | None:
        """The rows a fact gained since ``prev``; None where it has no new folder."""
        new = self._new_parts(prev, m, name)
        return self._parts(new, name, schema) if new else None

    def _new_parts(self, prev: Manifest, m: Manifest, name: str) -> list[str]:
        before = set(prev.tables.get(name, {}).get("parts", []))
        return [p for p in m.tables.get(name, {}).get("parts", []) if p not in before]

    def added_days(self, prev: Manifest, m: Manifest, name: str) -> list[dt.date]:
        """Days of the rows a fact written by day gained since ``prev``, from its folder names."""
        names = [s.getPath().getName() for p in self._new_parts(prev, m, name)
                 for s in self._fs.listStatus(self._Path(p))]
        days = [n[len(DAY) + 1:] for n in names if n.startswith(f"{DAY}=")]
        return [dt.date.fromisoformat(d) for d in days if not d.startswith("__")]   # rows without a time: no rule holds

    def write_history_delta(self, m: Manifest, name: str, delta: DataFrame, refused: DataFrame | None = None) -> None:
        """One job writes the closed and the open rows of a merge, and the rows refused, into the run's folder."""
        path = f"{self.root}/{name}/{m.folder()}"
        part = F.when(is_open(), F.lit("current")).otherwise(F.lit("closed"))
        if PART in delta.columns:           # with refused rows of the merge's own
            delta = delta.withColumn("_source", F.when(F.col("_row").isNotNull(), F.lit(name)))
            part = F.coalesce(F.col(PART), part)
        rows = delta.withColumn(PART, part)
        if refused is not None:
            rows = rows.unionByName(refused, allowMissingColumns=True)
        self._observed(m, name, rows).write.mode("errorifexists").partitionBy(PART).parquet(path)
        t = m.tables.setdefault(name, {"closed": [], "current": None})
        found = self._part_names(path)
        if "closed" in found:
            t["closed"] = t.get("closed", []) + [f"{path}/{PART}=closed"]
        t["current"] = f"{path}/{PART}=current" if "current" in found else None
        self._note_refused(m, path, found - {"closed", "current"})

    def append_fact(self, m: Manifest, name: str, rows: DataFrame, refused: DataFrame | None = None) -> None:
        """Append rows in the run's folder; with ``refused`` (``_part`` its reason, ``_source``, ``_row``) beside them.

        ``rows`` may carry the refused ones itself, marked by ``_part``.
        """
        path = f"{self.root}/{name}/{m.folder()}"
        if refused is None and PART not in rows.columns:
            self._write(rows, name, path)
        else:
            if PART not in rows.columns:
                rows = rows.withColumn(PART, F.lit(LOADED))
            if refused is not None:
                rows = rows.unionByName(refused, allowMissingColumns=True)
            self._write(self._observed(m, name, rows), name, path, [PART])
            found = self._part_names(path)
            self._note_refused(m, path, found - {LOADED})
            if LOADED not in found:
                return
            path = f"{path}/{PART}={LOADED}"
        t = m.tables.setdefault(name, {"parts": []})
        t["parts"] = t.get("parts", []) + [path]

    def _write(self, rows: DataFrame, name: str, path: str, levels: list[str] | None = None) -> None:
        levels = list(levels or [])
        if name in DAILY:
            rows, levels = rows.withColumn(DAY, F.to_date(DAILY[name])), [*levels, DAY]
            rows = rows.hint("rebalance", *levels)          # a day's rows in few files; large days are split again
        rows.write.mode("errorifexists").partitionBy(*levels).parquet(path)

    # -- refused rows --------------------------------------------------------------------------
    def _observed(self, m: Manifest, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` whose refused ones are counted by reason while they are written (``settled_counts`` collects)."""
        seen = Observation(f"refused_{name}_{m.attempt}")
        self._seen.append((m.attempt, name, seen))
        return rows.observe(seen, *[F.count_if(F.col(PART) == r).alias(r) for r in REASONS])

    def settle_counts(self, m: Manifest) -> None:
        """Put the counts of this attempt's writes into the manifest."""
        for attempt, name, seen in self._seen:
            if attempt == m.attempt:
                m.counts[name] = {k: v for k, v in observed(seen).items() if v}
        self._seen = [x for x in self._seen if x[0] != m.attempt]

    def _part_names(self, path: str) -> set[str]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._Path(path))]
        return {n[len(PART) + 1:] for n in names if n.startswith(f"{PART}=")}

    def _note_refused(self, m: Manifest, path: str, reasons: set[str]) -> None:
        if reasons:
            t = m.tables.setdefault(REJECTED, {"parts": []})
            t["parts"] = t.get("parts", []) + [f"{path}/{PART}={r}" for r in sorted(reasons)]

    def rejected(self, m: Manifest) -> DataFrame:
        """Every refused row: source (the feed), reason, row (the row as it came, JSON)."""
        schema = T.StructType([T.StructField("_source", T.StringType()), T.StructField("_row", T.StringType())])
        out = self.spark.createDataFrame([], "source string, reason string, row string")
        parts = m.tables.get(REJECTED, {}).get("parts", [])
        for reason in sorted({p.rsplit("=", 1)[1] for p in parts}):
            own = [p for p in parts if p.endswith(f"{PART}={reason}")]
            rows = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*own)
            out = out.unionAll(rows.select("_source", F.lit(reason), "_row"))
        return out


def next_manifest(prev: Manifest, run_ts: dt.datetime) -> Manifest:
    return Manifest(run_id=prev.run_id + 1, parent=prev.run_id, run_ts=run_ts.isoformat(sep=" "),
                    report_date=prev.report_date, watermarks=dict(prev.watermarks),
                    tables=json.loads(json.dumps(prev.tables)), attempt=uuid.uuid4().hex[:12],
                    report_basis=prev.report_basis, indexed=prev.indexed, old_files=list(prev.old_files),
                    base=prev.tables, ledger=prev.ledger)


def _refilter(wh: Warehouse, m: Manifest, name: str, schema: T.StructType, old: set[str]) -> None:
    """One key filter for the new folder instead of those of the old ones, where they had any."""
    from ledgerwarden.plans.keyfilters import FILTERS, write_filter

    entries = m.tables.get(FILTERS, {}).get("parts", [])
    gone = [e for e in entries if json.loads(e)["fact"] in old]
    if gone:
        m.tables[FILTERS]["parts"] = [e for e in entries if e not in gone]
        write_filter(wh, m, name, schema)


def compact(wh: Warehouse, name: str, schema: T.StructType, target_files: int | None = None) -> Manifest:
    """Rewrite a table's per-run folders into one, published as a new run.

    For a history: its closed folders (the open part is already one folder).
    For a fact or the report: all of its parts. Readers of older manifests
    keep their folders; readers of the new one see the same rows in fewer
    files. Nothing is overwritten, so a crash leaves the previous state.
    """
    prev = wh.latest()
    m = next_manifest(prev, dt.datetime.fromisoformat(prev.run_ts) if prev.run_ts else dt.datetime(1970, 1, 1))
    t = m.tables.get(name, {})
    field_name = "closed" if "closed" in t else "parts"
    folders = t.get(field_name, [])
    if len(folders) > 1:
        rows = wh._read(folders, schema) if field_name == "closed" else wh.fact(prev, name, schema)
        if target_files:
            rows = rows.repartition(target_files)
        suffix = f"/{PART}=closed" if field_name == "closed" else ""
        path = f"{wh.root}/{name}/{m.folder()}{suffix}"
        wh._write(rows, "" if suffix else name, path)
        t[field_name] = [path]
        _refilter(wh, m, name, schema, set(folders))
    wh.publish(m)
    return m
