"""Run store: long report table, run ledger and stage snapshots (A5-A7, A10, A11).

The reference keeps a pickle and JSON files per session; here a run writes
small tidy tables (append mode) and, optionally, parquet snapshots of stage
outputs under a shared root folder.  Reports hold per-column metadata only,
so they are small; the data itself never passes through the driver.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .log import LogTable

REPORT_SCHEMA = "run_id string, stage string, column string, metric string, value string"
LEDGER_SCHEMA = "run_id string, step string, at timestamp"
SNAPSHOT_SCHEMA = "run_id string, label string, path string, at timestamp"
#: rows of all kinds: ``report`` (stage, column, metric, value), ``step`` (its name in ``stage``) and ``fit`` (its version
#: in ``metric``, its saved form in ``value``)
LOG_SCHEMA = "kind string, run_id string, stage string, column string, metric string, value string, at timestamp"


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class RunStore:
    """Collects report rows, ledger steps and fits; persists them when ``root`` is set.

    All of them are rows of one log.  What is written inside ``batch()`` is
    one commit: a stage's report, step and fit appear together or not at all.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root
        self.log = LogTable(spark, os.path.join(root, "log"), LOG_SCHEMA) if root else None
        self._rows: list[tuple] = []
        self._fits: dict[str, dict] = {}
        self._held: list | None = None

    @contextlib.contextmanager
    def batch(self):
        """Rows written inside are committed together at the end, and not at all if it fails."""
        if self._held is not None:                      # part of an outer batch
            yield
            return
        self._held = []
        try:
            yield
            rows = self._held
        finally:
            self._held = None
        self._commit(rows)

    def _commit(self, rows: list[tuple]) -> None:
        if self._held is not None:
            self._held += rows
        elif rows and self.log:
            self.log.append(rows)
        elif rows:
            self._rows += rows

    def _table(self, kind: str) -> DataFrame:
        rows = self.log.read() if self.log else self.spark.createDataFrame(self._rows, LOG_SCHEMA)
        return rows.where(F.col("kind") == kind)

    def compact(self, partitions: int = 1) -> None:
        """The log's small files as one base; readers and writers go on meanwhile."""
        if self.log:
            self.log.compact(partitions)

    # --- ledger (A7)
    def log_step(self, run_id: str, step: str) -> None:
        self._commit([("step", run_id, step, None, None, None, _now())])

    def steps(self, run_id: str) -> set:
        """Steps logged for a run (from this process when nothing is persisted)."""
        held = {r[2] for r in self._held or () if r[0] == "step" and r[1] == run_id}
        return held | {r["step"] for r in self.ledger().where(F.col("run_id") == run_id).select("step").collect()}

    # --- report (A6)
    def add_report(self, run_id: str, stage: str, rows, label: str | None = None) -> None:
        at = _now()
        self._commit([("report", run_id, stage, c, m, None if v is None else str(v), at) for c, m, v in rows]
                     + [("step", run_id, label or f"{stage}_report", None, None, None, at)])

    def report(self) -> DataFrame:
        return self._table("report").select("run_id", "stage", "column", "metric", "value")

    # --- fitted state (A5, I2, I3)
    def save_fit(self, run_id: str, stage: str, fit) -> None:
        self._fits.setdefault(run_id, {})[stage] = fit
        if self.root:
            from .fits import VERSION, saved_form
            self._commit([("fit", run_id, stage, None, str(VERSION), saved_form(self.root, run_id, fit), _now())])

    def load_fits(self, run_id: str) -> dict:
        """``{stage: fit}`` of what the run has fitted so far, whichever driver fitted it; empty for an unknown run."""
        if self.log:
            from .fits import read_fits
            return read_fits(self._table("fit"), run_id)
        return dict(self._fits.get(run_id, {}))

    def stage_report(self, run_id: str, stage: str) -> DataFrame:
        """One stage's report of a run; empty if the run has none."""
        return stage_report(self.report().where(F.col("run_id") == run_id), stage)

    def ledger(self) -> DataFrame:
        return self._table("step").select("run_id", F.col("stage").alias("step"), "at")

    def append_ledger(self, steps: DataFrame) -> None:
        """Appends ``(run_id, step, at)`` rows of a table."""
        none = F.lit(None).cast("string")
        self.log.append(steps.select(
            F.lit("step").alias("kind"), F.col("run_id").cast("string").alias("run_id"), F.col("step").cast("string").alias("stage"),
            none.alias("column"), none.alias("metric"), none.alias("value"), F.col("at").cast("timestamp").alias("at")))

    # --- snapshots (A5): each in a folder of its own, so a reader of an earlier one is never overwritten
    def save_snapshot(self, df: DataFrame, run_id: str, label: str) -> DataFrame:
        if not self.root:
            self.log_step(run_id, label)
            return df
        path = os.path.join(self.root, "snapshots", run_id, f"{label}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        row = (run_id, label, path, _now())
        self.spark.createDataFrame([row], SNAPSHOT_SCHEMA).write.mode("append").parquet(os.path.join(self.root, "latest"))
        self.log_step(run_id, label)
        return self.spark.read.schema(df.schema).parquet(path)

    def load_snapshot(self, run_id: str, label: str | None = None) -> DataFrame:
        """The run's latest snapshot (of ``label``, if given)."""
        known = self.spark.read.schema(SNAPSHOT_SCHEMA).parquet(os.path.join(self.root, "latest")).where(F.col("run_id") == run_id)
        known = known if label is None else known.where(F.col("label") == label)
        path = known.agg(F.max_by("path", "at")).first()[0]
        if path is None:
            raise ValueError(f"run {run_id!r} has no snapshot")
        return self.spark.read.parquet(path)

    def write_report_json(self, path: str) -> None:                    # A9-style sink
        self.report().coalesce(1).write.mode("overwrite").json(path)


def list_runs(ledger: DataFrame) -> DataFrame:                          # A10
    """Runs newest first: ``(run_id, created_at, last_at, steps)``."""
    return (ledger.groupBy("run_id")
            .agg(F.min("at").alias("created_at"), F.max("at").alias("last_at"),
                 F.count(F.lit(1)).alias("steps"))
            .orderBy(F.col("last_at").desc(), F.col("run_id")))


def stage_report(report: DataFrame, stage: str) -> DataFrame:
    """Rows of one stage; none if the stage never reported."""
    return report.where(F.col("stage") == stage)


def run_bundle(report: DataFrame, run_id: str) -> DataFrame:    # A11
    """All stage reports of one run together: ``(run_id, stage, entries)``, entries
    being the stage's ``(column, metric, value)`` rows in order.

    Reports hold rows per column of a table, not per row of it, so a stage's
    entries are few."""
    entry = F.struct("column", "metric", "value")
    return (report.where(F.col("run_id") == run_id).groupBy("run_id", "stage")
            .agg(F.sort_array(F.collect_list(entry)).alias("entries")))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of the file system it belongs to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
