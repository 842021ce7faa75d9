"""M1-M4, K3: the pipeline's own step log.

Each step records ``Inicio`` when it starts and ``Sucesso`` (with an optional
record count or message) or ``Erro`` (with the exception text, then
re-raised) when it ends.  The rows live on the driver (a few per step, so
the list is bounded by the pipeline, not by the data) and are written as a
table by :meth:`StepLog.write`; the pipeline calls it on success and on
failure.  A log with a ``path`` also keeps a journal beside that table: every
event is stored as it happens, one small file each, under the run's id.  The
journal goes when the table stands; if the driver is killed before, the
journal is what is left of the run, and :func:`read_step_log` shows it.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from logstrata import constants as C
from logstrata.schemas import AUDIT_SCHEMA
from logstrata.session import age_seconds, delete_folder, list_folder, put_text
from logstrata.sources.tables import step_rows_frame


@dataclass
class StepEvent:
    timestamp: str
    step: str
    status: str
    message: str = ""
    record_count: int | None = None


@dataclass
class StepOutcome:
    """Filled in by the body of a step; read when the step succeeds."""

    message: str = ""
    record_count: int | None = None


@dataclass
class StepLog:
    events: list[StepEvent] = field(default_factory=list)
    _last: dt.datetime | None = None
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)
    spark: SparkSession | None = field(default=None, repr=False, compare=False)
    path: str | None = None  # of the stored log; gives the log a journal
    run_id: str = field(default_factory=lambda: f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")

    @property
    def _journal(self) -> str:
        return f"{_journals(self.path)}/{self.run_id}"

    def _now(self) -> str:
        # Fixed-width, strictly increasing clock text, so ORDER BY Timestamp
        # (a string sort) is the order in which the events happened.
        now = dt.datetime.now()
        if self._last is not None and now <= self._last:
            now = self._last + dt.timedelta(microseconds=1)
        self._last = now
        return now.isoformat(sep=" ", timespec="microseconds")

    def record(self, step: str, status: str, message: str = "", record_count: int | None = None) -> StepEvent:
        """M1: append one event (safe to call from several threads)."""
        with self._lock:
            event = StepEvent(self._now(), step, status, message or "", record_count)
            self.events.append(event)
            if self.spark is not None and self.path is not None:
                put_text(self.spark, f"{self._journal}/{len(self.events):06d}.json", json.dumps(dict(zip(AUDIT_SCHEMA.names, _row(event)))))
        return event

    @contextmanager
    def step(self, name: str, message: str = ""):
        """``with log.step(name) as out:`` records Inicio, then Sucesso or Erro."""
        self.record(name, C.STATUS_START, message)
        outcome = StepOutcome()
        try:
            yield outcome
        except Exception as exc:
            self.record(name, C.STATUS_ERROR, message=str(exc))
            raise
        self.record(name, C.STATUS_OK, outcome.message, outcome.record_count)

    def rows(self) -> list[tuple]:
        return [_row(e) for e in self.events]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The events as a DataFrame with the explicit audit schema."""
        return step_rows_frame(spark, self.rows())

    def write(self, spark: SparkSession, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
        """K3: store the log (overwrite by default, ``append`` keeps history) and close its journal."""
        self.to_frame(spark).write.format(fmt).mode(mode).save(path)
        if self.path is not None:
            delete_folder(spark, self._journal)


def _row(event: StepEvent) -> tuple:
    return event.timestamp, event.step, event.status, event.message, event.record_count


def _journals(path: str) -> str:
    return f"{path.rstrip('/')}_journal"


def open_runs(spark: SparkSession, path: str) -> list[str]:
    """Ids of the runs that journal to the log at ``path`` and have not stored it: still running, or killed."""
    return list_folder(spark, _journals(path))


def read_step_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: the stored step log, and the events of runs that have not stored theirs."""
    opened = [f"{_journals(path)}/{run}" for run in open_runs(spark, path)]
    if not opened:
        return spark.read.schema(AUDIT_SCHEMA).format(fmt).load(path)
    events = spark.read.schema(AUDIT_SCHEMA).json([f"{folder}/*.json" for folder in opened])
    if not list_folder(spark, path):
        return events
    stored = spark.read.schema(AUDIT_SCHEMA).format(fmt).load(path)
    return stored.unionAll(events.exceptAll(stored))  # a run may have stored its log since


def settle_open_runs(spark: SparkSession, path: str, older_than_seconds: float, fmt: str = "parquet") -> list[str]:
    """Move the events of runs that have written none for so long (their drivers are gone) to the stored log; returns their ids."""
    settled = []
    for run in open_runs(spark, path):
        folder = f"{_journals(path)}/{run}"
        if age_seconds(spark, folder) >= older_than_seconds:
            spark.read.schema(AUDIT_SCHEMA).json(f"{folder}/*.json").write.format(fmt).mode("append").save(path)
            delete_folder(spark, folder)
            settled.append(run)
    return settled
