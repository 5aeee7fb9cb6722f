"""Run log as an event table, plus its current-state view.

A run is a ``running`` start event and, later, one terminal event (``success``/``failed``)
with row counts and an error message. The current state of
every run is one aggregation over the events (no join, partial aggregation per run id).

In a folder, the events of a run lie in two partitions, ``run_id=<id>/phase=start`` and ``phase=end``, each overwritten
as a whole: an event that is written again replaces itself. ``compact_events`` moves finished runs into one
versioned table of a few files, so the folder holds what is running or finished since then. The move is
committed before anything is deleted, and events that are in both for a moment count once. In a catalog table events are appended.

Event columns: run_id, job_name, event_time, status, rows_read, rows_written, error_message.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewatch.sources.metadata import EVENT_SCHEMA
from tablewatch.sources.versioned import VersionedTable

# Run states.
RUNNING, SUCCESS, FAILED = "running", "success", "failed"
#: Events in a file of compacted events, about.
EVENTS_A_FILE = 1_000_000


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run: run_id, job_name, started_at, finished_at, status, rows_read,
    rows_written, duration_seconds (decimal(10,2), half-up), error_message."""
    term = F.when(F.col("status") != RUNNING, F.struct(
        F.col("event_time").alias("t"), F.col("status").alias("s"), F.col("rows_read").alias("rr"),
        F.col("rows_written").alias("rw"), F.col("error_message").alias("err")))
    g = events.groupBy("run_id").agg(
        F.max("job_name").alias("job_name"),
        F.min(F.when(F.col("status") == RUNNING, F.col("event_time"))).alias("started_at"),
        F.max(term).alias("fin"),
    )
    us = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("fin.t"))
    hundredths = F.floor((us + F.lit(5000)) / F.lit(10000)).cast("decimal(18,0)")
    return g.select(
        "run_id", "job_name", "started_at",
        F.col("fin.t").alias("finished_at"),
        F.coalesce(F.col("fin.s"), F.lit(RUNNING)).alias("status"),
        F.col("fin.rr").alias("rows_read"),
        F.col("fin.rw").alias("rows_written"),
        (hundredths / F.lit(100)).cast("decimal(10,2)").alias("duration_seconds"),
        F.col("fin.err").alias("error_message"),
    )


def utc_clock() -> datetime:
    """The driver's time in UTC without a zone, the clock of every metadata timestamp."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_run_id() -> int:
    return uuid.uuid4().int >> 65


class RunLog:
    """Driver-side logger writing start/finish events to a Parquet table path.

    >>> log = RunLog(spark, path, "load_customers")
    >>> with log.run() as run:
    ...     out = run.observe_read(df)          # counted while the job runs, no extra pass
    ...     written = run.observe_write(clean)  # idem, on the written frame
    ...     written.write.mode("overwrite").saveAsTable("stg_customers")
    """

    def __init__(self, spark: SparkSession, path: str, job_name: str):
        self.spark, self.path, self.job_name = spark, path, job_name
        self.run_id: int | None = None
        self._reads: list[Observation] = []
        self._writes: list[Observation] = []

    def _append(self, status: str, when: datetime, rows_read=None, rows_written=None, error=None) -> None:
        """``path`` with a ``/`` is a Parquet folder, otherwise a catalog table."""
        row = (self.run_id, self.job_name, when, status, rows_read, rows_written, error)
        event = self.spark.createDataFrame([row], EVENT_SCHEMA)
        if "/" in self.path:
            write_events(event, self.path)
        else:
            event.write.mode("append").saveAsTable(self.path)

    def start(self, run_id: int | None = None) -> int:
        self.run_id = run_id if run_id is not None else new_run_id()
        self._append(RUNNING, utc_clock())
        return self.run_id

    def finish(self, status: str, rows_read: int | None = None, rows_written: int | None = None,
               error_message: str | None = None) -> None:
        if self.run_id is None:
            raise RuntimeError("this run was never started, so it cannot end")
        if status not in (SUCCESS, FAILED):
            raise ValueError(f"terminal status must be {SUCCESS!r} or {FAILED!r}")
        self._append(status, utc_clock(), rows_read, rows_written, error_message)

    def observe_read(self, df: DataFrame) -> DataFrame:
        obs = Observation(f"read_{len(self._reads)}")
        self._reads.append(obs)
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def observe_write(self, df: DataFrame) -> DataFrame:
        obs = Observation(f"write_{len(self._writes)}")
        self._writes.append(obs)
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def _total(self, observations: list[Observation]) -> int | None:
        """Rows of the observed frames; None when there are none, or one of them got no action.

        Counts come with the event of a finished action: once the queue of events is empty, a
        count that has not come will not come.
        """
        if not observations:
            return None
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        rows = [o._jo.getRowOrEmpty() if o._jo is not None else None for o in observations]
        if any(r is None or not r.isDefined() for r in rows):
            return None
        return sum(r.get().getLong(0) for r in rows)

    @contextmanager
    def run(self, run_id: int | None = None):
        self.start(run_id)
        try:
            yield self
        except BaseException as exc:  # interrupts end the run as well
            self.finish(FAILED, error_message=str(exc) or type(exc).__name__)
            raise
        self.finish(SUCCESS, self._total(self._reads), self._total(self._writes))


def write_events(events: DataFrame, path: str) -> None:
    """Store events in a folder; those of a run and phase replace the ones there."""
    phase = F.when(F.col("status") == RUNNING, F.lit("start")).otherwise(F.lit("end")).alias("phase")
    w = events.select(*EVENT_SCHEMA.names, phase).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy("run_id", "phase").parquet(f"{path.rstrip('/')}/recent")


def _recent(spark: SparkSession, path: str) -> DataFrame:
    """Events that are not compacted. Their folders may be empty or absent."""
    folder = f"{path.rstrip('/')}/recent"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        return spark.createDataFrame([], EVENT_SCHEMA)
    schema = StructType([*EVENT_SCHEMA.fields, StructField("phase", StringType())])
    return spark.read.schema(schema).parquet(folder).select(*EVENT_SCHEMA.names)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All events of a folder, compacted or not."""
    old = VersionedTable(spark, f"{path.rstrip('/')}/compacted")
    recent = _recent(spark, path)
    return old.read().unionByName(recent).distinct() if old.versions() else recent


def compact_events(spark: SparkSession, path: str, events_a_file: int = EVENTS_A_FILE) -> int:
    """Move the events of all finished runs into the compacted table; returns how many runs were moved."""
    recent = _recent(spark, path)
    done = recent.where(F.col("status") != RUNNING).select("run_id").distinct()
    ids = [r.run_id for r in done.toLocalIterator()]
    if not ids:
        return 0
    old = VersionedTable(spark, f"{path.rstrip('/')}/compacted")
    moved = recent.join(done, "run_id", "left_semi").select(*EVENT_SCHEMA.names)
    every = (old.read().unionByName(moved) if old.versions() else moved).distinct()
    old.write(every.coalesce(max(1, math.ceil(every.count() / events_a_file))))
    files = old._files()
    for k in ids:  # committed: the folders may go
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/recent/run_id={k}"), True)
    old.vacuum(keep=1)
    return len(ids)
