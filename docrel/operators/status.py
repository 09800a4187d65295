"""The log of runs and the state machine that it drives.

The log is append-only: an update appends a row that supersedes the older one of the same start, and reads take the
last. It holds one row for each change of a run, so it stays small whatever the data.
"""

from __future__ import annotations

from datetime import datetime, timezone
from enum import IntEnum

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = ("seq long, comment string, time_start timestamp, time_end timestamp, recs_count long, queries_count long, ts string, status int, "
          "attempt int, error boolean")
#: Seconds after which a run without an end counts as hung.
HUNG_SECONDS = 32_400


class Status(IntEnum):
    INITIAL_LOAD = 0
    OPLOG_SYNC = 1
    OPLOG_APPLY = 2
    OPLOG_RESYNC = 3


class LoadState(IntEnum):
    """Of an initial load; the values are exit codes."""

    OK = 0
    NO_RUN = 1
    RUNNING = 2
    FAILED = 3
    HUNG = 4


def latest(log: DataFrame) -> DataFrame:
    """The current row of every run."""
    last = Window.partitionBy("time_start").orderBy(F.desc("seq"))
    return log.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def recent(log: DataFrame) -> DataFrame:
    """The current row of the run that started last."""
    return log.orderBy(F.desc("time_start"), F.desc("seq")).limit(1)


def next_step(row) -> str:
    """What follows the latest run: load, sync, apply or stop."""
    if row is None:
        return "load"
    if row.time_end is None or row.error:
        return "stop"
    return "sync" if row.status in (Status.INITIAL_LOAD, Status.OPLOG_RESYNC) else "apply"


class RunLog:
    """Runs in a parquet folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """The whole log; an empty one where nothing was written yet."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def recent(self):
        return next(iter(recent(self.read()).collect()), None)

    def _append(self, **values) -> None:
        row = self.read().agg(F.coalesce(F.max("seq"), F.lit(0)).alias("n")).collect()[0]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        self.spark.createDataFrame([tuple((values | {"seq": row.n + 1}).get(n) for n in names)], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def save_new(self, status: Status, comment: str = "", ts: str | None = None, attempt: int = 0) -> None:
        self._append(comment=comment, time_start=datetime.now(timezone.utc), ts=ts, status=int(status), attempt=attempt, recs_count=None, error=None)

    def update_latest(self, **changes) -> None:
        """Changes of the latest run; those that are None leave their column as it is."""
        row = self.recent()
        if row is None:
            raise ValueError("no run to update")
        self._append(**(row.asDict() | {k: v for k, v in changes.items() if v is not None}))

    def _finish(self, ts: str | None, error: bool, **more) -> None:
        self.update_latest(time_end=datetime.now(timezone.utc), ts=ts, error=error, **more)

    def init_load_start(self, ts: str | None) -> None:
        self.save_new(Status.INITIAL_LOAD, "init load", ts)

    def init_load_finish(self, error: bool, recs_count: int | None = None) -> None:
        self._finish(None, error, recs_count=recs_count)

    def oplog_sync_start(self, ts: str | None) -> None:
        self.save_new(Status.OPLOG_SYNC, "oplog sync", ts)

    def oplog_sync_finish(self, recs_count: int, queries_count: int, ts: str | None, error: bool) -> None:
        self._finish(ts, error, recs_count=recs_count, queries_count=queries_count)

    def oplog_use_start(self, ts: str | None, attempt: int = 0) -> None:
        self.save_new(Status.OPLOG_APPLY, "oplog use", ts, attempt)

    def oplog_use_finish(self, recs_count: int, queries_count: int, ts: str | None, error: bool) -> None:
        self._finish(ts, error, recs_count=recs_count, queries_count=queries_count)

    def oplog_resync_finish(self, recs_count: int, queries_count: int, ts: str | None, error: bool) -> None:
        self._finish(ts, error, recs_count=recs_count, queries_count=queries_count, status=int(Status.OPLOG_RESYNC))

    def load_state(self, now: datetime | None = None) -> LoadState:
        rows = self.read().where(F.col("status") == int(Status.INITIAL_LOAD))
        row = next(iter(recent(rows).collect()), None)
        if row is None:
            return LoadState.NO_RUN
        if row.time_end is None:
            now = now or datetime.now()
            return LoadState.HUNG if (now - row.time_start).total_seconds() > HUNG_SECONDS else LoadState.RUNNING
        return LoadState.FAILED if row.error else LoadState.OK
