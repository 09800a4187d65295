"""One turn of the run cycle: what is due follows from the run log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.functions.codec import points_text, points_value
from docrel.operators import oplog, sync
from docrel.operators.status import RunLog, next_step
from docrel.plans.schema import FlattenPlan
from docrel.sources.store import VersionedStore
from docrel.streaming.cdc import LOG, apply_and_verify, next_version


def run_once(runs: RunLog, store: VersionedStore, records: DataFrame, source: DataFrame, plans: Mapping[str, FlattenPlan], shards: list[str], repair: bool = True) -> str:
    """Does the step that the run log asks for and notes it there; returns load, stop, or the step with its outcome.

    After an initial load, or a repair, the sync finds for each document the records that it does not reflect yet, applies
    those up to the latest start of any, and notes that point; documents that no records bring in step make it fail. Later
    turns apply what follows the noted points, compare, and commit, retry or repair.
    """
    row = runs.recent()
    step = next_step(row)
    if step in ("load", "stop"):
        return step
    points = points_value(row.ts, shards)
    fresh = oplog.since(records, points)
    kept = oplog.valid(fresh, list(plans))
    total = kept.count()
    if step == "sync":
        runs.oplog_sync_start(row.ts)
        state = store.read()
        located = sync.locate(state.where("doc IS NOT NULL").select("collection", "rec_id", "doc"), source, kept)
        starts = sync.align(located)
        lost = located.where("start IS NULL").count()
        # documents are the base of what is due
        due = sync.due(kept, located, starts)
        marks = points | {r.shard: (r.t, r.i) for r in starts.collect()}
        if not lost:
            cleared = state.withColumns({"base": F.lit(None).cast("string"), "log": F.lit(None).cast(LOG)})
            store.commit(store.stage(next_version(cleared, due)), points=marks)
        runs.oplog_sync_finish(total, due.count(), points_text(marks if not lost else points), bool(lost))
        return "sync failed" if lost else "sync ok"
    attempt = row.attempt or 0
    runs.oplog_use_start(row.ts, attempt)
    outcome = apply_and_verify(store, fresh, source, plans, points, attempt, repair)
    done = points_text(oplog.high_water(fresh, points)) if outcome in ("ok", "resync") else row.ts
    if outcome == "resync":
        runs.oplog_resync_finish(total, total, done, False)
    else:
        runs.oplog_use_finish(total, total, done, outcome == "failed")
    runs.update_latest(attempt=attempt + 1 if outcome == "retry" else 0)
    return f"apply {outcome}"
