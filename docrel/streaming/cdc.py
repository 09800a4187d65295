"""Log records that arrive, applied to a versioned state."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.operators import apply, oplog, verify
from docrel.operators.flatten import flatten_all, parse
from docrel.plans.schema import FlattenPlan
from docrel.sources.store import VersionedStore

LOG = "array<struct<t:long,i:long,shard:string,op:string,o:string>>"
#: ``doc`` is ``base`` with the records of ``log``; where ``log`` is NULL, ``doc`` is the base itself.
STATE = f"collection string, rec_id string, doc string, base string, log {LOG}"
#: Batches that may be read again for documents whose source is ahead, and failures before a repair.
MAX_READS, MAX_ATTEMPTS = 10, 2


def _refold(base: str | None, entries: Iterable[tuple[int, int, str, str, str | None]], settled: tuple[int, int] | None) -> tuple[str | None, str | None, list]:
    """``(doc, base, log)`` of records in any order, each ``(t, i, shard, op, o)``.

    Records before the last insert or delete cannot matter and go; those before ``settled`` become part of the base.
    """
    text = lambda d: None if d is None else json.dumps(d, ensure_ascii=False, separators=(",", ":"))
    ops = lambda rows: [(op, json.loads(o) if o else None) for _, _, _, op, o in rows]
    rows = sorted({x[:3]: x for x in entries}.values(), key=lambda x: (x[0], x[1], x[2] or ""))
    last = max((k for k, x in enumerate(rows) if x[3] in "id"), default=None)
    if last is not None:
        base, rows = None, rows[last:]
    old = [x for x in rows if settled and x[:2] < tuple(settled)]
    if old:
        base, rows = text(apply.fold(json.loads(base) if base else None, ops(old))), rows[len(old):]
    return text(apply.fold(json.loads(base) if base else None, ops(rows))), base, rows


def next_version(state: DataFrame, records: DataFrame, settled: tuple[int, int] | None = None) -> DataFrame:
    """The state after a batch, whatever the order in which batches bring records.

    A document keeps its records since its last insert or delete, so that one that comes late, from a shard that lags or
    with the time of one that came before, takes its place in the order of time and shard; one that comes again changes
    nothing. ``settled`` is a time before which no record comes any more: older ones are folded into the base, which
    bounds what is kept, and are left out if they come again. Deleted documents stay as rows without a document.
    """
    key, at = ["collection", "rec_id"], F.struct("ts.t", "ts.i", "shard", "op", "o")
    fresh = records if settled is None else records.where(~(F.col("ts") < F.struct(F.lit(settled[0]).cast("long").alias("t"), F.lit(settled[1]).cast("long").alias("i"))))
    new = apply.since_reset(fresh).groupBy(*key).agg(F.collect_set(at).alias("new"))
    own = state.select(*key, F.when(F.col("log").isNull(), F.col("doc")).otherwise(F.col("base")).alias("base"), "log")

    @F.pandas_udf(f"doc string, base string, log {LOG}")
    def refolded(bases: pd.Series, logs: pd.Series, news: pd.Series) -> pd.DataFrame:
        out = []
        for base, log, new in zip(bases, logs, news, strict=True):
            # of a record that comes twice the one that was kept counts
            rows = [(x["t"], x["i"], x["shard"], x["op"], x["o"]) for part in (new, [] if log is None else log) for x in part]
            doc, base, kept = _refold(base, rows, settled)
            out.append((doc, base, [dict(zip(("t", "i", "shard", "op", "o"), x, strict=True)) for x in kept]))
        return pd.DataFrame(out, columns=["doc", "base", "log"])

    changed = new.join(own, key, "left").select(*key, refolded("base", "log", "new").alias("now")).select(*key, "now.*")
    return state.join(new.select(*key), key, "left_anti").select(*changed.columns).unionByName(changed)


class ChangeStream:
    """Applies a stream of parsed log records with ``foreachBatch``; each batch is one commit of the store.

    With ``shards``, all shards that there are, each in order of time, records that none of them can precede any more are
    folded for good; without, every document keeps its records since its last insert or delete.
    """

    def __init__(self, spark: SparkSession, path: str, collections: list[str], shards: Sequence[str] | None = None):
        self.spark, self.collections, self.shards = spark, collections, shards
        self.store = VersionedStore(spark, path, STATE)

    def batch(self, records: DataFrame, batch_id: int) -> None:
        commit = self.store.current()
        if commit and commit.get("batch", -1) >= batch_id:
            return  # it was committed before the stream could note it
        kept = oplog.valid(records, self.collections)
        before = {k: tuple(v) for k, v in (commit or {}).get("points", {}).items()}
        settled = min((before[s] for s in self.shards), default=None) if self.shards and set(self.shards) <= set(before) else None
        folder = self.store.stage(next_version(self.store.read(), kept, settled))
        points = oplog.high_water(records, before)
        self.store.commit(folder, batch=batch_id, points=points)

    def start(self, records: DataFrame, checkpoint: str, **options: Any):
        """Starts on a streaming DataFrame of parsed records and ends when what is there is done."""
        return (records.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
                .options(**options).trigger(availableNow=True).start())

    def documents(self) -> DataFrame:
        return self.store.read().where("doc IS NOT NULL").select("collection", "rec_id", "doc")


def tables(state: DataFrame, plan: FlattenPlan) -> dict[str, DataFrame]:
    """The tables of one collection of a state."""
    docs = parse(state.where((F.col("collection") == plan.collection) & F.col("doc").isNotNull()).select("doc"))
    return flatten_all(docs, plan)


def apply_and_verify(store: VersionedStore, records: DataFrame, source: DataFrame, plans: Mapping[str, FlattenPlan],
                     points: Mapping[str, Any] | None = None, attempt: int = 0, repair: bool = True) -> str:
    """One run: applies records, compares what they touch with the source, and commits, repairs or leaves all as it was.

    ``source`` has ``collection, rec_id, doc``. Returns ``ok``, ``retry`` (nothing committed, fewer failures than
    MAX_ATTEMPTS so far), ``resync`` (failing documents were taken from the source) or ``failed``.
    """
    kept = oplog.valid(records, list(plans))
    folder = store.stage(next_version(store.read(), kept))
    state = store.spark.read.schema(STATE).parquet(folder)
    touched = oplog.touched(kept)
    failing = failing_ids(state, source, touched, plans)
    marks = oplog.high_water(records, points)
    if failing.isEmpty():
        store.commit(folder, points=marks)
        return "ok"
    if attempt + 1 < MAX_ATTEMPTS:
        return "retry"
    if not repair:
        return "failed"
    key = ["collection", "rec_id"]
    fixed = state.join(failing, key, "left_semi").select(*key).join(source.select(*key, "doc"), key, "left").select(
        *key, "doc", F.lit(None).cast("string").alias("base"), F.lit(None).cast(LOG).alias("log"))
    whole = state.join(failing, key, "left_anti").select(*fixed.columns).unionByName(fixed)
    store.commit(store.stage(whole), points=marks)
    return "resync"


def failing_ids(state: DataFrame, source: DataFrame, touched: DataFrame, plans: Mapping[str, FlattenPlan]) -> DataFrame:
    """``collection, rec_id`` of touched documents whose rows, in any table, differ from those of the source."""
    key, parts = ["collection", "rec_id"], []
    mine, theirs = (df.join(touched, key, "left_semi") for df in (state, source))
    for name, plan in plans.items():
        found = verify.compare(tables(theirs, plan), tables(mine, plan), plan)
        parts.append(found.select(F.lit(name).alias("collection"), F.col("id").alias("rec_id")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
