"""Sync points after an initial load that took long: which records each loaded document already reflects."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.operators.apply import fold


def locate(loaded: DataFrame, source: DataFrame, records: DataFrame) -> DataFrame:
    """``collection, rec_id, start, n_ops, t, i, shard`` for every document that records touch.

    ``start`` is the smallest number of records to leave out so that the rest, folded into the loaded document, gives
    the source document; it equals ``n_ops`` where the two are equal already (then no record is due), and is NULL where
    none does. ``t, i, shard`` are those of the first record that is due. Documents are JSON texts and compare by value.
    """
    at = F.struct(F.col("ts.t").alias("t"), F.col("ts.i").alias("i"), "shard", "op", "o")
    ops = records.groupBy("collection", "rec_id").agg(F.array_sort(F.collect_list(at)).alias("ops"))
    key = ["collection", "rec_id"]
    met = ops.join(loaded.select(*key, F.col("doc").alias("before")), key, "left").join(source.select(*key, F.col("doc").alias("after")), key, "left")

    @F.pandas_udf("int")
    def start(before: pd.Series, after: pd.Series, ops: pd.Series) -> pd.Series:
        out = []
        for b, a, records in zip(before, after, ops, strict=True):
            due, steps = json.loads(a) if a else None, [(r["op"], r["o"]) for r in records]
            if (json.loads(b) if b else None) == due:
                out.append(len(steps))
                continue
            found = None
            for k in range(len(steps)):
                if fold(json.loads(b) if b else None, [(op, json.loads(o) if o else None) for op, o in steps[k:]]) == due:
                    found = k
                    break
            out.append(found)
        return pd.Series(out, dtype="Int32")

    found = met.withColumn("start", start("before", "after", "ops")).withColumn("first", F.get("ops", F.col("start")))
    return found.select(*key, "start", F.size("ops").alias("n_ops"), "first.t", "first.i", "first.shard")


def align(located: DataFrame) -> DataFrame:
    """``shard, t, i``: the latest start of any document on each shard; later records apply to all alike."""
    return located.where("shard IS NOT NULL").groupBy("shard").agg(F.max(F.struct("t", "i")).alias("ts")).select("shard", "ts.t", "ts.i")


def due(records: DataFrame, located: DataFrame, points: DataFrame) -> DataFrame:
    """Records from each document's start up to the aligned point of their shard."""
    starts = located.where("t IS NOT NULL").select("collection", "rec_id", F.struct("t", "i", "shard").alias("__start"))
    marks = points.select("shard", F.struct("t", "i").alias("__point"))
    met = records.join(starts, ["collection", "rec_id"]).join(marks, "shard")
    return met.where((F.struct(F.col("ts.t"), F.col("ts.i"), F.col("shard")) >= F.col("__start")) & (F.col("ts") <= F.col("__point"))).select(*records.columns)
