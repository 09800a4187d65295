"""The operation log of several shards: parsing, filters, order and high-water marks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.functions.find import after

OPS = ("i", "u", "d")


def rec_id(op: Column, o: Column, o2: Column) -> Column:
    """The id of the document that a record is about, as text: of ``o2`` for updates, else of ``o``."""

    def of(v: Column) -> Column:
        paths = ("$['_id']['$oid']", "$['_id']['$numberLong']", "$['_id']", "$['id']['$oid']", "$['id']")
        return F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])

    return F.when(op == "u", F.coalesce(of(o2), of(o))).otherwise(of(o))


def parse(lines: DataFrame, shard: str, text: str = "value") -> DataFrame:
    """Log records from JSON texts: ``shard, ts, op, ns, collection, rec_id, o, o2, from_migrate``; ``o`` and ``o2`` are JSON.

    The collection is what follows the first dot of the namespace. Texts that are no JSON, and records without a
    time, are left out.
    """
    v = lines.select(F.try_parse_json(F.col(text)).alias("v"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    part = lambda k: F.coalesce(get(f"$.ts['$timestamp'].{k}", "bigint"), get(f"$.ts.{k}", "bigint"))
    o, o2 = get("$.o", "variant"), get("$.o2", "variant")
    rows = v.select(
        F.lit(shard).alias("shard"), F.struct(part("t").alias("t"), part("i").alias("i")).alias("ts"), get("$.op", "string").alias("op"),
        get("$.ns", "string").alias("ns"), o.alias("o"), o2.alias("o2"), F.coalesce(get("$.fromMigrate", "boolean"), F.lit(False)).alias("from_migrate"))
    return rows.where("ts.t IS NOT NULL").select(
        "shard", "ts", "op", "ns", F.regexp_replace("ns", r"^[^.]*\.", "").alias("collection"), rec_id(F.col("op"), F.col("o"), F.col("o2")).alias("rec_id"),
        F.to_json("o").alias("o"), F.to_json("o2").alias("o2"), "from_migrate")


def merge(shards: Sequence[DataFrame]) -> DataFrame:
    """Records of all shards. They need no global order: what depends on it orders by time and shard within a record id."""
    return reduce(DataFrame.unionByName, shards)


def order() -> Column:
    """What records are ordered by: time, then shard."""
    return F.struct(F.col("ts.t"), F.col("ts.i"), F.col("shard"))


def own(records: DataFrame) -> DataFrame:
    """Without records that only move data between shards."""
    return records.where(~F.coalesce(F.col("from_migrate"), F.lit(False)))


def valid(records: DataFrame, collections: Sequence[str]) -> DataFrame:
    """Inserts, updates and deletes of known collections."""
    return own(records).where(F.col("op").isin(list(OPS)) & F.col("collection").isin(list(collections)))


def since(records: DataFrame, points: Mapping[str, tuple[int, int] | None]) -> DataFrame:
    """Records after the sync point of their shard."""
    conditions = [(F.col("shard") == s) & after(p) for s, p in points.items()]
    return records.where(reduce(lambda a, b: a | b, conditions)) if conditions else records.where("false")


def touched(records: DataFrame) -> DataFrame:
    return records.select("collection", "rec_id").distinct()


def high_water(records: DataFrame, points: Mapping[str, tuple[int, int] | None] | None = None) -> dict[str, tuple[int, int] | None]:
    """The latest time of each shard, one row a shard to the driver; a shard without new records keeps its point.

    Records of any kind count, but for moves between shards.
    """
    found = own(records).groupBy("shard").agg(F.max("ts").alias("ts")).collect()
    return dict(points or {}) | {r.shard: (r.ts.t, r.ts.i) for r in found}
