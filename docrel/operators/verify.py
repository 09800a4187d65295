"""Whether tables equal their source, and their repair where they do not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.operators.flatten import flatten_all
from docrel.plans.schema import FlattenPlan


def fingerprints(rows: DataFrame, key: str) -> DataFrame:
    """``key, n, a, b`` of each id: how many rows, and sums of two hashes of each. Sums combine before the exchange.

    Columns go by name; NULL counts as a value of its own. Two 64-bit sums and a count tell different sets of rows
    apart with all but certainty.
    """
    columns = sorted(rows.columns)
    marks = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    a, b = F.xxhash64(*marks), F.xxhash64(F.lit(1), *marks[::-1])
    return rows.select(F.col(key).alias("key"), a.alias("a"), b.alias("b")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in "ab"])


def differing_ids(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``key, reason`` of ids whose rows differ: missing_in_target, missing_in_source or different.

    One exchange on either side; an id that neither side has is equal.
    """
    s, t = fingerprints(source, key).alias("s"), fingerprints(target, key).alias("t")
    met = s.join(t, F.col("s.key").eqNullSafe(F.col("t.key")), "full_outer")
    same = (F.col("s.n") == F.col("t.n")) & (F.col("s.a") == F.col("t.a")) & (F.col("s.b") == F.col("t.b"))
    reason = F.when(F.col("t.n").isNull(), "missing_in_target").when(F.col("s.n").isNull(), "missing_in_source").when(~same, "different")
    key_of: Column = F.when(F.col("s.n").isNotNull(), F.col("s.key")).otherwise(F.col("t.key"))
    return met.select(key_of.alias(key), reason.alias("reason")).where("reason IS NOT NULL")


def compare(source: dict[str, DataFrame], target: dict[str, DataFrame], plan: FlattenPlan) -> DataFrame:
    """``(id, table)`` of every id whose rows differ in a table."""
    parts = [differing_ids(source[t.name], target[t.name], t.id_name).select(F.col(t.id_name).cast("string").alias("id"), F.lit(t.name).alias("table")) for t in plan.tables.values()]
    return reduce(DataFrame.unionByName, parts)


def failed_by_try(failing: DataFrame, tries: DataFrame) -> DataFrame:
    """``ntry, collection, ids`` of failing ``collection, rec_id``; of an id's tries the largest counts."""
    latest = tries.groupBy("collection", "rec_id").agg(F.max("ntry").alias("ntry"))
    return failing.join(latest, ["collection", "rec_id"]).groupBy("ntry", "collection").agg(F.array_sort(F.collect_set("rec_id")).alias("ids"))


def replace_ids(target: DataFrame, source: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``ids`` taken from ``source``."""
    failing = ids.select(key).distinct()
    return target.join(failing, key, "left_anti").select(*target.columns).unionByName(source.join(failing, key, "left_semi").select(*target.columns))


def repair(target: dict[str, DataFrame], docs: DataFrame, plan: FlattenPlan, ids: DataFrame, doc: str = "doc") -> dict[str, DataFrame]:
    """All tables with failing ids, in the column ``id``, taken anew from VARIANT source documents."""
    fresh = flatten_all(docs, plan, doc)
    return {n: replace_ids(t, fresh[n], ids.select(F.col("id").alias(plan.tables[n].id_name)), plan.tables[n].id_name) for n, t in target.items()}
