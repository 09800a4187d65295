"""Checkpoints and connected components shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docrel-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that its lineage ends and a lost executor costs nothing of it.

    Its size as Spark's planner takes it is bounded, too. The planner multiplies the sizes of what a join reads and hands
    the product on through a checkpoint: in a loop of joins its digits multiply each round, until numbers of millions of
    digits fill the driver. A size beyond a long says nothing, and what stands for it is the one of a table of unknown size.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    done = df.checkpoint()
    plan = done._jdf.queryExecution().analyzed()
    if plan.stats().sizeInBytes() < 2**63:
        return done
    some = spark._jvm.scala.Option
    plain = plan.copy(plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(), plan.stream(),
                      spark._jsparkSession, some.empty(), some.apply(plan.constraints()))
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plain), spark)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of finished queries now: it does so once the driver's JVM has collected them.

    Python's references to objects of the JVM go first, in a thread of their own.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once a row: a column that a lambda function names may else be computed at each call,
    as the optimizer is free to put the column's expression in place of its name."""
    return F.get(F.transform(F.array(value), body), 0)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(node, component)``; the component is the smallest node reachable.

    Each round points every node at the smallest node next to it, doubles these pointers until all name
    a node that points at itself, and contracts the links to these nodes, until no link is left. No two
    neighbours both point at themselves, so a round leaves half the nodes at most, and doubling takes the
    logarithm of the longest chain of pointers. Links with a null end and loops are ignored; nodes without
    links do not appear. Whatever the size, links stay distributed: all joins are on a node against one
    row for each node, which adaptive execution can split on a hot node.
    """
    ends = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    left = checkpointed(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    labels = None
    while not left.isEmpty():
        near = left.select(F.col("u").alias("node"), F.col("v").alias("by")).union(left.select("v", "u"))
        to = checkpointed(near.groupBy("node").agg(F.least("node", F.min("by")).alias("root")))
        while True:
            further = checkpointed(_follow(to, to).select("node", "root", "moved"))
            to = further.select("node", "root")
            if further.where("moved").isEmpty():
                break
        labels = to if labels is None else checkpointed(_follow(labels, to).select("node", "root"))
        at_u = left.join(to.select(F.col("node").alias("u"), F.col("root").alias("a")), "u")
        at_v = at_u.join(to.select(F.col("node").alias("v"), F.col("root").alias("b")), "v")
        left = checkpointed(at_v.where("a <> b").select(
            F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if labels is None:
        return ends.where("false").select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.select("node", F.col("root").alias("component"))


def _follow(labels: DataFrame, to: DataFrame) -> DataFrame:
    nxt = to.select(F.col("node").alias("root"), F.col("root").alias("next"))
    root = F.coalesce("next", "root")
    return labels.join(nxt, "root", "left").select("node", root.alias("root"), (root != F.col("root")).alias("moved"))
