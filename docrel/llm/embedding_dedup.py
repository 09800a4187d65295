"""Near-duplicate vectors by Euclidean p-stable hashing (Datar et al., 2004).

Vectors are normalised, projected on Gaussian directions, shifted and cut into cells of equal width. Vectors
whose cells agree in all projections of one of several tables are candidates; cosines in double precision decide.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed, connected_components

#: Width of a cell, projections a table, tables. A pair of cosine 0.93 (distance 0.374) agrees in a projection with
#: probability 0.88 and is missed by all tables with probability 4e-4; one of cosine 0.97 with 1e-9. Unrelated
#: vectors (distance 1.41) agree in a table with probability 1e-5.
WIDTH, PROJECTIONS, TABLES = 2.5, 20, 96
COSINE = 0.93


def _directions(dims: int, tables: int, projections: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dims])
    return rng.standard_normal((dims, tables * projections)), rng.random(tables * projections)


def cells(width: float = WIDTH, projections: int = PROJECTIONS, tables: int = TABLES, seed: int = 11):
    """Pandas UDF: arrays of doubles to arrays of one hashed cell (int) a table."""

    @F.pandas_udf("array<int>")
    def hashed(vectors: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vectors), index=vectors.index, dtype=object)
        mix = np.random.default_rng(seed + 1).integers(1, 2**63, projections, dtype=np.int64) | 1
        sizes = vectors.map(len)
        for dims in sizes.unique():
            own = vectors[sizes == dims]
            a, shift = _directions(int(dims), tables, projections, seed)
            x = np.stack(own.to_numpy()).astype(np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            for i in range(0, len(x), 1024):
                cell = np.floor(x[i : i + 1024] @ a / width + shift).astype(np.int64).reshape(-1, tables, projections)
                with np.errstate(over="ignore"):
                    mixed = ((cell * mix).sum(axis=2) >> 31).astype(np.int32)
                for j, row in zip(own.index[i : i + 1024], mixed, strict=True):
                    out[j] = row
        return out

    return hashed


def cosine(a: Column, b: Column, aa: Column, bb: Column) -> Column:
    """Cosine in double precision; ``aa`` and ``bb`` are norms."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    return dot / (aa * bb)


def near_vectors(vectors: DataFrame, threshold: float = COSINE, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label", width: float = WIDTH, projections: int = PROJECTIONS, tables: int = TABLES) -> DataFrame:
    """``key, n_links, component_id, kept`` of every vector; links join equal labels at a cosine of ``threshold`` or more.

    Equal vectors of a label are one class, so copies are never compared; classes travel as 64-bit hashes. Cells
    that hold one class alone are dropped before vectors are fetched. Two classes meet in the first table in
    which their cells agree and in no other, so each link is found once and no pair is shuffled for removal.
    Exact link counts need every pair of a dense group to be judged; a cell's rows are split by skew handling.

    Null labels, null, empty and zero vectors and those with null or non-finite components link with nothing:
    no links, a component of their own, kept. Vectors of different length do not link. Null keys give a null
    component unless linked, and are not kept; rows that repeat a key count as vectors each.
    """
    values = F.col(vector).cast("array<double>")
    finite = F.coalesce(F.size(values) > 0, F.lit(False)) & ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.coalesce(finite & F.exists(values, lambda x: x != 0) & F.col(label).isNotNull(), F.lit(False))
    rows = vectors.select(F.col(key).alias("key"), F.when(valid, F.col(label)).alias("label"), F.when(valid, values).alias("v"))
    rows = rows.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    classes = rows.where("v IS NOT NULL").groupBy("label", "v").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n"))
    scaled = classes.withColumns({"node": F.xxhash64("label", "v"), "dims": F.size("v"), "x": F.transform("v", lambda x: x / largest)}).drop("v")
    classes = checkpointed(scaled.withColumns({
        "norm": F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, x: s + x * x)),
        "cells": cells(width, projections, tables)("x")}))
    spots = classes.select("node", "label", "dims", F.posexplode("cells").alias("t", "cell"))
    spots = checkpointed(spots)
    shared = spots.groupBy("label", "dims", "t", "cell").agg(F.count(F.lit(1)).alias("many")).where("many > 1").drop("many")
    met = spots.join(checkpointed(shared), ["label", "dims", "t", "cell"])
    full = met.join(classes.select("node", "x", "norm", "cells", "n"), "node")
    here, there = (full.select("label", "dims", "t", "cell", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "x", "norm", "cells", "n")]) for s in "ab")
    first = ~F.exists(F.zip_with(F.slice("cells_a", F.lit(1), F.col("t")), F.slice("cells_b", F.lit(1), F.col("t")), lambda p, q: p == q), lambda e: e)
    pairs = here.join(there, ["label", "dims", "t", "cell"]).where(
        (F.col("node_a") < F.col("node_b")) & first & (cosine(F.col("x_a"), F.col("x_b"), F.col("norm_a"), F.col("norm_b")) >= threshold))
    links = checkpointed(pairs.select("node_a", "node_b", "n_a", "n_b"))
    counted = (links.select(F.col("node_a").alias("node"), F.col("n_b").alias("n")).union(links.select("node_b", "n_a"))
               .groupBy("node").agg(F.sum("n").alias("others")))
    parts = connected_components(links.select(F.col("node_a").alias("u"), F.col("node_b").alias("v")))
    known = classes.select("node", "least", "n").join(counted, "node", "left").join(parts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    known = checkpointed(known)
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    table = checkpointed(known.join(checkpointed(least), "component").select(
        "node", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    out = rows.select("key", "node").join(table, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))
