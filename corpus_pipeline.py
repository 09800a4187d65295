"""A corpus pipeline of five operators, each stage over all that its predecessor kept.

Stages read and write the columns of ``documents``; the last gives the shard of each document. Labels and benchmark
items come from the folder of the tables. A document without a text goes through every stage as an empty text, one
without an id as one whose id is an empty text; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from docrel.llm import decontaminate, mixing, quality, sharding, simhash
from docrel.llm.shared import shared_folder
from docrel.session import ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects."""
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of texts whose sets of five-word shingles are similar by 0.8 or more."""
    ship(spark)
    return simhash.deduplicate(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    ship(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), unnumbered=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples a tenth of the tokens so that they follow the target marginals as far as the documents allow."""
    return mixing.sample(docs, budget=mixing.BUDGET)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives each document its shard and slot."""
    ship(spark)
    return sharding.assign_shards(docs, shards=16)


STAGES = [("quality", quality_stage), ("simhash", dedup_stage), ("decontaminate", decontaminate_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: The quality network, fingerprints by XXH64 and edit matching have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written in the shared folder and read again by the next.

    A stage's rows go once the next one's are written; the last ones go when the application ends, as the result reads them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.deleteOnExit(folder)
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
            if before:
                store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{before}"), True)
            before = f"{i}-{name}"
    return docs
