"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.llm import decontaminate, embedding_dedup, line_dedup, mixing, quality, secrets, sharding, simhash, url_filter, warc_zip
from docrel.llm.shared import checkpointed, shared_folder
from docrel.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (quality.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash.components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = spark.createDataFrame(secrets.labelled_samples(), "text string, label int")
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents"), secrets.gains(samples)))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives lie in the shared folder while the query runs; its rows are checkpointed before they go."""
    ship(spark)
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    try:
        return checkpointed(warc_zip.round_trip(_table(spark, sf_dir, "pages"), folder).drop("payload"))
    finally:
        warc_zip.remove(folder)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = mixing.weigh(_table(spark, sf_dir, "documents"))
    return weighed.select(
        "doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
        F.round("__factor", 6).alias("factor"), F.round("__probability", 6).alias("probability"), F.col("__keep").alias("kept"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.page_links(pages)).select("page_id", "host", "path", "rule", "verdict")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.remove_runs(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), unnumbered=True)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), shards=16)


def _pipeline() -> tuple[Callable, str | None]:
    import corpus_pipeline

    return corpus_pipeline.run, corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_embedding_dedup, op2_quality, op3_simhash, op4_secrets, op5_warc, op6_mixing, op7_url_filter, op8_line_dedup, op9_decontaminate, op10_sharding)
    return {"pipeline": _pipeline()[0], **{f.__name__: f for f in own}}


def oracle_sql() -> dict[str, str]:
    from docrel.llm.oracles import oracles

    sql = _pipeline()[1]
    return ({"pipeline": sql} if sql else {}) | oracles()
