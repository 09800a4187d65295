"""The initial load: duplicates, tables, files and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrel.functions import codec
from docrel.operators.flatten import flatten_all, parse, type_errors
from docrel.plans.ddl import script
from docrel.plans.schema import FlattenPlan

#: Bytes of a chunk of text files.
CHUNK_BYTES = 100 << 20
#: Ranges in which lines are counted.
RANGES = 256


def first_of_each(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key. One struct minimum combines before the exchange, so that a hot key costs nothing."""
    rest = [c for c in rows.columns if c not in keys]
    found = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return found.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in rows.columns])


def chunk_numbers(rows: DataFrame, order: str, line: str = "value", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``rows`` with ``chunk``: which file a line comes into if files are filled in order and closed at ``chunk_bytes``.

    ``order`` is a numeric column that tells rows apart. Rows fall into ranges of it; the bytes of a range come from a
    table of RANGES rows, those before a line in its range from a window over the range, so no task sees all rows.
    """
    cuts = rows.approxQuantile(order, [i / RANGES for i in range(1, RANGES)], 0.2 / RANGES) if RANGES > 1 else []
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order))) if cuts else F.lit(0)
    placed = rows.withColumns({"__range": place, "__bytes": F.octet_length(line) + 1})
    below = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__range").agg(F.sum("__bytes").alias("__sum")).select("__range", F.coalesce(F.sum("__sum").over(below), F.lit(0)).alias("__start"))
    before = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("__start") + F.coalesce(F.sum("__bytes").over(before), F.lit(0))
    return placed.join(starts, "__range").withColumn("chunk", F.floor(size / chunk_bytes).cast("long")).select(*rows.columns, "chunk")


def write_tsv(rows: DataFrame, folder: str, max_rows: int = 0) -> None:
    """Lines of ``rows`` in text files under ``folder``, in place of what is there; ``max_rows`` closes files."""
    codec.encode(rows).write.mode("overwrite").option("maxRecordsPerFile", max_rows).text(folder)


def init_load(texts: DataFrame, plan: FlattenPlan, folder: str, doc: str = "doc", file_format: str = "parquet") -> dict[str, int]:
    """Writes every table of JSON documents under ``folder`` with its DDL; returns the rows written by table.

    Of documents with equal ids, whatever their type, the first in order of text counts; documents without an id all count.
    Documents are written once and each table is one narrow pass over them. The stats file has a line for each table, and
    for texts that are no JSON and values that do not fit their column where there are any.
    """
    spark = texts.sparkSession
    docs = parse(texts.select(doc), doc)
    broken = docs.where(F.col(doc).isNull()).count()
    docs = docs.where(F.col(doc).isNotNull())
    if plan.root.id_name != "idx":
        names = (F.try_variant_get(F.col(doc), f"$['{n}']", "variant") for n in ("_id", "id"))
        raw = F.coalesce(*[F.when(~F.is_variant_null(v), F.to_json(v)) for v in names])
        keyed = docs.select(raw.alias("__id"), F.to_json(doc).alias("__text"))
        unique = keyed.where("__id IS NOT NULL").groupBy("__id").agg(F.min("__text").alias(doc)).select(doc)
        unique.unionByName(keyed.where("__id IS NULL").select(F.col("__text").alias(doc))).write.mode("overwrite").parquet(f"{folder}/_documents")
        docs = parse(spark.read.parquet(f"{folder}/_documents"), doc)
    counts = {}
    for name, rows in flatten_all(docs, plan, doc).items():
        target = f"{folder}/{name}"
        if file_format == "tsv":
            write_tsv(rows, target)
            counts[name] = spark.read.text(target).count()
        else:
            rows.write.mode("overwrite").format(file_format).save(target)
            counts[name] = spark.read.format(file_format).load(target).count()
    spark.createDataFrame([(script(plan),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_ddl")
    errors = [(f"error {r.table}.{r.column} {r.errors}",) for r in type_errors(docs, plan, doc).orderBy("table", "column").collect()]
    stats = [(f"{n} {c}",) for n, c in counts.items()] + ([(f"error json {broken}",)] if broken else []) + errors
    spark.createDataFrame(stats, "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_stats")
    return counts


def load_table(rows: DataFrame, name: str, sort_by: str | None = None, buckets: int = 0) -> None:
    """A catalog table in place of one of that name, in buckets of its id where asked for: what an index is for elsewhere."""
    writer = rows.write.mode("overwrite").format("parquet")
    if buckets and sort_by:
        writer = writer.bucketBy(buckets, sort_by).sortBy(sort_by)
    writer.saveAsTable(name)
