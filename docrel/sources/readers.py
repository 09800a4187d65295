"""Collections, operation logs and text tables as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrel.functions import codec, find
from docrel.functions.extract import at, kind_of
from docrel.operators import oplog
from docrel.operators.flatten import document_id, flatten_all
from docrel.plans.schema import FlattenPlan


def read_documents(spark: SparkSession, path: str, file_format: str = "json", column: str = "doc") -> DataFrame:
    """One VARIANT document a row, from lines of JSON (json, text), or from a text column of parquet and the like."""
    if file_format in ("json", "text"):
        return spark.read.text(path).where(F.trim("value") != "").select(F.try_parse_json("value").alias(column))
    return spark.read.format(file_format).load(path).select(F.try_parse_json(column).alias(column))


def find_documents(docs: DataFrame, query: Mapping[str, Any], projection: Sequence[str] | None = None, column: str = "doc") -> DataFrame:
    """Documents that a filter matches; with a projection, the named fields as VARIANT columns.

    Each comparison reads its field in the type of the value that it is compared with.
    """

    class Typed:
        """Picks the type of a field by the first value that the filter holds for it."""

        def __init__(self) -> None:
            self.kinds: dict[str, str] = {}
            self._walk(query)

        def _walk(self, q: Any, name: str | None = None) -> None:
            for k, v in q.items() if isinstance(q, Mapping) else []:
                if k in ("$and", "$or", "$nor"):
                    for part in v:
                        self._walk(part)
                elif not k.startswith("$"):
                    self._value(k, v)

        def _value(self, name: str, v: Any) -> None:
            if isinstance(v, Mapping):
                for k, x in v.items():
                    if k != "$exists":
                        self._value(name, x)
            elif isinstance(v, (list, tuple)):
                for x in v:
                    self._value(name, x)
            elif v is not None:
                kind = "boolean" if isinstance(v, bool) else "double" if isinstance(v, (int, float)) else "string"
                self.kinds.setdefault(name, kind)

        def __call__(self, name: str):
            value = at(F.col(column), name.split("."))
            kind = self.kinds.get(name, "string")
            text = F.coalesce(F.try_variant_get(value, "$['$oid']", "string"), F.try_variant_get(value, "$", "string"))
            return text if kind == "string" else F.when(~kind_of(value).isin("STRING"), F.try_variant_get(value, "$", kind))

    found = docs.where(find.condition(query, Typed()))
    return found if projection is None else found.select(*[at(F.col(column), p.split(".")).alias(p) for p in projection])


def tables_by_ids(docs: DataFrame, ids: DataFrame, plan: FlattenPlan, column: str = "doc") -> dict[str, DataFrame]:
    """All tables of the documents whose id is in the column ``id`` of ``ids``."""
    wanted = ids.select(F.col("id").alias("__id")).distinct()
    chosen = docs.withColumn("__id", document_id(plan, F.col(column))).join(wanted, "__id", "left_semi")
    return flatten_all(chosen, plan, column)


def rows_by_ids(tables: Mapping[str, DataFrame], ids: DataFrame, plan: FlattenPlan) -> dict[str, DataFrame]:
    """The target's rows of ``ids``, ordered by positions."""
    out = {}
    for name, rows in tables.items():
        own = plan.tables[name]
        wanted = ids.select(F.col("id").alias(own.id_name)).distinct()
        positions = [*own.ancestors, *([] if own.is_root else ["idx"])]
        out[name] = rows.join(wanted, own.id_name, "left_semi").select(*rows.columns).orderBy(own.id_name, *positions)
    return out


def read_oplog(spark: SparkSession, shards: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """The records of all shards; each has one or several paths of JSON lines."""
    return oplog.merge([oplog.parse(spark.read.text([p] if isinstance(p, str) else list(p)), s) for s, p in shards.items()])


def read_tsv(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows of files that ``write_tsv`` wrote. Carriage returns are escaped in them, so lines end at line feeds alone."""
    return codec.decode(spark.read.option("lineSep", "\n").text(folder), schema)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Appends to a database table; its driver must be on the class path."""
    rows.write.jdbc(url, table, mode="append", properties=dict(properties))
