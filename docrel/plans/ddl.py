"""Statements that create the tables of a plan, and the same through the catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docrel.plans.schema import FlattenPlan


def qualified(table: str, schema: str = "", prefix: str = "") -> str:
    name = f'"{prefix}{table}"'
    return f'"{schema}".{name}' if schema else name


def drop_table(table: str, schema: str = "", prefix: str = "") -> str:
    return f"DROP TABLE IF EXISTS {qualified(table, schema, prefix)};"


def column_types(plan: FlattenPlan, table: str) -> dict[str, str]:
    """Columns in order with their SQL types."""
    own = plan.tables[table]
    types = {c.name: c.sql for c in own.columns} | ({} if own.is_root else {own.id_name: plan.id_sql()})
    return {c: types.get(c, "BIGINT") for c in own.column_names()}


def create_table(plan: FlattenPlan, table: str, schema: str = "", prefix: str = "") -> str:
    columns = ", ".join(f'"{c}" {t}' for c, t in column_types(plan, table).items())
    return f"CREATE TABLE IF NOT EXISTS {qualified(table, schema, prefix)} ({columns});"


#: Kinds of index: the id with all positions, the id with the ancestors' positions, the id alone.
INDEXES = ("a", "b", "c")


def index_columns(plan: FlattenPlan, table: str, kind: str) -> list[str]:
    own = plan.tables[table]
    ids = [own.id_name]
    positions = {"a": [*own.ancestors, *([] if own.is_root else ["idx"])], "b": list(own.ancestors), "c": []}[kind]
    return sorted([*ids, *positions])


def create_index(plan: FlattenPlan, table: str, kind: str, schema: str = "", prefix: str = "") -> str:
    columns = ", ".join(f'"{c}"' for c in index_columns(plan, table, kind))
    return f'CREATE INDEX "i{kind}_{prefix}{table}" ON {qualified(table, schema, prefix)} ({columns});'


def script(plan: FlattenPlan, schema: str = "", prefix: str = "") -> str:
    """Statements for all tables of a plan."""
    return "\n".join(s for t in plan.tables for s in (drop_table(t, schema, prefix), create_table(plan, t, schema, prefix)))


def create_in_catalog(spark: SparkSession, plan: FlattenPlan, database: str = "default", prefix: str = "") -> list[str]:
    """Empty parquet tables in the catalog in place of those there; returns their names."""
    names = [f"{database}.{prefix}{t}" for t in plan.tables]
    for name, table in zip(names, plan.tables, strict=True):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.createDataFrame([], plan.struct(table)).write.format("parquet").saveAsTable(name)
    return names
