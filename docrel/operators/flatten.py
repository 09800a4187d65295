"""Documents as the rows of relational tables.

Each table is one narrow chain of ``posexplode`` over its own arrays: no shuffle, and siblings never meet.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrel.functions import extract
from docrel.plans import naming
from docrel.plans.schema import FlattenPlan, TablePlan, part_of


def parse(docs: DataFrame, text: str = "doc") -> DataFrame:
    """``docs`` with its column of JSON texts as VARIANT; texts that are no JSON become NULL."""
    return docs.withColumn(text, F.try_parse_json(F.col(text)))


def document_id(plan: FlattenPlan, doc: Column) -> Column:
    """The id of a document; a number by its place in the input where the schema has none."""
    column = next((c for c in plan.root.columns if c.name == plan.root.id_name), None)
    return extract.leaf(doc, column) if column else F.monotonically_increasing_id() + 1


def _elements(docs: DataFrame, plan: FlattenPlan, table: TablePlan, doc: str, key: Column | None = None) -> DataFrame:
    """``__id``, ``__e`` (the element) and ``__p0, __p1, ...`` (positions from 1) of a table's rows."""
    # a filter on documents would be pushed below their parsing and parse them twice; one inside a generator is not
    rows = docs.select(*([] if key is None else [key.alias("__key")]), F.explode(F.array_compact(F.array(F.col(doc)))).alias("__e"))
    rows = rows.select((document_id(plan, F.col("__e")) if key is None else F.col("__key")).alias("__id"), "__e")
    for depth, path in enumerate(table.arrays):
        array = F.try_variant_get(F.col("__e"), extract.variant_path(path), "array<variant>")
        before = [f"__p{i}" for i in range(depth)]
        rows = rows.select("__id", *before, F.posexplode(array).alias("__pos", "__e"))
        # an element that is null keeps its place but is no row
        rows = rows.where(~extract.is_void(F.col("__e"))).select("__id", *before, (F.col("__pos") + 1).cast("long").alias(f"__p{depth}"), "__e")
    return rows


def flatten(docs: DataFrame, plan: FlattenPlan, table: str, doc: str = "doc") -> DataFrame:
    """The rows of one table from VARIANT documents in the column ``doc``."""
    own = plan.tables[table]
    rows = _elements(docs, plan, own, doc)
    found: dict[str, Column] = {own.id_name: F.col("__id")} | {c.name: extract.leaf(F.col("__e"), c) for c in own.columns}
    found |= {name: F.col(f"__p{i}") for i, name in enumerate([*own.ancestors, *([] if own.is_root else ["idx"])])}
    return rows.select(*[found[c].alias(c) for c in own.column_names()])


def flatten_all(docs: DataFrame, plan: FlattenPlan, doc: str = "doc") -> dict[str, DataFrame]:
    """All tables of a plan. Persist or write ``docs`` first if parsing it is dear: each table reads it once."""
    return {name: flatten(docs, plan, name, doc) for name in plan.tables}


def type_errors(docs: DataFrame, plan: FlattenPlan, doc: str = "doc") -> DataFrame:
    """``(table, column, errors)``: values that do not fit their column; columns without any are left out."""

    def of(table: TablePlan) -> DataFrame:
        marks = F.array(*[F.when(extract.is_type_error(F.col("__e"), c), F.lit(c.name)) for c in table.columns])
        return _elements(docs, plan, table, doc).select(F.lit(table.name).alias("table"), F.explode(F.array_compact(marks)).alias("column"))

    every = reduce(DataFrame.unionByName, [of(t) for t in plan.tables.values() if t.columns])
    return every.groupBy("table", "column").agg(F.count(F.lit(1)).alias("errors"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, n)`` of each table."""
    return reduce(DataFrame.unionByName, [
        df.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()])


def with_offsets(rows: DataFrame, offsets: dict[str, int]) -> DataFrame:
    """``rows`` with a number added to each of the named position columns that it has."""
    return rows.withColumns({c: F.col(c) + n for c, n in offsets.items() if c in rows.columns})


def flatten_partial(values: DataFrame, plan: FlattenPlan, path: str, value: str = "value", key: str = "id") -> dict[str, DataFrame]:
    """Tables of a value that belongs at a dotted path of a document, with positions as in the whole document.

    ``values`` has the document's id as text and the value as VARIANT. Only the table of the path and those below
    it appear; a path outside the schema gives none.
    """
    names = naming.names_only(path)
    if part_of(plan.tree, path) is None:
        return {}
    full = ".".join([plan.collection, *path.split(".")])
    offsets, below = naming.index_map(full), {}
    text = F.to_json(F.col(value))
    parts = naming.components(path)
    for i in range(len(parts) - 1, -1, -1):
        name, index = parts[i]
        whole = isinstance(part_of(plan.tree, ".".join(n for n, _ in parts[: i + 1])), list)
        text = F.concat(F.lit('{"%s":' % name + ("[" if whole and index is not None else "")), text, F.lit(("]" if whole and index is not None else "") + "}"))
    docs = values.select(F.col(key).alias("__key"), F.try_parse_json(text).alias("doc"))
    for table in plan.tables.values():
        flat = [p for a in table.arrays for p in a]
        if flat[: len(names)] != names:
            continue
        rows = _elements(docs, plan, table, "doc", F.col("__key"))
        found: dict[str, Column] = {c.name: extract.leaf(F.col("__e"), c) for c in table.columns} | {table.id_name: F.col("__id")}
        paths, seen = [], [plan.collection]
        for array in table.arrays:
            seen += list(array)
            paths.append("_".join(seen))
        for i, name in enumerate([*table.ancestors, *([] if table.is_root else ["idx"])]):
            found[name] = F.col(f"__p{i}") + (offsets[paths[i]] - 1 if paths[i] in offsets else 0)
        below[table.name] = rows.select(*[found[c].alias(c) for c in table.column_names()])
    return below


def max_positions(rows: DataFrame, columns: Iterable[str] = ("idx",)) -> DataFrame:
    """The largest of each position column, 0 where there is none."""
    return rows.agg(*[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(f"max_{c}") for c in columns])


def remove_elements(rows: DataFrame, goes: Column, keys: list[str], position: str = "idx") -> DataFrame:
    """``rows`` without elements where ``goes`` holds; those behind them in the same array move up.

    ``keys`` name the array that a row belongs to. A row's shift is the number of removed positions before its own,
    so the rows of an array need one exchange on its keys.
    """
    before = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("__goes", F.coalesce(goes, F.lit(False)))
    shifted = marked.withColumn(position, F.col(position) - F.sum(F.col("__goes").cast("long")).over(before))
    return shifted.where(~F.col("__goes")).drop("__goes")
