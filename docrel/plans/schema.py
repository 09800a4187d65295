"""Type trees and the relational tables that follow from them.

A type tree is JSON: an object is a struct, a list holds the type of its elements in its first place, a text names a
scalar type. Every array becomes a table; structs widen the table that they lie in.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from docrel.plans.naming import clean_name, is_id_field, is_index, singular

# Scalar types with their Spark type, the type in requests, and the type in created tables.
SCALARS: dict[str, tuple[T.DataType, str, str]] = {
    "STRING": (T.StringType(), "text", "TEXT"),
    "INT": (T.IntegerType(), "integer", "INTEGER"),
    "TINYINT": (T.ShortType(), "integer", "INT2"),
    "LONG": (T.LongType(), "bigint", "bigint"),
    "BIGINT": (T.LongType(), "bigint", "BIGINT"),
    "DOUBLE": (T.DoubleType(), "double precision", "FLOAT8"),
    "BOOLEAN": (T.BooleanType(), "boolean", "BOOLEAN"),
    "TIMESTAMP": (T.TimestampType(), "timestamp", "TIMESTAMP WITH TIME ZONE"),
}
OID, BSON_TYPE, OBJECT_ID = "oid", "bsontype", 7


def scalar(name: str) -> str:
    """The name in upper case; a ValueError if there is no such type."""
    if name.upper() not in SCALARS:
        raise ValueError(f"unknown type {name!r}")
    return name.upper()


def is_object_id(tree: Any) -> bool:
    return isinstance(tree, dict) and {clean_name(k) for k in tree} == {OID, BSON_TYPE}


@dataclass(frozen=True)
class ColumnPlan:
    name: str
    path: tuple[str, ...]  # from the element of the table's array, or from the document
    type: str  # a scalar type, or OID / BSON_TYPE of an object id
    sql: str  # type in a created table

    @property
    def data_type(self) -> T.DataType:
        return T.StringType() if self.type == OID else T.IntegerType() if self.type == BSON_TYPE else SCALARS[self.type][0]


@dataclass(frozen=True)
class TablePlan:
    name: str
    arrays: tuple[tuple[str, ...], ...]  # paths of the arrays from the document inwards, each from the element before
    ancestors: tuple[str, ...]  # index columns of the arrays above
    columns: tuple[ColumnPlan, ...]  # own data, by name
    id_name: str  # the column that holds the document's id
    tree: Any = field(compare=False, repr=False, default=None)

    @property
    def is_root(self) -> bool:
        return not self.arrays

    def column_names(self) -> list[str]:
        """Data with the document's id by name, then ancestor positions, outermost first, then the own position."""
        own = [c.name for c in self.columns]
        counted = self.is_root and self.id_name not in own  # a document without an id is known by a number
        ids = [] if self.is_root else [self.id_name]
        return [*sorted({*own, *ids}), *self.ancestors, *(["idx"] if counted or not self.is_root else [])]


def columns_of(tree: Any, base: tuple[str, ...] = (), prefix: str = "") -> Iterator[ColumnPlan]:
    """Columns of a struct, through structs, without its arrays."""
    for key, kind in tree.items():
        name = clean_name(key)
        if name is None or isinstance(kind, list):
            continue
        full, path = f"{prefix}_{name}" if prefix else name, (*base, key)
        if is_object_id(kind):
            yield ColumnPlan(f"{full}_{OID}", path, OID, "TEXT")
            yield ColumnPlan(f"{full}_{BSON_TYPE}", path, BSON_TYPE, "INTEGER")
        elif isinstance(kind, dict):
            yield from columns_of(kind, path, full)
        else:
            yield ColumnPlan(full, path, scalar(kind), SCALARS[scalar(kind)][2])


def arrays_of(tree: Any, base: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], Any]]:
    """``(path, element)`` of the arrays of a struct, through structs."""
    for key, kind in tree.items():
        if isinstance(kind, list):
            yield (*base, key), kind[0]
        elif isinstance(kind, dict) and not is_object_id(kind):
            yield from arrays_of(kind, (*base, key))


class FlattenPlan:
    """The tables of a collection, the root first."""

    def __init__(self, collection: str, tree: Any):
        self.collection, self.tree = collection, tree[0] if isinstance(tree, list) else tree
        self.id_columns = id_columns(self.tree)
        self.tables: dict[str, TablePlan] = {}
        self._add((), (), self.tree, [collection], ())

    def _add(self, arrays: tuple, ancestors: tuple[str, ...], element: Any, parts: list[str], own: tuple[str, ...]) -> None:
        cleaned = [clean_name(p) or p for p in parts]
        name = "_".join([*map(singular, cleaned[:-1]), cleaned[-1]])
        if isinstance(element, dict) and is_object_id(element):
            columns: list[ColumnPlan] = [ColumnPlan(f"{cleaned[-1]}_{OID}", (), OID, "TEXT"), ColumnPlan(f"{cleaned[-1]}_{BSON_TYPE}", (), BSON_TYPE, "INTEGER")]
        elif isinstance(element, dict):
            columns = list(columns_of(element))
        else:
            columns = [ColumnPlan(cleaned[-1], (), scalar(element), SCALARS[scalar(element)][2])]
        first = self.id_columns[0][0]
        root_id = f"{clean_name(self.collection) or self.collection}_{first}" if arrays else first
        self.tables[name] = TablePlan(name, arrays, ancestors, tuple(sorted(columns, key=lambda c: c.name)), root_id, element)
        if not isinstance(element, dict) or is_object_id(element):
            return
        position = ("_".join(cleaned) + "_idx",) if arrays else ()
        for path, inner in arrays_of(element):
            self._add((*arrays, path), ancestors + position, inner, [*parts, *path], path)

    @property
    def root(self) -> TablePlan:
        return self.tables[self.collection]

    def table_names(self) -> list[str]:
        return list(self.tables)

    def id_sql(self) -> str:
        """The type of the id in created tables."""
        return next((c.sql for c in self.root.columns if c.name == self.root.id_name), "BIGINT")

    def struct(self, table: str) -> T.StructType:
        """The Spark schema of a table."""
        plan, types = self.tables[table], {c.name: c.data_type for c in self.tables[table].columns}
        own = next((c.data_type for c in self.root.columns if c.name == self.root.id_name), T.LongType())
        kinds = {plan.id_name: own} | types
        return T.StructType([T.StructField(c, kinds.get(c, T.LongType())) for c in plan.column_names()])


def id_columns(tree: Any) -> list[tuple[str, str]]:
    """``(column, type)`` of the id: an object id in ``id`` or ``_id`` first, then a scalar one, else ``idx``."""
    held = [(k, v) for k, v in tree.items() if is_id_field(k)]
    for _, kind in held:
        if is_object_id(kind):
            return [(f"id_{OID}", "STRING"), (f"id_{BSON_TYPE}", "INT")]
    for _, kind in held:
        if isinstance(kind, str):
            return [("id", scalar(kind))]
    return [("idx", "BIGINT")]


def parse_schema(text: str, collection: str) -> FlattenPlan:
    return FlattenPlan(collection, json.loads(text))


def read_schemas(folder: str | Path) -> dict[str, FlattenPlan]:
    """Every ``.js`` and ``.json`` file of a folder, in order of names, as the plan of the collection it is named after."""
    files = sorted(p for p in Path(folder).iterdir() if p.suffix in (".js", ".json"))
    return {p.stem: parse_schema(p.read_text(), p.stem) for p in files}


def part_of(tree: Any, path: str) -> Any:
    """The sub-tree at a dotted path, without regard to numbers; None if there is none."""
    for part in (p for p in path.split(".") if p and not is_index(p)):
        tree = tree[0] if isinstance(tree, list) else tree
        if not isinstance(tree, dict) or part not in tree:
            return None
        tree = tree[part]
    return tree


def is_located(tree: Any, path: str) -> bool:
    return part_of(tree, path) is not None


def leaves(tree: Any, base: str = "") -> list[str]:
    """Dotted paths of a struct's leaves; an array is a leaf, written with ``[]``."""
    out = []
    for key, kind in (tree[0] if isinstance(tree, list) else tree).items():
        at = f"{base}.{key}" if base else key
        out += [f"{at}[]"] if isinstance(kind, list) else leaves(kind, at) if isinstance(kind, dict) else [at]
    return out
