"""Filters in the document store's JSON dialect as columns, and predicates from dotted paths."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from docrel.plans import naming
from docrel.plans.schema import FlattenPlan

_TESTS: dict[str, Callable[[Column, Any], Column]] = {
    "$eq": lambda c, v: c.isNull() if v is None else c == F.lit(v),
    "$ne": lambda c, v: c.isNotNull() if v is None else c.isNull() | (c != F.lit(v)),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: _any([_TESTS["$eq"](c, x) for x in v if x is None] + ([c.isin([x for x in v if x is not None])] if any(x is not None for x in v) else [])),
    "$nin": lambda c, v: ~F.coalesce(_TESTS["$in"](c, v), F.lit(False)),
    "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
}


def _any(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, terms) if terms else F.lit(False)


def _all(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, terms) if terms else F.lit(True)


def condition(query: Mapping[str, Any], field: Callable[[str], Column] = F.col) -> Column:
    """The column that is true for rows that ``query`` matches; ``field`` gives the column of a dotted path.

    Plain comparisons stay plain, so that they reach the scan. Unknown operators raise a ValueError.
    """
    terms = []
    for key, value in query.items():
        if key in ("$and", "$or", "$nor"):
            parts = [condition(q, field) for q in value]
            terms.append(_all(parts) if key == "$and" else _any(parts) if key == "$or" else ~F.coalesce(_any(parts), F.lit(False)))
        elif key.startswith("$"):
            raise ValueError(f"unknown operator {key}")
        else:
            terms.append(_field(field(key), value))
    return _all(terms)


def _field(column: Column, value: Any) -> Column:
    if not isinstance(value, Mapping) or not any(k.startswith("$") for k in value):
        return _TESTS["$eq"](column, value)
    terms = []
    for key, operand in value.items():
        if key == "$oid":
            terms.append(column == F.lit(operand))
        elif key == "$not":
            terms.append(~F.coalesce(_field(column, operand), F.lit(False)))
        elif key in _TESTS:
            terms.append(_TESTS[key](column, operand))
        else:
            raise ValueError(f"unknown operator {key}")
    return _all(terms)


def by_id(plan: FlattenPlan, value: Any) -> Column:
    """Rows of the root table with an id."""
    return F.col(plan.root.id_name) == F.lit(value)


def by_ids(plan: FlattenPlan, values: Sequence[Any]) -> Column:
    return F.col(plan.root.id_name).isin(list(values))


def after(ts: tuple[int, int] | None, column: str = "ts") -> Column:
    """Log records after a point, itself left out; all of them if there is no point."""
    if ts is None:
        return F.lit(True)
    t, i = F.col(f"{column}.t"), F.col(f"{column}.i")
    # the first term alone can reach the scan
    return (t >= ts[0]) & ((t > ts[0]) | (i > ts[1]))


def oplog_of(ts: tuple[int, int] | None, namespace: str, ids: Sequence[str] | None = None) -> Column:
    """Log records of a collection after a point, and of some ids if given."""
    found = (F.col("ns") == namespace) & after(ts)
    return found if ids is None else found & F.col("rec_id").isin(list(ids))


def path_predicates(plan: FlattenPlan, path: str, id_value: Any) -> dict[str, dict[str, Any]]:
    """For an array element at ``path``: columns and values that select its row, and those of the tables below it."""
    full = ".".join([plan.collection, *path.split(".")]) if not path.startswith(plan.collection + ".") else path
    positions, seen = naming.index_map(full), naming.names_only(full)
    target = naming.table_name(seen)
    out = {}
    for table in plan.tables.values():
        flat = [plan.collection, *(p for a in table.arrays for p in a)]
        if flat[: len(seen)] != seen:
            continue
        names, at = [], [plan.collection]
        for array in table.arrays:
            at += array
            names.append("_".join(at))
        columns = [*table.ancestors, *([] if table.is_root else ["idx"])]
        found = {table.id_name: id_value}
        out[table.name] = found | {c: positions[n] for c, n in zip(columns, names, strict=True) if n in positions}
    return {target: out.pop(target), **out} if target in out else {}


def where(predicates: Mapping[str, Any]) -> Column:
    """All columns equal their values; names in order."""
    return _all([F.col(c) == F.lit(v) for c, v in sorted(predicates.items())])


def where_text(predicates: Mapping[str, Any]) -> tuple[str, list[Any]]:
    """The same as text with places for values, and the values."""
    names = sorted(predicates)
    return " and ".join(f"({c}=(%s))" for c in names), [predicates[c] for c in names]
