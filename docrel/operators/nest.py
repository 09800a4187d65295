"""Rows of child tables put back into their parents as arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.plans.schema import FlattenPlan


def nest(rows: DataFrame, keys: list[str], position: str, name: str) -> DataFrame:
    """``keys`` and an array ``name`` of the rows of each, in order of their position, without keys and position."""
    rest = [c for c in rows.columns if c not in (*keys, position)]
    held = F.array_sort(F.collect_list(F.struct(position, *rest)))
    element = (lambda x: x[rest[0]]) if len(rest) == 1 and rest[0] == name else (lambda x: F.struct(*[x[c].alias(c) for c in rest]))
    return rows.groupBy(*keys).agg(F.transform(held, element).alias(name))


def rebuild(tables: dict[str, DataFrame], plan: FlattenPlan) -> DataFrame:
    """The root rows with all child tables nested, the innermost first: one join a table on id and positions.

    A child's array has the name of its table. Documents, and elements, without children have NULL.
    """
    held = dict(tables)
    for name in sorted((t for t in plan.tables.values() if not t.is_root), key=lambda t: -len(t.arrays)):
        own = name
        parent = next(t for t in plan.tables.values() if t.arrays == own.arrays[:-1])
        nested = nest(held[own.name], [own.id_name, *own.ancestors], "idx", own.name)
        renames = {own.id_name: parent.id_name} | ({own.ancestors[-1]: "idx"} if own.ancestors else {})
        for old, new in renames.items():
            nested = nested.withColumnRenamed(old, new)
        held[parent.name] = held[parent.name].join(nested, [parent.id_name, *parent.ancestors, *([] if parent.is_root else ["idx"])], "left")
    return held[plan.collection]
