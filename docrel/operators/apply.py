"""Log records folded into the current state of documents.

The fold is per document: an array of its records in order meets its state, one row a document, in Arrow batches.
Records before a document's last reset (insert, delete or replacement) cannot matter and never reach Python.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.plans.naming import is_index

#: A position further than this behind an array's end is refused, so that one record cannot fill memory.
LARGEST_GAP = 100_000


def assign(doc: Any, parts: list[str], value: Any) -> Any:
    """``doc`` with ``value`` at a path; what is missing is made, an array is filled up with nulls."""
    if not parts:
        return value
    head, rest = parts[0], parts[1:]
    if is_index(head) and (isinstance(doc, list) or not isinstance(doc, dict)):
        doc, at = doc if isinstance(doc, list) else [], int(head)
        if at - len(doc) > LARGEST_GAP:
            raise ValueError(f"position {at} in an array of {len(doc)}")
        doc.extend([None] * (at + 1 - len(doc)))
        doc[at] = assign(doc[at], rest, value)
        return doc
    doc = doc if isinstance(doc, dict) else {}
    doc[head] = assign(doc.get(head), rest, value)
    return doc


def remove(doc: Any, parts: list[str]) -> None:
    """Takes away what is at a path; an array element becomes null, so that others keep their places."""
    for part in parts[:-1]:
        if isinstance(doc, dict):
            doc = doc.get(part)
        elif isinstance(doc, list) and is_index(part) and int(part) < len(doc):
            doc = doc[int(part)]
        else:
            return
    last = parts[-1]
    if isinstance(doc, dict):
        doc.pop(last, None)
    elif isinstance(doc, list) and is_index(last) and int(last) < len(doc):
        doc[int(last)] = None


def fold(state: Any, ops: Iterable[tuple[str, Any]]) -> Any:
    """The state after ``(op, o)`` records in order; None stands for a document that is not there.

    An insert sets the state, a delete clears it, an update of an absent document does nothing. An update applies
    ``$set`` and then ``$unset``; without either it replaces the document, whose id stays.
    """
    for op, o in ops:
        if op == "i":
            state = o
        elif op == "d":
            state = None
        elif op == "u" and state is not None and o is not None:
            if not any(k.startswith("$") for k in o):
                state = {k: v for k, v in state.items() if k in ("_id", "id")} | o
                continue
            for path, value in (o.get("$set") or {}).items():
                state = assign(state, path.split("."), value)
            for path in o.get("$unset") or {}:
                remove(state, path.split("."))
    return state


def fold_json(states: Column, ops: Column) -> Column:
    """The fold on JSON texts; ``ops`` is an array of ``(op, o)``."""

    @F.pandas_udf("string")
    def folded(states: pd.Series, ops: pd.Series) -> pd.Series:
        out = []
        for state, records in zip(states, ops, strict=True):
            found = fold(json.loads(state) if state else None, [(r["op"], json.loads(r["o"]) if r["o"] else None) for r in ([] if records is None else records)])
            out.append(None if found is None else json.dumps(found, ensure_ascii=False, separators=(",", ":")))
        return pd.Series(out, dtype=object)

    return folded(states, ops)


def since_reset(records: DataFrame) -> DataFrame:
    """Records from the last insert or delete of their document on.

    The last reset is an aggregate, so a document with very many records combines before the exchange, and the join
    with one row a document is one that adaptive execution can split. A replacement is no reset: it keeps the id and
    has no effect on an absent document.
    """
    at = F.struct(F.col("ts.t").alias("t"), F.col("ts.i").alias("i"), F.col("shard").alias("s"))
    last = records.where(F.col("op").isin("i", "d")).groupBy("collection", "rec_id").agg(F.max(at).alias("__last"))
    met = records.withColumn("__at", at).join(last, ["collection", "rec_id"], "left")
    return met.where(F.col("__last").isNull() | (F.col("__at") >= F.col("__last"))).select(*records.columns)


def apply(state: DataFrame, records: DataFrame) -> DataFrame:
    """``collection, rec_id, doc, existed`` of every document that ``records`` touch; ``doc`` is NULL where it is gone.

    ``state`` has ``collection, rec_id, doc`` with JSON texts. One exchange by document on either side.
    """
    at = F.struct(F.col("ts.t").alias("t"), F.col("ts.i").alias("i"), "shard", "op", "o")
    ops = since_reset(records).groupBy("collection", "rec_id").agg(F.array_sort(F.collect_list(at)).alias("ops"))
    met = ops.join(state.select("collection", "rec_id", "doc"), ["collection", "rec_id"], "left")
    steps = F.transform("ops", lambda x: F.struct(x["op"].alias("op"), x["o"].alias("o")))
    return met.select("collection", "rec_id", fold_json(F.col("doc"), steps).alias("doc"), F.col("doc").isNotNull().alias("existed"))


def next_state(state: DataFrame, records: DataFrame) -> DataFrame:
    """The whole state after ``records``."""
    changed = apply(state, records)
    kept = state.join(records.select("collection", "rec_id").distinct(), ["collection", "rec_id"], "left_anti")
    return kept.select("collection", "rec_id", "doc").unionByName(changed.where("doc IS NOT NULL").select("collection", "rec_id", "doc"))


def fold_columns(records: DataFrame, keys: list[str], order: Column, op: Column, values: dict[str, tuple[Column, Column]]) -> DataFrame:
    """The fold without Python, where records set whole columns: ``keys`` and the columns of ``values``.

    ``values`` gives for each column whether a record touches it and what it sets. After the last insert each column
    has the value of the last record that touches it; documents whose last reset is a delete, or that were never
    inserted, are left out. Partial aggregates combine before the one exchange, so a hot document costs nothing.
    """
    marked = records.withColumns({"__order": order, "__op": op} | {f"__t_{n}": t for n, (t, _) in values.items()} | {f"__v_{n}": v for n, (_, v) in values.items()})
    reset = F.col("__op").isin("i", "d")
    aggregates = [F.max(F.when(reset, F.col("__order"))).alias("__reset"), F.max_by("__op", F.when(reset, F.col("__order"))).alias("__last")]
    for n in values:
        when = F.when(F.col(f"__t_{n}"), F.col("__order"))
        aggregates += [F.max(when).alias(f"__o_{n}"), F.max_by(F.struct(F.col(f"__v_{n}").alias("v")), when).alias(f"__w_{n}")]
    found = marked.groupBy(*keys).agg(*aggregates).where(F.col("__last") == "i")
    return found.select(*keys, *[F.when(F.col(f"__o_{n}") >= F.col("__reset"), F.col(f"__w_{n}.v")).alias(n) for n in values])


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``changes`` in place of those with equal keys."""
    return target.join(changes.select(*keys), keys, "left_anti").select(*target.columns).unionByName(changes.select(*target.columns))
