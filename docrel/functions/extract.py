"""Strict reading of typed values from VARIANT documents: a value of another type is NULL, it is not cast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docrel.plans.schema import BSON_TYPE, OBJECT_ID, OID, ColumnPlan


def variant_path(parts: Sequence[str]) -> str:
    return "$" + "".join("['{}']".format(p.replace("\\", "\\\\").replace("'", "\\'")) for p in parts)


def at(value: Column, parts: Sequence[str]) -> Column:
    """The value at a path, itself a VARIANT."""
    return F.try_variant_get(value, variant_path(parts), "variant") if parts else value


def kind_of(value: Column) -> Column:
    """The type of a VARIANT, without the parts of arrays and objects."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z_]+", 0)


def is_void(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def strict(value: Column, kind: str) -> Column:
    """A VARIANT as a scalar type, NULL where its own type does not fit.

    Integers fit integer types within their range, and DOUBLE; other numbers fit DOUBLE only. TIMESTAMP takes
    ``{"$date": ...}`` with ISO text or milliseconds; LONG also takes ``{"$numberLong": ...}``.
    """
    own = F.schema_of_variant(value)
    whole = own == "BIGINT"
    if kind == "STRING":
        return F.when(own == "STRING", F.try_variant_get(value, "$", "string"))
    if kind in ("INT", "TINYINT"):
        return F.when(whole, F.try_variant_get(value, "$", "int" if kind == "INT" else "smallint"))
    if kind in ("LONG", "BIGINT"):
        return F.coalesce(F.when(whole, F.try_variant_get(value, "$", "bigint")), F.try_variant_get(value, "$['$numberLong']", "bigint"))
    if kind == "DOUBLE":
        return F.when(own.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(value, "$", "double"))
    if kind == "BOOLEAN":
        return F.when(own == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    date = F.try_variant_get(value, "$['$date']", "variant")
    number = F.schema_of_variant(date) == "BIGINT"
    return F.when(number, F.timestamp_millis(F.try_variant_get(date, "$", "bigint"))).otherwise(F.try_variant_get(date, "$", "timestamp"))


def leaf(element: Column, column: ColumnPlan) -> Column:
    """The column of a plan, read from the element of its table."""
    value = at(element, column.path)
    if column.type == OID:
        return F.coalesce(F.try_variant_get(value, "$['$oid']", "string"), strict(F.try_variant_get(value, "$['oid']", "variant"), "STRING"))
    if column.type == BSON_TYPE:
        return F.when(F.try_variant_get(value, "$['$oid']", "string").isNotNull(), F.lit(OBJECT_ID)).otherwise(
            strict(F.try_variant_get(value, "$['bsontype']", "variant"), "INT"))
    return strict(value, column.type)


def is_type_error(element: Column, column: ColumnPlan) -> Column:
    """Whether a value is there that does not fit the column."""
    value = at(element, column.path)
    return F.coalesce(~is_void(value) & leaf(element, column).isNull(), F.lit(False))
