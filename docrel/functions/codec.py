"""Tab-separated text as bulk loading takes it, and texts of timestamps of the operation log."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL = "\\N"
# Characters that are escaped, in this order, and how they are written.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def escape(value: Column) -> Column:
    """A value as text with its control characters escaped; NULL stays NULL."""
    text = value.cast("string")
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """What ``escape`` was given."""

    def part(x: Column) -> Column:
        for raw, written in ESCAPES[1:]:
            x = F.replace(x, F.lit(written), F.lit(raw))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def encode(df: DataFrame, name: str = "value") -> DataFrame:
    """One line for each row: its values escaped, joined by tabs, with NULL as the marker. A text that is the marker is escaped."""
    line = F.concat_ws("\t", *[F.coalesce(escape(F.col(c)), F.lit(NULL)) for c in df.columns])
    return df.select(line.alias(name))


def decode(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Rows of ``schema`` from lines that ``encode`` wrote."""
    parts = F.split(F.col(line), "\t")
    cells = [F.get(parts, F.lit(i)) for i in range(len(schema))]
    return lines.select(*[F.when(c != NULL, unescape(c)).cast(f.dataType).alias(f.name) for c, f in zip(cells, schema, strict=True)])


def timestamp_text(ts: Column) -> Column:
    """``Timestamp(t, i)`` of a struct of t and i; ``None`` for NULL."""
    return F.coalesce(F.concat(F.lit("Timestamp("), ts["t"], F.lit(", "), ts["i"], F.lit(")")), F.lit("None"))


def timestamp_value(text: Column) -> Column:
    """The struct of a text that ``timestamp_text`` wrote."""
    pattern = r"^Timestamp\((\d+), (\d+)\)$"
    return F.when(text.rlike(pattern), F.struct(
        F.regexp_extract(text, pattern, 1).cast("long").alias("t"), F.regexp_extract(text, pattern, 2).cast("long").alias("i")))


def points_text(points: dict[str, tuple[int, int] | None]) -> str:
    """Sync points of shards as one text, in order of shards."""
    return ";".join("None" if p is None else f"Timestamp({p[0]}, {p[1]})" for _, p in sorted(points.items()))


def points_value(text: str | None, shards: list[str]) -> dict[str, tuple[int, int] | None]:
    """Sync points of ``shards`` from their text; a ValueError if their number differs."""
    parts = text.split(";") if text else ["None"] * len(shards)
    if len(parts) != len(shards):
        raise ValueError(f"{len(parts)} sync points for {len(shards)} shards")
    found = [re.fullmatch(r"Timestamp\((\d+), (\d+)\)", p) for p in parts]
    return {s: (int(m[1]), int(m[2])) if m else None for s, m in zip(sorted(shards), found, strict=True)}
