"""Names of fields, tables and index columns, and the parts of dotted paths. All of it runs when a plan is made."""

from __future__ import annotations


def is_index(part: str) -> bool:
    return part.isascii() and part.isdigit()


def clean_name(name: str) -> str | None:
    """The name without what precedes its first letter; None if it has no letter."""
    for i, c in enumerate(name):
        if c.isalpha():
            return name[i:]
    return None


def is_id_field(name: str) -> bool:
    return clean_name(name) == "id"


def singular(name: str) -> str:
    """The name without one trailing s."""
    return name.removesuffix("s")


def table_name(path: str | list[str]) -> str:
    """The table of a path: parents singular, the last part as it is; indexes do not count."""
    parts = [clean_name(p) or p for p in names_only(path)]
    return "_".join([*map(singular, parts[:-1]), parts[-1]])


def index_column(path: str | list[str]) -> str:
    """The column that holds the position of an ancestor array."""
    return "_".join([clean_name(p) or p for p in names_only(path)]) + "_idx"


def names_only(path: str | list[str]) -> list[str]:
    return [p for p in (path.split(".") if isinstance(path, str) else path) if not is_index(p)]


def root_of(path: str) -> str:
    return path.split(".")[0]


def components(path: str) -> list[tuple[str, int | None]]:
    """``a.0.b.1`` as ``[(a, 0), (b, 1)]``; None where no index follows."""
    out: list[tuple[str, int | None]] = []
    for part in path.split("."):
        if is_index(part) and out and out[-1][1] is None:
            out[-1] = (out[-1][0], int(part))
        else:
            out.append((part, None))
    return out


def index_map(path: str) -> dict[str, int]:
    """Arrays of a path by full name, each with the 1-based position that the path gives."""
    seen: list[str] = []
    out = {}
    for name, index in components(path):
        seen.append(name)
        if index is not None:
            out["_".join(seen)] = index + 1
    return out


def initial_indexes(path: str) -> dict[str, int]:
    """Offsets for rows made from a value at ``path``: the 0-based index, so that the first row gets that index + 1."""
    return {name: position - 1 for name, position in index_map(path).items()}


def last_index(path: str) -> int | None:
    """The last number of a path plus 1, or None."""
    return next((int(p) + 1 for p in reversed(path.split(".")) if is_index(p)), None)


def split_column_path(path: str) -> tuple[str, str]:
    """A path cut after its last number: the row's path and the column's path in it."""
    parts = path.split(".")
    at = max((i + 1 for i, p in enumerate(parts) if is_index(p)), default=0)
    return ".".join(parts[:at]), ".".join(parts[at:])
