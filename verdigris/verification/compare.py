"""Compare a result with its DuckDB counterpart, row order aside."""

from __future__ import annotations

import glob
import os

import pandas as pd

_FAMILIES = {"i": "integer", "u": "integer", "f": "double", "b": "boolean"}


def register_tables(database, sf_dir: str) -> None:
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        database.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")


def _texts(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(value: object) -> str:
        if value is None or value is pd.NA or (isinstance(value, float) and value != value):
            return "null"
        if isinstance(value, (bool,)) or type(value).__name__ in ("bool_", "bool"):
            return str(bool(value))
        if isinstance(value, (int, float)) or hasattr(value, "item"):
            return repr(float(value))
        return repr(value)

    columns = [[text(value) for value in frame[name].tolist()] for name in sorted(frame.columns)]
    return sorted(zip(*columns)) if columns else []


def difference(found: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """What differs first, or None."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    for mine, theirs in zip(_texts(found), _texts(wanted)):
        if mine != theirs:
            names = sorted(found.columns)
            return str([(n, a, b) for n, a, b in zip(names, mine, theirs) if a != b])
    kinds = [
        (name, found[name].dtype.kind, wanted[name].dtype.kind)
        for name in found.columns
        if _FAMILIES.get(found[name].dtype.kind) != _FAMILIES.get(wanted[name].dtype.kind)
        and "O" not in (found[name].dtype.kind, wanted[name].dtype.kind)
    ]
    return f"types {kinds}" if kinds else None
