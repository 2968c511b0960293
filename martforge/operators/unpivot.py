"""Unpivot columns of a row into (label, value...) rows with ``stack``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _lit_sql(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def unpivot_rows(df: DataFrame, rows: list[tuple], names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Turn each input row into ``len(rows)`` rows.

    ``rows`` holds tuples of literals (python values) or column expressions
    given as SQL strings prefixed by ``@`` (e.g. ``"@source_valid_rows"``).
    """
    width = len(names)
    parts = []
    for r in rows:
        assert len(r) == width
        for v in r:
            parts.append(v[1:] if isinstance(v, str) and v.startswith("@") else _lit_sql(v))
    expr = f"stack({len(rows)}, {', '.join(parts)}) AS ({', '.join(names)})"
    return df.select(*(keep or []), F.expr(expr))
