"""Put one-row aggregates of different tables side by side without a join.

Each input is a one-row aggregate. Rows are tagged, unioned and folded by a
single global aggregate (``sum`` of the value where the tag matches), which
is what a 1x1 cross join of the aggregates would give, with no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_SIDE = "_mf_side"


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """Columns of all one-row ``frames`` in one row (column names must differ)."""
    schemas = [f.schema for f in frames]
    fields = [fld for sch in schemas for fld in sch.fields]
    names = [fld.name for fld in fields]
    assert len(names) == len(set(names)), names
    types = {fld.name: fld.dataType.simpleString() for fld in fields}
    owner = {fld.name: i for i, sch in enumerate(schemas) for fld in sch.fields}
    union = None
    for i, f in enumerate(frames):
        cols = [f"{i} AS {_SIDE}"]
        cols += [f"CAST({'`' + n + '`' if owner[n] == i else 'NULL'} AS {types[n]}) AS `{n}`" for n in names]
        tagged = f.selectExpr(*cols)
        union = tagged if union is None else union.union(tagged)
    return union.selectExpr(*[f"max(CASE WHEN {_SIDE} = {owner[n]} THEN `{n}` END) AS `{n}`" for n in names])
