"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return False


def _canonical(c: Column, dt: T.DataType) -> Column:
    """Maps at any depth as sorted entry arrays: equal exactly when the values are."""
    if not _has_map(dt):
        return c
    if isinstance(dt, T.MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(_canonical(e["key"], dt.keyType).alias("key"), _canonical(e["value"], dt.valueType).alias("value"))))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda e: _canonical(e, dt.elementType))
    return F.when(c.isNotNull(), F.struct(*[_canonical(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))


def original(c: Column, dt: T.DataType) -> Column:
    """A value of :func:`comparable` in its own type again."""
    if not _has_map(dt):
        return c
    if isinstance(dt, T.MapType):
        return F.map_from_entries(F.transform(c, lambda e: F.struct(original(e["key"], dt.keyType).alias("key"), original(e["value"], dt.valueType).alias("value"))))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda e: original(e, dt.elementType))
    return F.when(c.isNotNull(), F.struct(*[original(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))


def comparable(df: DataFrame, name: str) -> Column:
    """A version of column ``name`` usable as a grouping / join key.

    Spark cannot group or hash on MAP values; maps at any depth are compared as
    their sorted entries.  Other types are used as they are (Spark normalises
    -0.0 / NaN in keys).
    """
    return _canonical(F.col(f"`{name}`"), df.schema[name].dataType).alias(name)


def evidence_map(cols: Iterable[str]) -> Column:
    """Row -> ``map<string,string>`` with one entry per compared column."""
    parts = []
    for c in cols:
        parts += [F.lit(c), F.col(f"`{c}`").cast("string")]
    return F.create_map(*parts)


def map_as_text(m: Column, sep: str = ";") -> Column:
    """Stable text form of a string map: ``k=v`` entries sorted by key."""
    entries = F.transform(
        F.map_entries(m),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("NULL"))),
    )
    return F.array_join(F.array_sort(entries), sep)
