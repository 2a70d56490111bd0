"""Nested one-row reports and their flat form."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(kind: T.DataType, column: Column, path: str) -> Iterator[tuple[str, Column, Column]]:
    none_number, none_label = F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, T.StructType):
        for field in kind:
            inner = f"{path}.{field.name}" if path else field.name
            yield from _leaves(field.dataType, column[field.name], inner)
    elif isinstance(kind, T.NumericType):
        yield path, column.cast("double"), none_label
    elif isinstance(kind, T.ArrayType):
        yield path, none_number, F.concat_ws(", ", column)
    else:
        yield path, none_number, column.cast("string")


def _is_listing(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def _listed(report: DataFrame, field: T.StructField) -> DataFrame:
    """The entries of an array of structs; the first member of a struct names its entry."""
    key, *members = field.dataType.elementType
    entries = report.select(F.explode(F.col(f"`{field.name}`")).alias("entry"))
    start = F.concat(F.lit(f"{field.name}."), F.col(f"entry.`{key.name}`"))
    cells = []
    for member in members:
        for path, number, label in _leaves(
            member.dataType, F.col(f"entry.`{member.name}`"), member.name
        ):
            cells += [F.concat(start, F.lit(f".{path}")), number, label]
    count = F.lit(len(cells) // 3)
    return entries.select(F.stack(count, *cells).alias("path", "number", "label"))


def facts(report: DataFrame) -> DataFrame:
    """Turn a one-row nested report into rows of (path, number, label)."""
    leaves = [
        leaf
        for field in report.schema
        if not _is_listing(field.dataType)
        for leaf in _leaves(field.dataType, F.col(f"`{field.name}`"), field.name)
    ]
    cells = [part for path, number, label in leaves for part in (F.lit(path), number, label)]
    out = report.select(F.stack(F.lit(len(leaves)), *cells).alias("path", "number", "label"))
    for field in report.schema:
        if _is_listing(field.dataType):
            out = out.unionByName(_listed(report, field))
    return out
