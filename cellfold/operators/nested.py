"""Nested-type operators: struct split / convert, array build / slice, explode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol, quote


def _first_array_column(df: DataFrame, column: str | None) -> str:
    if column is not None:
        if not isinstance(df.schema[column].dataType, T.ArrayType):
            raise ValueError(f"column {column!r} is not an array")
        return column
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            return f.name
    raise ValueError("the table has no array column")


def split_struct_column(df: DataFrame) -> DataFrame:
    """Replace each struct column by its fields, one level deep (P5)."""
    cols, names = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            for inner in f.dataType.fields:
                cols.append(F.col(f"{quote(f.name)}.{quote(inner.name)}").alias(inner.name))
                names.append(inner.name)
        else:
            cols.append(qcol(f.name))
            names.append(f.name)
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"splitting structs gives duplicate column names: {dupes}")
    return df.select(*cols)


def convert_struct_column(df: DataFrame, sep: str = ",",
                          null_text: str | None = None) -> DataFrame:
    """Each struct column -> one string: fields as text joined by ``sep``.

    Like ``concat_ws`` a null field is skipped, so positions shift; give
    ``null_text`` to write a placeholder and keep them.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            parts = []
            for inner in f.dataType.fields:
                v = F.col(f"{quote(f.name)}.{quote(inner.name)}").cast("string")
                parts.append(v if null_text is None else F.coalesce(v, F.lit(null_text)))
            cols.append(F.concat_ws(sep, *parts).alias(f.name))
        else:
            cols.append(qcol(f.name))
    return df.select(*cols)


def array_column(df: DataFrame, name: str = "arr") -> DataFrame:
    """All columns of a row -> one array column; other columns go.

    The columns must share one type: ``array`` would otherwise coerce, and
    under ANSI a string-to-number coercion fails at run time.
    """
    types = {f.dataType for f in df.schema.fields}
    if len(types) > 1:
        listed = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
        raise TypeError(f"array_column needs columns of one type, got {listed}")
    return df.select(F.array(*[qcol(c) for c in df.columns]).alias(name))


def array_to_struct(df: DataFrame, length: int, column: str | None = None,
                    name: str = "struct") -> DataFrame:
    """First (or named) array column -> ``struct<col_0 … col_{length-1}>``.

    Shorter arrays give null fields, longer ones are cut; the struct is placed
    last and the other columns are kept.
    """
    arr = _first_array_column(df, column)
    fields = [F.get(qcol(arr), i).alias(f"col_{i}") for i in range(length)]
    rest = [qcol(c) for c in df.columns if c != arr]
    return df.select(*rest, F.struct(*fields).alias(name))


def explode_column(df: DataFrame, column: str | None = None,
                   name: str = "explode") -> DataFrame:
    """A row per element of the first (or named) array column (G1).

    The element goes last as ``explode``; a null or empty array keeps one row
    with a null element.
    """
    arr = _first_array_column(df, column)
    rest = [qcol(c) for c in df.columns if c != arr]
    return df.select(*rest, F.explode_outer(qcol(arr)).alias(name))
