"""Column-set projections: each is one ``select``, so Catalyst fuses chains of
them into a single codegen stage and prunes what is not used downstream."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol
from cellfold.functions.text import check_supported, to_text


def string_columns(df: DataFrame, nested: str = "json") -> DataFrame:
    """Every column as text, names and order kept.

    Scalars are cast; nested values become JSON (``nested="cast"`` gives
    Spark's cast text instead); binary becomes base64.
    """
    cols = []
    for f in df.schema.fields:
        check_supported(f.name, f.dataType)
        cols.append(to_text(qcol(f.name), f.dataType, nested).alias(f.name))
    return df.select(*cols)


def prefix_columns(df: DataFrame, prefix: str = "__") -> DataFrame:
    """Rename every column to ``prefix + name``."""
    return df.toDF(*[prefix + c for c in df.columns])


def clear_columns(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """``regexp_replace`` on string columns only; others untouched."""
    cols = [
        F.regexp_replace(qcol(f.name), pattern, replacement).alias(f.name)
        if isinstance(f.dataType, T.StringType) else qcol(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def id_num_columns(df: DataFrame, key: str = "key") -> DataFrame:
    """Split the ``"id,num"`` key into ``id`` and ``num`` (long), placed first;
    the other columns follow unchanged (P4). Bad key text gives null."""
    k = qcol(key)
    comma = F.instr(k, ",")
    has = comma > 0
    rest = [qcol(c) for c in df.columns if c != key]
    # substrings around the first comma: no array per row (a second comma
    # makes ``num`` unparsable, hence null)
    return df.select(
        F.when(has, k.substr(F.lit(1), comma - 1)).try_cast("long").alias("id"),
        F.when(has, k.substr(comma + 1, F.lit(1 << 30))).try_cast("long").alias("num"),
        *rest,
    )


def any_column_matches(df: DataFrame, pattern: str) -> Column:
    """Predicate: some string column matches ``pattern``.

    False when the table has no string column.
    """
    tests = [
        F.coalesce(qcol(f.name).rlike(pattern), F.lit(False))
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    ]
    return reduce(or_, tests) if tests else F.lit(False)


def rows_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Rows with at least one string cell matching ``pattern``."""
    return df.where(any_column_matches(df, pattern))
