"""Shared text expressions: null texts are empty, words are runs of
characters other than space and the control characters 9 to 13."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def text_of(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def n_words(column: Column) -> Column:
    """Number of words as a long; null texts have none."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused_name(df, *names: str) -> list[str]:
    """Working column names that clash with none of ``df`` (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
