"""Column-name quoting: dotted, spaced or back-ticked names resolve as written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Back-tick quote a column name for ``col`` / ``expr``."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """``col`` that never splits a name at dots."""
    return F.col(quote(name))


def unused_names(df, *names: str) -> list[str]:
    """Working column names that clash with none of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
