"""SQL text builders for the DuckDB oracle of the registered queries.

These only produce ANSI SQL strings that compute, independently of Spark,
what each operator should return on the given tables.
"""

from __future__ import annotations

from collections.abc import Sequence


def text_of(col: str, sql_type: str) -> str:
    """Cell text of a column in DuckDB (strings as they are)."""
    return col if sql_type == "VARCHAR" else f"CAST({col} AS VARCHAR)"


def numbered(table: str, order_by: Sequence[str]) -> str:
    """``table`` with a dense 1-based ``id`` in the order of ``order_by``."""
    keys = ", ".join(order_by)
    return f"SELECT row_number() OVER (ORDER BY {keys}) AS id, * FROM {table}"


def cells(table: str, columns: Sequence[tuple[str, str]], order_by: Sequence[str],
          id_expr: str | None = None) -> str:
    """``(id, num, val)`` of every cell, nulls kept, ids by ``order_by``."""
    source = f"SELECT {id_expr} AS id, * FROM {table}" if id_expr else numbered(table, order_by)
    parts = [
        f"SELECT id, CAST({k} AS BIGINT) AS num, {text_of(c, t)} AS val FROM r"
        for k, (c, t) in enumerate(columns, start=1)
    ]
    return f"WITH r AS ({source}) " + " UNION ALL ".join(parts)


def key_value(cells_sql: str) -> str:
    """``(id, num, val)`` -> ``(key, val)``."""
    return (f"SELECT CAST(id AS VARCHAR) || ',' || CAST(num AS VARCHAR) AS key, val "
            f"FROM ({cells_sql}) c")


def quote_literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def meta_values(name: str, jsons: Sequence[str]) -> str:
    """Metadata rows ``(key, val)`` as a VALUES list."""
    rows = [f"('0,0', {quote_literal(name)})"] + [
        f"('0,{k}', {quote_literal(j)})" for k, j in enumerate(jsons, start=1)]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS m(key, val)"
