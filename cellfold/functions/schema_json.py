"""One-field schema JSON in the JVM's key order, and its parser.

The metadata rows hold ``StructType([field]).json`` as the JVM writes it:
``{"type":"struct","fields":[{"name":…,"type":…,"nullable":…,"metadata":…}]}``.
PySpark's ``.json()`` sorts keys, so the text is built from ``jsonValue()``,
whose dictionaries are already in the JVM's insertion order.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T


def field_json(field: T.StructField) -> str:
    """JSON text of a one-field struct, key order as the JVM writes it."""
    return json.dumps(T.StructType([field]).jsonValue(), separators=(",", ":"),
                      ensure_ascii=False)


def parse_field_json(text: str) -> list[T.StructField]:
    """Fields of a metadata cell; a non-struct JSON value gives no field.

    Files written with quote clearing hold ``'`` for ``"``; those are accepted
    when the text does not parse as it is and holds no ``"`` at all.
    """
    try:
        value = json.loads(text)
    except json.JSONDecodeError:
        if '"' in text or "'" not in text:
            raise
        value = json.loads(text.replace("'", '"'))
    if not isinstance(value, dict) or value.get("type") != "struct":
        return []
    return list(T.StructType.fromJson(value).fields)
