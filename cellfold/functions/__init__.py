"""Column-expression helpers shared by the operators (all JVM-side)."""

from cellfold.functions.names import qcol, quote
from cellfold.functions.schema_json import field_json, parse_field_json
from cellfold.functions.text import (
    from_text,
    non_null,
    placeholder_literal,
    to_text,
)

__all__ = [
    "field_json",
    "from_text",
    "non_null",
    "parse_field_json",
    "placeholder_literal",
    "qcol",
    "quote",
    "to_text",
]
