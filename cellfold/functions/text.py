"""The string boundary: typed value -> cell text -> typed value.

Scalars use ``cast`` to string and ``try_cast`` back; nested values use
``to_json`` / ``from_json`` (a cast from text to array or map does not
analyse); binary uses base64. Maps whose keys are not text have no JSON object
that gives the keys back: they cross as arrays of (key, value) entries in key
order, at any depth. Types with no text form are refused up front.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType)
_REFUSED = tuple(
    t for t in (
        getattr(T, "DayTimeIntervalType", None),
        getattr(T, "YearMonthIntervalType", None),
        getattr(T, "CalendarIntervalType", None),
        getattr(T, "VariantType", None),
        getattr(T, "NullType", None),
    ) if t is not None
)

NESTED_MODES = ("json", "cast")
# nested timestamps keep their microseconds
_JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def check_supported(name: str, dt: T.DataType) -> None:
    """Raise for column types that cannot cross the string boundary."""
    if isinstance(dt, _REFUSED) or type(dt).__name__ in ("TimeType",):
        raise TypeError(f"column {name!r} of type {dt.simpleString()} has no text form")
    if isinstance(dt, T.ArrayType):
        check_supported(name, dt.elementType)
    elif isinstance(dt, T.StructType):
        for f in dt.fields:
            check_supported(f"{name}.{f.name}", f.dataType)
    elif isinstance(dt, T.MapType):
        check_supported(name, dt.keyType)
        check_supported(name, dt.valueType)


def _keyed(dt: T.DataType) -> bool:
    """Whether a type holds a map whose keys are not text."""
    if isinstance(dt, T.MapType):
        return not isinstance(dt.keyType, T.StringType) or _keyed(dt.valueType)
    if isinstance(dt, T.ArrayType):
        return _keyed(dt.elementType)
    return isinstance(dt, T.StructType) and any(_keyed(f.dataType) for f in dt.fields)


def _entries_type(dt: T.DataType) -> T.DataType:
    """The type with all maps as arrays of entries."""
    if isinstance(dt, T.MapType):
        return T.ArrayType(T.StructType([T.StructField("key", _entries_type(dt.keyType)),
                                         T.StructField("value", _entries_type(dt.valueType))]))
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_entries_type(dt.elementType))
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _entries_type(f.dataType)) for f in dt.fields])
    return dt


def _each(c: Column, dt: T.DataType, change) -> Column:
    """A value with ``change`` made to its parts; null stays null."""
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: change(x, dt.elementType))
    if isinstance(dt, T.StructType):
        parts = F.struct(*[change(c.getField(f.name), f.dataType).alias(f.name) for f in dt.fields])
        return F.when(c.isNotNull(), parts)
    return c


def as_entries(c: Column, dt: T.DataType) -> Column:
    """A value with all its maps as arrays of (key, value) entries in key order."""
    if not isinstance(dt, T.MapType):
        return _each(c, dt, as_entries)
    return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
        as_entries(e["key"], dt.keyType).alias("key"), as_entries(e["value"], dt.valueType).alias("value"))),
        lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))


def from_entries(c: Column, dt: T.DataType) -> Column:
    """The value of type ``dt`` whose maps are given as arrays of entries."""
    if not isinstance(dt, T.MapType):
        return _each(c, dt, from_entries)
    entries = F.transform(c, lambda e: F.struct(from_entries(e["key"], dt.keyType), from_entries(e["value"], dt.valueType)))
    # text with a null key is no map of this type
    return F.when(~F.exists(c, lambda e: e["key"].isNull()), F.map_from_entries(entries))


def to_text(c: Column, dt: T.DataType, nested: str = "json") -> Column:
    """Cell text of a value of type ``dt`` (null stays null)."""
    if nested not in NESTED_MODES:
        raise ValueError(f"nested must be one of {NESTED_MODES}, got {nested!r}")
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.BinaryType):
        return F.base64(c)
    if isinstance(dt, _NESTED) and nested == "json":
        return F.to_json(as_entries(c, dt) if _keyed(dt) else c, _JSON_TIMES)
    return c.cast("string")


def from_text(c: Column, dt: T.DataType) -> Column:
    """Typed value of a cell text; text that does not parse gives null."""
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.BinaryType):
        return F.try_to_binary(c, F.lit("base64"))
    if isinstance(dt, _NESTED) and _keyed(dt):
        return from_entries(F.from_json(c, _entries_type(dt), _JSON_TIMES), dt)
    if isinstance(dt, _NESTED):
        return F.from_json(c, dt, _JSON_TIMES)
    return c.try_cast(dt)


# one-line cells: the mark that says a cell is encoded, and what stands for what in it
ONE_LINE = "%="
_IN_LINE = (("%", "%p"), ("\n", "%n"), ("\r", "%r"))


def one_line(c: Column, null_text: str | None = None) -> Column:
    """Cell text without line breaks, so that a record is a line. Cells with a
    break, cells that begin with the mark and cells that read like the null text
    are encoded behind the mark; all others stay as they are."""
    body = c
    for char, code in _IN_LINE:
        body = F.replace(body, F.lit(char), F.lit(code))
    needs = c.contains("\n") | c.contains("\r") | c.startswith(ONE_LINE)
    if null_text is not None:
        needs = needs | (c == null_text)
    return F.when(needs, F.concat(F.lit(ONE_LINE), body)).otherwise(c)


def from_one_line(c: Column) -> Column:
    """The text that ``one_line`` was given."""
    body = F.substr(c, F.lit(len(ONE_LINE) + 1))
    for char, code in reversed(_IN_LINE):  # the escape character last
        body = F.replace(body, F.lit(code), F.lit(char))
    return F.when(c.startswith(ONE_LINE), body).otherwise(c)


def placeholder_literal(dt: T.DataType) -> Column:
    """A non-null literal of type ``dt``; used only to make a column non-null.

    Must be typed: a text literal cast to ``dt`` would stay nullable.
    """
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.lit(0.0).cast(dt)
    if isinstance(dt, T.DecimalType):
        return F.lit(Decimal(0)).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BinaryType):
        return F.expr("X''")
    if isinstance(dt, T.DateType):
        return F.expr("DATE'1970-01-01'")
    if isinstance(dt, T.TimestampNTZType):
        return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    if isinstance(dt, T.TimestampType):
        return F.expr("TIMESTAMP'1970-01-01 00:00:00'")
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    if isinstance(dt, T.MapType):
        return F.create_map().cast(dt)
    if isinstance(dt, T.StructType):
        return F.struct(*[placeholder_literal(f.dataType).alias(f.name) for f in dt.fields])
    raise TypeError(f"no placeholder literal for {dt.simpleString()}")


def non_null(c: Column, dt: T.DataType, name: str) -> Column:
    """``c`` declared non-null; a real null stops the job with a message.

    ``coalesce`` ends in a typed non-null literal, so Catalyst sees a non-null
    column; the ``raise_error`` branch runs before that literal is reached, so
    the literal is never returned.
    """
    failure = F.raise_error(F.lit(f"null value in non-nullable column {name}")).cast(dt)
    return F.coalesce(c, failure, placeholder_literal(dt))
