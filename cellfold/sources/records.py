"""Typed tables from raw records ``(…, rec long, fields array<string>)``.

Shared by the zipped-CSV and workbook sources: the unpacking runs in Python
tasks, everything after it (header removal, null text, type inference,
casting, malformed-row policy) is one JVM-side plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol
from cellfold.functions.text import from_text
from cellfold.sources.options import flag

# candidate types of inference, narrowest first; a column takes the first type
# every non-null text of it parses as, else string
_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
_CANDIDATES = [
    ("int", T.IntegerType(), None),
    ("bigint", T.LongType(), None),
    ("double", T.DoubleType(), None),
    ("boolean", T.BooleanType(), r"^(?i)(true|false)$"),
    ("date", T.DateType(), _DATE_SHAPE),
    ("timestamp", T.TimestampType(), r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}"),
]

_PROBE = 100  # records that are asked first


def cell(fields_col: str, i: int, null_value: str | None) -> F.Column:
    """Text of field ``i``; the null text (and a missing field) gives null."""
    v = F.get(F.col(fields_col), i)
    if null_value is not None:
        v = F.when(v == F.lit(null_value), F.lit(None).cast("string")).otherwise(v)
    return v


def _once(df: DataFrame, name: str, value: F.Column) -> DataFrame:
    """``df`` with ``value`` computed once a row: the optimizer copies a projected
    expression to each of its uses (a filter has several), but no generated one."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_fields(records: DataFrame, n: int, opts: Mapping[str, str]) -> DataFrame:
    """``fields`` from the CSV text ``line`` of records, by Spark's parser: the
    texts of ``n`` cells, empty ones as empty text; another number of cells shows
    in the size of the array."""
    empty = "\u0001"  # what Spark reads as null: it takes an unquoted empty cell for it
    same = {k: opts[k] for k in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace") if k in opts}
    parsed = F.from_csv("line", ", ".join([f"c{i} string" for i in range(n)] + ["odd string"]), {
        "sep": opts.get("delimiter", opts.get("sep", ",")), "quote": opts.get("quote", '"') or "\0",
        "escape": opts.get("escape", "\\") or "\0", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "odd",
        "nullValue": empty, "emptyValue": "", **same})
    found = _once(records, "parsed", parsed)
    cells = [F.col(f"parsed.c{i}") for i in range(n)]
    full = F.array(*[F.coalesce(c, F.lit("")) for c in cells])
    # too few cells leave nulls behind, too many one text more than there are columns
    other = F.array(*cells, F.lit(""))
    return _once(found, "fields", F.when(F.col("line") == "", F.array().cast("array<string>"))
                 .when(F.col("parsed.odd").isNull(), full).otherwise(other)).drop("parsed")


def safe_names(header: list[str | None], case_sensitive: bool = False) -> list[str]:
    """Column names from a header, as Spark's CSV reader makes them: an empty
    name becomes ``_c<i>`` and names that occur twice get their position."""
    keys = [(h or "") if case_sensitive else (h or "").lower() for h in header]
    return [f"_c{i}" if not h else f"{h}{i}" if keys.count(k) > 1 else h
            for i, (h, k) in enumerate(zip(header, keys))]


def parse_cell(text: F.Column, dt: T.DataType, opts: Mapping[str, str]) -> F.Column:
    """Typed value of a cell; ``dateFormat`` and ``timestampFormat`` are obeyed
    where given. Text that does not parse gives null."""
    if isinstance(dt, T.DateType) and opts.get("dateFormat"):
        return F.try_to_date(text, opts["dateFormat"])
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) and opts.get("timestampFormat"):
        return F.try_to_timestamp(text, F.lit(opts["timestampFormat"])).cast(dt)
    return from_text(text, dt)


def infer_types(texts: DataFrame, names: list[str], opts: Mapping[str, str]) -> T.StructType:
    """For each column and candidate type, does every non-null text parse? Returns
    the narrowest type per column. One aggregation pass over all records; a few
    first ones rule out the candidates that these refute already, whose parsing would
    fail on most of the others too, at the price of an exception each."""
    formats = {"date": opts.get("dateFormat"), "timestamp": opts.get("timestampFormat")}
    checks = {}
    for i, name in enumerate(names):
        v = qcol(name)
        for tag, dt, shape in _CANDIDATES:
            ok = parse_cell(v, dt, opts).isNotNull()
            if shape is not None and not formats.get(tag):
                ok = ok & v.rlike(shape)
            checks[f"{i}_{tag}"] = F.bool_and(v.isNull() | ok)

    def holds(rows: DataFrame) -> dict:
        return rows.agg(*[c.alias(k) for k, c in checks.items()]).collect()[0].asDict() if checks else {}
    first = texts.select(*[qcol(c) for c in names]).limit(_PROBE)
    probed = holds(texts.sparkSession.createDataFrame(first.collect(), first.schema))
    checks = {k: c for k, c in checks.items() if probed[k] is not False}
    row = holds(texts)
    fields = []
    for i, name in enumerate(names):
        chosen: T.DataType = T.StringType()
        for tag, dt, _ in _CANDIDATES:
            if row.get(f"{i}_{tag}"):  # None (no rows) counts as string
                chosen = dt
                break
        fields.append(T.StructField(name, chosen, True))
    return T.StructType(fields)


def typed_table(records: DataFrame, names: list[str], opts: Mapping[str, str],
                schema: T.StructType | None = None) -> DataFrame:
    """Records -> table: names, null text, inference or schema, malformed policy.

    ``mode``: ``PERMISSIVE`` keeps every record (missing fields null, extra
    ones dropped); ``DROPMALFORMED`` drops records with another field count or
    a text that does not parse as its type; ``FAILFAST`` raises on them.
    """
    null_value = opts.get("nullValue")
    names = list(names)
    if schema is not None and len(schema.fields) != len(names):
        names = schema.names
    n = len(names)
    # by position, so that no header can meet another name of the plan
    slots = [f"__cell{i}" for i in range(n)]
    texts = records.select(
        *[cell("fields", i, null_value).alias(slot) for i, slot in enumerate(slots)],
        F.size("fields").alias("__n_fields"),
    )
    if schema is None:
        if flag(opts, "inferSchema"):
            found = infer_types(texts, slots, opts)
            schema = T.StructType([T.StructField(c, f.dataType, True) for c, f in zip(names, found.fields)])
        else:
            schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    typed = [parse_cell(F.col(slot), f.dataType, opts).alias(f.name) for slot, f in zip(slots, schema.fields)]
    mode = opts.get("mode", "PERMISSIVE").upper()
    if mode == "PERMISSIVE":
        return texts.select(*typed)
    bad = F.col("__n_fields") != F.lit(n)
    for slot, f in zip(slots, schema.fields):
        if not isinstance(f.dataType, T.StringType):
            src = F.col(slot)
            bad = bad | (src.isNotNull() & parse_cell(src, f.dataType, opts).isNull())
    if mode == "DROPMALFORMED":
        return texts.where(~bad).select(*typed)
    if mode == "FAILFAST":
        # a filter predicate is evaluated on every record, so the error fires
        guard = F.when(bad, F.raise_error(F.lit("malformed record (mode FAILFAST)"))
                       ).otherwise(F.lit(True))
        return texts.where(guard).select(*typed)
    raise ValueError(f"unknown mode {mode!r}")
