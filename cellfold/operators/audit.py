"""Round-trip audit (A4) and table description.

Results are long-format ``(metric, value)`` or one row per column, built from
aggregates combined by ``union`` (no joins).
"""

from __future__ import annotations

import zlib
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol
from cellfold.functions.text import as_entries, from_text, to_text
from cellfold.operators.numbering import orderable


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return False


def _comparable_columns(df: DataFrame) -> list[Column]:
    cols = []
    for f in df.schema.fields:
        c = qcol(f.name)
        cols.append((as_entries(c, f.dataType) if _has_map(f.dataType) else c).alias(f.name))
    return cols


def comparable(df: DataFrame) -> DataFrame:
    """``df`` with map columns as sorted entry arrays, so set operations
    (``exceptAll``), which refuse maps, can compare it."""
    return df.select(*_comparable_columns(df))


def _metrics(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One aggregation of ``df`` as rows ``(metric, value)``; a null is 0."""
    rows = [F.struct(F.lit(name).alias("metric"),
                     F.coalesce(value.cast("long"), F.lit(0).cast("long")).alias("value"))
            for name, value in values.items()]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _does_not_parse(schema: T.StructType) -> Column:
    parses = F.lit(False)
    for k, f in enumerate(schema.fields, start=1):
        parses = F.when(F.col("num") == k, from_text(F.col("val"), f.dataType).isNotNull()).otherwise(parses)
    return (F.col("id") > 0) & F.col("val").isNotNull() & ~parses


def unparsed_cells(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """Data cells whose text is not null but does not parse as its column type.

    ``try_cast`` (used by restore) turns such text into null silently; this
    finds it. Cells whose ``num`` has no column are reported too.
    """
    return cells.where(_does_not_parse(schema))


def _row_hash(df: DataFrame, salt: int) -> Column:
    """Sum of a 64-bit hash of every row, folded to 63 bits."""
    total = F.sum(F.xxhash64(F.lit(salt), *[qcol(c) for c in df.columns]).cast("decimal(20,0)"))
    return F.pmod(total, F.lit(Decimal(1 << 63)))


def audit_round_trip(original: DataFrame, cells: DataFrame, restored: DataFrame,
                     exact: bool = True) -> DataFrame:
    """Prove a melt/restore round trip lost nothing (A4).

    Metrics: ``rows``, ``columns``, ``cells_expected`` (rows x columns),
    ``data_cells``, ``meta_cells``, ``restored_rows``, ``unparsed_cells``,
    ``schema_equal`` (1/0) and, where the schemas are equal, ``missing_rows`` /
    ``extra_rows`` by multiset difference. One pass over the cells gives all of
    their metrics; one pass over both tables together and one shuffle by row
    give the rest. Without ``exact`` a fingerprint per side (the sums of two
    independent 64-bit row hashes, ``original_hash_a`` ...) stands in for the
    difference, with no shuffle of rows.
    """
    n_cols = len(original.columns)
    same = restored.schema == original.schema
    cell_side = _metrics(cells, {
        "data_cells": F.count_if(F.col("id") > 0), "meta_cells": F.count_if(F.col("id") == 0),
        "unparsed_cells": F.count_if(_does_not_parse(restored.schema))})

    # literals, so that an empty table has them too
    fixed = original.sparkSession.range(1)
    if exact and same:
        slots = [f"__c{i}" for i in range(n_cols)]
        a, b = (comparable(df).toDF(*slots) for df in (original, restored))
        both = (a.withColumns({"__a": F.lit(1), "__b": F.lit(0)})
                .union(b.withColumns({"__a": F.lit(0), "__b": F.lit(1)})))
        per_row = both.groupBy(*slots).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
        tables = [_metrics(per_row, {
            "rows": F.sum("__a"), "cells_expected": F.sum("__a") * n_cols, "restored_rows": F.sum("__b"),
            "missing_rows": F.sum(F.greatest(F.col("__a") - F.col("__b"), F.lit(0))),
            "extra_rows": F.sum(F.greatest(F.col("__b") - F.col("__a"), F.lit(0)))})]
    else:
        rows = F.count(F.lit(1))
        sides = {"original": {"rows": rows, "cells_expected": rows * n_cols}, "restored": {"restored_rows": rows}}
        tables = []
        for tag, df in (("original", comparable(original)), ("restored", comparable(restored))):
            hashes = {f"{tag}_hash_a": _row_hash(df, 1), f"{tag}_hash_b": _row_hash(df, 2)} if same else {}
            tables.append(_metrics(df, sides[tag] | hashes))
    return reduce(DataFrame.unionByName, tables + [cell_side, _metrics(fixed, {
        "columns": F.max(F.lit(n_cols)), "schema_equal": F.max(F.lit(int(same)))})])


CAPACITY = 1 << 16  # differing rows that the table of ``differing_rows`` is made for
_TABLES = 3  # cells that a row falls into, one in each part of the table


def _hashed(df: DataFrame) -> DataFrame:
    """``df`` with ``h``, a hash of every row; nulls count by their place."""
    cols = _comparable_columns(df)
    return df.withColumn("h", F.xxhash64(*cols, *[c.isNull() for c in cols]))


def _peeled(cells: dict[int, list[int]], width: int) -> dict[int, int] | None:
    """The hashes that are left of both sides, with how many times more the first
    side has them; None when the cells do not come apart."""
    number = lambda text: zlib.crc32(text.encode())
    found: dict[int, int] = {}
    waiting = list(cells)
    while waiting:
        n, total, check = cells[waiting.pop()]
        if n == 0 or total % n or number(f"c:{total // n}") * n != check:
            continue  # empty, or several hashes in one cell
        h = total // n
        found[h] = found.get(h, 0) + n
        for j in range(_TABLES):
            at = j * width + number(f"{j}:{h}") % width
            cell = cells.setdefault(at, [0, 0, 0])
            cell[0], cell[1], cell[2] = cell[0] - n, cell[1] - h * n, cell[2] - number(f"c:{h}") * n
            waiting.append(at)
    return None if any(any(c) for c in cells.values()) else {h: n for h, n in found.items() if n}


def differing_rows(original: DataFrame, restored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows that two tables of equal columns do not share: their columns,
    ``side`` (``missing``: more often in the first, ``extra``: in the second),
    ``n`` (how many times more) and ``method``.

    An invertible Bloom lookup table names them without a shuffle of rows: each
    row falls into three cells, a cell adds up number, hash and check of its
    rows, and the two tables are subtracted as they are added up. What the sides
    share is gone then; cells with one hash give it away, and taking it out
    frees others. The table has 1.5 cells for each of ``capacity`` differing rows;
    it is all that reaches the driver, and the hashes found go back as a filter on
    the two tables. More differences than that do not come apart: the hashes of all
    rows are then shuffled and compared, and ``method`` says ``shuffle`` instead
    of ``sketch``.
    """
    if restored.columns != original.columns:
        raise ValueError("the tables have different columns")
    width, names = max(8, capacity // 2), original.columns
    slots = [f"c{i}" for i in range(len(names))]  # by position: no name meets one of the plan
    sides = [("missing", 1, _hashed(original.toDF(*slots))), ("extra", -1, _hashed(restored.toDF(*slots)))]
    rows = reduce(DataFrame.unionByName, [df.select("h", F.lit(sign).alias("sign")) for _, sign, df in sides])
    crc = lambda tag: F.crc32(F.concat(F.lit(tag), F.col("h").cast("string")).cast("binary"))
    places = F.array(*[F.lit(j * width) + crc(f"{j}:") % width for j in range(_TABLES)])
    summed = lambda c: F.sum((c.cast("decimal(20,0)") * F.col("sign")).cast("decimal(38,0)"))
    cells = (rows.select("h", "sign", F.explode(places).alias("at")).groupBy("at")
             .agg(F.sum("sign").alias("n"), summed(F.col("h")).alias("total"), summed(crc("c:")).alias("check"))
             .where("n <> 0 or total <> 0 or check <> 0"))
    found = _peeled({r["at"]: [r["n"], int(r["total"]), int(r["check"])] for r in cells.collect()}, width)
    if found is None:
        hashes = rows.groupBy("h").agg(F.sum("sign").alias("n")).where("n <> 0")
    else:  # no more than the cells
        hashes = F.broadcast(original.sparkSession.createDataFrame(list(found.items()), "h long, n long"))
    return reduce(DataFrame.union, [
        df.join(hashes.where(F.col("n") * sign > 0), "h").dropDuplicates(["h"]).select(
            *[F.col(s).alias(c) for s, c in zip(slots, names)], F.lit(side).alias("side"), F.abs("n").alias("n"),
            F.lit("shuffle" if found is None else "sketch").alias("method"))
        for side, sign, df in sides])


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """``n`` rows of ``df`` as cell texts: those whose text has the smallest
    SHA-256. The same rows on every run, however the table is partitioned; each
    task keeps ``n`` rows and nothing is sorted whole."""
    texts = [to_text(qcol(f.name), f.dataType) for f in df.schema.fields]
    print_ = F.sha2(F.concat_ws("\u0001", *[F.coalesce(t, F.lit("\u0002")) for t in texts]).cast("binary"), 256)
    slots = [f"c{i}" for i in range(len(texts))]
    top = df.select(print_.alias("print"), *[t.alias(s) for t, s in zip(texts, slots)]).orderBy("print", *slots).limit(n)
    return top.select(*[F.col(s).alias(c) for s, c in zip(slots, df.columns)])


QUARTILES = (0.25, 0.5, 0.75)


def profile_columns(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """One row per column with an order: ``num``, ``name``, ``n_distinct`` (about, to
    two hundredths) and ``quartiles``, three values of it as cell text (numbers,
    dates and times; null for other types), exact to the ``accuracy``-th part of
    the rows. All from mergeable sketches of one aggregation: each task keeps a
    bounded sketch per column, and nothing is sorted or shuffled but those.
    """
    fields = [(k, f) for k, f in enumerate(df.schema.fields, 1) if orderable(f.dataType)]
    numeric = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    aggs = []
    for k, f in fields:
        c = qcol(f.name)
        aggs.append(F.approx_count_distinct(c, 0.02).alias(f"d{k}"))
        if isinstance(f.dataType, numeric):
            # local times as times of the session, whose quantiles Spark takes
            plain = c.cast("timestamp") if isinstance(f.dataType, T.TimestampNTZType) else c
            aggs.append(F.percentile_approx(plain, list(QUARTILES), accuracy).cast(T.ArrayType(f.dataType)).alias(f"q{k}"))
        else:
            aggs.append(F.lit(None).cast("array<string>").alias(f"q{k}"))
    texts = lambda k, f: (F.transform(f"q{k}", lambda x: to_text(x, f.dataType)) if isinstance(f.dataType, numeric)
                          else F.col(f"q{k}"))
    rows = F.array(*[F.struct(F.lit(k).cast("long").alias("num"), F.lit(f.name).alias("name"), F.col(f"d{k}").alias("n_distinct"),
                              texts(k, f).alias("quartiles")) for k, f in fields])
    return df.agg(*aggs).select(F.inline(rows))


def describe_table(df: DataFrame, sample: int = 0) -> DataFrame:
    """One row per column: ``(num, name, type, nullable, n_rows, n_nulls)`` (D1),
    and ``least`` and ``greatest``, the bounds of its values as cell text (null
    for types without an order). ``sample`` rows of ``sample_rows`` (shown in its
    order) add ``sample``, the column's cells in them.

    All counts come from a single aggregation pass over ``df``; only the sample
    reaches the driver.
    """
    fields = df.schema.fields
    sampled = [list(r) for r in sample_rows(df, sample).collect()] if sample else []
    bound = lambda f, pick: (to_text(pick(qcol(f.name)), f.dataType) if orderable(f.dataType)
                             else F.lit(None).cast("string"))
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [x for k, f in enumerate(fields, 1) for x in (
        F.count_if(qcol(f.name).isNull()).alias(f"n{k}"), bound(f, F.min).alias(f"min{k}"), bound(f, F.max).alias(f"max{k}"))]
    cells = lambda k: [F.array(*[F.lit(r[k - 1]).cast("string") for r in sampled]).cast(
        "array<string>").alias("sample")] if sample else []
    rows = F.array(*[
        F.struct(
            F.lit(k).cast("long").alias("num"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(f.nullable).alias("nullable"),
            F.col("n_rows").alias("n_rows"),
            F.col(f"n{k}").alias("n_nulls"),
            F.col(f"min{k}").alias("least"),
            F.col(f"max{k}").alias("greatest"),
            *cells(k),
        ) for k, f in enumerate(fields, 1)
    ])
    return df.agg(*aggs).select(F.inline(rows))
