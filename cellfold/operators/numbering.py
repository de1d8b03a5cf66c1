"""Row numbers over a whole table or within groups, by a sort in key ranges.

A window over a whole table, or over a group that holds much of it, runs in one
task. Here the order ``(group, keys)`` is cut into ranges first:

1. A sample of the keys gives range bounds, which become constants of the plan.
   From here on a row's range depends on the row alone, so any two executions
   agree on it.
2. A counting pass over the keys gives one row per range: its size, its first
   and last group, and the rows of the last group. From these follows how many
   rows of a range's first group lie in earlier ranges.
3. One shuffle by range and one sort within it number the rows. A row's
   position counts from its range's offset when it belongs to the range's first
   group, else from one. A group of any size spreads over as many ranges as it
   fills.

Rows that repeat in every column can outgrow a range, as one value. Such values
show as repeated bounds. Their rows are counted (combined before the shuffle)
and written out again with the numbers of their range, in blocks that spread
over the tasks, instead of being sorted.

Nothing is staged: the driver sees the sampled keys (``SAMPLE`` per range) and
one row per range. The input is read three times (row count, sample and count
read the key columns only), so it has to hold the same rows each time; give a
table or a stage, not a frame over ``rand()``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol, unused_names

SAMPLE = 20  # sampled keys per range
RANGE_ROWS = 8192  # rows per range, until the ranges are four per shuffle partition
BLOCK = 1 << 16  # repeated rows written out by one step of a task


def orderable(dt: T.DataType) -> bool:
    """Whether Spark can sort by a type (maps and variants it cannot)."""
    if isinstance(dt, T.MapType) or type(dt).__name__ == "VariantType":
        return False
    if isinstance(dt, T.ArrayType):
        return orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    return True


def _constants(values: Sequence[int]) -> Column:
    """Many numbers as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bounds(keyed: DataFrame, key: str, n: int, rows: int) -> list[list]:
    """Up to ``n - 1`` keys, as JSON values, that cut the rows into ranges of
    about equal size; a key of several ranges' rows comes several times."""
    if n < 2:
        return []
    share = min(1.0, SAMPLE * n / rows)
    sample = (keyed if share == 1 else keyed.sample(share, 17)).select(key)
    found = [r[0] for r in sample.orderBy(key).select(F.to_json(key, {"ignoreNullFields": "false"})).collect()]
    return [list(json.loads(found[len(found) * i // n]).values()) for i in range(1, n)] if found else []


def _telling(found: list[list]) -> int:
    """The least number of leading keys that tell the bounds apart as all do."""
    distinct = lambda k: len({json.dumps(b[:k]) for b in found})
    most = len(found[0])
    return next(k for k in range(1, most + 1) if distinct(k) == distinct(most))


def in_range(df: DataFrame, key: Column, at: str, bounds: Column, n: int) -> DataFrame:
    """``at``: how many of the ``n`` bounds lie at or below the key, by halving;
    a projection per step, since each step reads the one before."""
    df = df.withColumn(at, F.lit(0))
    step = 1 << n.bit_length() >> 1
    while step:
        above = F.get(bounds, F.col(at) + (step - 1)) <= key
        df = df.withColumn(at, F.when(above, F.col(at) + step).otherwise(F.col(at)))
        step >>= 1
    return df


def _offsets(counted: DataFrame, at: str, groups: list[str], n: int) -> list[int]:
    """Rows of each range's first group in earlier ranges (of all rows, without
    groups). One row per range reaches the driver."""
    if not groups:
        sizes = {r[0]: r[1] for r in counted.collect()}
        out, seen = [], 0
        for r in range(n):
            out.append(seen)
            seen += sizes.get(r, 0)
        return out
    name = lambda s: F.to_json(s, {"ignoreNullFields": "false"})
    g = [qcol(c) for c in groups]
    ends = counted.groupBy(at).agg(
        F.min(F.struct(*g)).alias("first"), F.max(F.struct(F.struct(*g).alias("g"), F.col("n"))).alias("last"))
    rows = {r[0]: r[1:] for r in ends.select(at, name(F.col("first")), name(F.col("last.g")), F.col("last.n")).collect()}
    out, group, seen = [], None, 0
    for r in range(n):
        if r not in rows:
            out.append(0)
            continue
        first, last, n_last = rows[r]
        out.append(seen if first == group else 0)
        seen = n_last + (out[-1] if first == last else 0)
        group = last
    return out


def number_rows(df: DataFrame, name: str, order_by: Sequence[str | Column],
                group_by: Sequence[str] = (), unique_keys: bool = True,
                n_ranges: int | None = None) -> DataFrame:
    """``df`` with a last column ``name``: 1, 2, ... in ascending order of the
    keys (nulls first), within each group when ``group_by`` names columns.

    ``unique_keys=False`` breaks ties by the remaining columns (maps and variants
    by their JSON), so that rows that still tie are equal and any assignment
    among them is the same result. Null groups are a group. A key may be an
    expression, but not a descending one. An empty table gives none.
    """
    given = list(df.columns)
    if name in given:
        raise ValueError(f"column {name!r} already exists")
    keys = [qcol(k) if isinstance(k, str) else k for k in (*group_by, *order_by)]
    if not unique_keys:
        named = {*group_by, *(k for k in order_by if isinstance(k, str))}
        keys += [qcol(f.name) if orderable(f.dataType) else F.to_json(F.struct(qcol(f.name)))
                 for f in df.schema.fields if f.name not in named]
    key, at, of_range = unused_names(df, "__key", "__range", "__of_range")
    keyed = df.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias(key))
    rows = df.count()
    if n_ranges is None:
        most = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n_ranges = max(1, min(most, -(-rows // RANGE_ROWS)))
    found = _bounds(keyed, key, n_ranges, rows)
    same = [json.dumps(b) for b in found]
    repeated = [] if unique_keys else [i for i in range(1, len(found)) if same[i] == same[i - 1]]
    # ranges by the leading keys alone where these tell the bounds apart
    used = len(keys) if repeated else _telling(found) if found else 0
    shape = T.StructType(keyed.schema[key].dataType.fields[:used])
    bounds = F.sort_array(F.from_json(F.lit(json.dumps([dict(zip(shape.names, b)) for b in found])), T.ArrayType(shape)))
    if used == 1:  # one key compares as itself
        ranged = in_range(df, keys[0], at, bounds["k0"], len(found))
    else:
        ranged = df.withColumn(key, F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys[:used])]))
        ranged = in_range(ranged, F.col(key), at, bounds, len(found))
    # the rows of a repeated bound have a range of their own, before the others of
    # theirs; told apart by the keys, since a filter on ``at`` would be pushed below
    # the projections and repeat them
    whole = F.lit(False)
    if repeated:
        values = [dict(zip(shape.names, found[i])) for i in repeated if i + 1 not in repeated]
        whole = F.array_contains(F.from_json(F.lit(json.dumps(values)), T.ArrayType(shape)),
                                 F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    ranged = ranged.withColumn(at, 2 * F.col(at) + F.when(whole, 0).otherwise(1))
    groups = [qcol(c) for c in group_by]
    offsets = _offsets(ranged.groupBy(at, *groups).agg(F.count(F.lit(1)).alias("n")), at, list(group_by),
                       2 * len(found) + 2)
    offset = F.element_at(_constants(offsets), F.col(at) + 1)

    out = [qcol(c) for c in given]
    # sorted by the key columns themselves, so that no copy of them is shuffled
    sorted_rows = (ranged if not repeated else ranged.where(~whole)).select(*out, at).repartition(at)
    position = F.row_number().over(Window.partitionBy(at).orderBy(*keys))
    if not groups:
        numbered = sorted_rows.select(*out, (position + offset).cast("long").alias(name))
    else:
        in_group = F.row_number().over(Window.partitionBy(at, *groups).orderBy(*keys))
        # a row belongs to its range's first group when both positions agree
        numbered = sorted_rows.withColumn(of_range, position).withColumn(name, in_group.cast("long")).select(
            *out, F.when(F.col(of_range) == F.col(name), F.col(name) + offset).otherwise(F.col(name)).alias(name))
    if not repeated:
        return numbered
    copies, block, row = unused_names(df, "__copies", "__block", "__row")
    # -0.0 and 0.0 are one value to a grouping but not the same row
    signed = [qcol(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)]
    equal = (ranged.where(whole).groupBy(at, *[k.alias(f"k{i}") for i, k in enumerate(keys)], *signed)
             .agg(F.any_value(F.struct(*out)).alias(row), F.count(F.lit(1)).alias(copies)))
    starts = F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(BLOCK).cast("long"))
    blocks = equal.select(row, copies, offset.alias(at), F.explode(starts).alias(block)).repartition(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    within = F.sequence(F.col(block) + 1, F.least(F.col(block) + BLOCK, F.col(copies)))
    return numbered.unionByName(blocks.select(row, at, F.explode(within).alias(name)).select(
        *[F.col(row)[c].alias(c) for c in given], (F.col(at) + F.col(name)).alias(name)))


def group_row_numbers(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str | Column],
                      name: str = "row_number", unique_keys: bool = True,
                      n_ranges: int | None = None) -> DataFrame:
    """``row_number()`` within the groups of real keys (W1), with no window over
    a whole group: see the module docstring and ``number_rows``."""
    if not group_by:
        raise ValueError("group_by names at least one column")
    return number_rows(df, name, order_by, group_by, unique_keys, n_ranges)
