"""Row-id strategies.

``unique``    ``monotonically_increasing_id() + 1``: one pass, no job, no
              shuffle; ids have gaps and depend on the input's partitioning.
``partition`` position within the file plus the rows of earlier files (in path
              order), for frames over Parquet files: no shuffle, and the same
              ids however the files are split into tasks. Other frames get
              ``part * max_rows + position``: unique, grouped by partition, with
              gaps when partitions are uneven.
``ordered``   dense ``1..N`` in the order of the given keys, deterministic
              (``numbering.number_rows``: key ranges, no copy of the table).

Only per-file, per-partition or per-range counts reach the driver. Frames
without file positions have counts and positions taken from one materialised
copy in the shared folder, since their partitions may differ between
executions. No strategy uses a window over the whole table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.functions.names import qcol, unused_names
from cellfold.operators.numbering import in_range, number_rows
from cellfold.session import Stages

STRATEGIES = ("unique", "partition", "ordered")

# monotonically_increasing_id() = (partition index << 33) + position
_POSITION_MASK = (1 << 33) - 1


# plans in which a row is still one row of one file
_ROW_BY_ROW = {"AdaptiveSparkPlan", "Scan parquet", "ColumnarToRow", "Filter", "Project", "Exchange", "Coalesce", "Sort"}


def _file_ids(df: DataFrame, id_col: str) -> DataFrame | None:
    """Ids from the row positions that Parquet scans report; None for a frame
    whose rows have no such position."""
    from cellfold.plans.inspect import operators
    if not operators(df) <= _ROW_BY_ROW:  # a join, a union, an explode, a distinct ...
        return None
    path, row, at = unused_names(df, "__path", "__row", "__file")
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return None
    # one row per file reaches the driver, which holds the list of files anyway
    sizes = sorted(placed.groupBy(path).agg(F.max(row) + 1).collect())
    starts, seen = [], 0
    for _, n in sizes:
        starts.append(seen)
        seen += n
    paths = F.from_json(F.lit(json.dumps([p for p, _ in sizes])), "array<string>")
    held = F.split(F.lit(",".join(map(str, starts or [0]))), ",").cast("array<bigint>")
    placed = in_range(placed, F.col(path), at, paths, len(sizes))
    return placed.select((F.element_at(held, F.greatest(F.col(at), F.lit(1))) + F.col(row) + 1).alias(id_col),
                         *[qcol(c) for c in df.columns])


def with_row_ids(df: DataFrame, strategy: str = "unique", id_col: str = "id",
                 order_by: Sequence[str | Column] | None = None,
                 unique_keys: bool = True, n_partitions: int | None = None,
                 stages: Stages | None = None) -> DataFrame:
    """``df`` with a leading non-null long ``id_col`` (>= 1) by ``strategy``.

    For ``ordered``: ``order_by`` names the sort keys (ascending, nulls first);
    ``n_partitions`` fixes the number of key ranges, else these hold about 8192
    rows up to four per shuffle partition. With ``unique_keys=False`` the
    remaining columns break ties, and rows that repeat in every column share
    out their numbers, so a hot key cannot fill one task and the result is the
    same multiset of (id, row) pairs on every run. The input is read several
    times and has to hold the same rows each time.

    ``stages`` takes the copy that ``partition`` makes of a frame without file
    positions; its owner releases it.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"ids must be one of {STRATEGIES}, got {strategy!r}")
    if id_col in df.columns:
        raise ValueError(f"column {id_col!r} already exists")
    cols = [qcol(c) for c in df.columns]

    if strategy == "unique":
        return df.select((F.monotonically_increasing_id() + 1).alias(id_col), *cols)

    if strategy == "ordered":
        if not order_by:
            raise ValueError("ids='ordered' needs order_by")
        numbered = number_rows(df, id_col, order_by, unique_keys=unique_keys, n_ranges=n_partitions)
        return numbered.select(id_col, *cols)

    found = _file_ids(df, id_col)
    if found is not None:
        return found
    part, place = unused_names(df, "__part", "__place")
    staged = (stages or Stages(df.sparkSession)).save(df.select(
        *cols,
        F.spark_partition_id().alias(part),
        (F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))).alias(place),
    ), "ids-partition")
    top = staged.agg(F.max(place).alias("m")).collect()[0]["m"]
    width = 0 if top is None else int(top) + 1
    ident = F.col(part).cast("long") * F.lit(width) + F.col(place) + F.lit(1)
    return staged.select(ident.alias(id_col), *cols)
