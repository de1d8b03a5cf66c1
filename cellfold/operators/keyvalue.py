"""Key-value form of a table: melt (T1, T2), describe (T3), recover (T4),
restore (T5) and the combined export (T8).

Inside the engine a cell is ``(id long, num long, val string)``; the text key
``"id,num"`` is built only at the edge (``key_value_columns``) and parsed back
by ``id_num_columns``. Row id 0 is reserved for metadata: ``0,0`` holds the
table name and ``0,k`` the one-field schema JSON of column ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol
from cellfold.functions.schema_json import field_json, parse_field_json
from cellfold.functions.text import check_supported, from_text, non_null, to_text
from cellfold.operators.columns import id_num_columns
from cellfold.operators.ids import with_row_ids
from cellfold.operators.partitions import spread_input
from cellfold.plans.inspect import exchanges
from cellfold.session import ship_package

_ID = "__cellfold_id"
RESTORE_MODES = ("strict", "lenient")
BAD_TEXT = ("null", "raise")
SLOTS = 64  # columns gathered by one aggregation: a bit of a long each
CELLS_PER_TASK = 2_000_000  # of a restore after its shuffle, where the number of cells is known


# ---------------------------------------------------------------- melt side

def _ids(df: DataFrame, ids: str, order_by, id_col: str | Column | None,
         unique_keys: bool, stages=None) -> tuple[DataFrame, Column, list[str]]:
    """(frame with an id column, that column, the data columns)."""
    if id_col is not None:
        ident = (qcol(id_col) if isinstance(id_col, str) else id_col).cast("long")
        # id 0 is the metadata's: such rows would be read as the table's description
        found = F.concat(F.lit("row ids have to be 1 or more, found "), F.coalesce(ident.cast("string"), F.lit("null")))
        return df, F.when(ident >= 1, ident).otherwise(F.raise_error(found).cast("long")), list(df.columns)
    with_id = with_row_ids(df, ids, id_col=_ID, order_by=order_by,
                           unique_keys=unique_keys, stages=stages)
    return with_id, F.col(_ID), list(df.columns)


def number_cells(df: DataFrame, ids: str = "unique",
                 order_by: Sequence[str | Column] | None = None,
                 unique_keys: bool = True) -> DataFrame:
    """Column ``i`` (1-based) -> ``key_<c> = struct(key struct(id, num=i), val)``.

    Values keep their types; ``id`` comes from the chosen id strategy.
    """
    framed, ident, data = _ids(df, ids, order_by, None, unique_keys)
    out = []
    for i, c in enumerate(data, start=1):
        key = F.struct(ident.alias("id"), F.lit(i).cast("long").alias("num"))
        out.append(F.struct(key.alias("key"), qcol(c).alias("val")).alias(f"key_{c}"))
    return framed.select(*out)


def melt_cells(df: DataFrame, ids: str = "unique",
               order_by: Sequence[str | Column] | None = None,
               id_col: str | Column | None = None, columns: Sequence[str] | None = None,
               nested: str = "json", unique_keys: bool = True,
               spread: bool = True, stages=None) -> DataFrame:
    """One row per cell: ``(id long, num long, val string)`` (T2 core, G2).

    ``num`` is the 1-based position of the column in ``df``; ``columns``
    melts only those (positions kept) so the scan reads only them. Null cells
    are kept with a null ``val``. ``id_col`` takes ids from an existing unique
    column (>= 1) instead of generating them, which also works on a streaming
    frame; that column is melted like the others. ``spread`` spreads a
    coarsely split input over the default parallelism first (``spread_input``).
    """
    if len(set(df.columns)) != len(df.columns):
        if id_col is not None or columns is not None:
            raise ValueError("id_col and columns need unique column names")
        # duplicate names: melt by position under positional names
        first = {}
        for i, c in enumerate(df.columns):
            first.setdefault(c, f"__cellfold_c{i}")
        order_by = [first.get(k, k) if isinstance(k, str) else k for k in (order_by or [])]
        df = df.toDF(*[f"__cellfold_c{i}" for i in range(len(df.columns))])
    if columns is not None:
        positions = {c: i for i, c in enumerate(df.columns, start=1)}
        wanted = [c for c in df.columns if c in set(columns)]
        missing = set(columns) - set(wanted)
        if missing:
            raise ValueError(f"unknown columns {sorted(missing)}")
        keep = list(wanted)
        if ids == "ordered":
            keep += [k for k in (order_by or []) if isinstance(k, str) and k not in keep]
        # an id column stays for the ids; Spark prunes what is not read
        source = df if id_col is not None else df.select(*[qcol(c) for c in keep])
    else:
        positions = {c: i for i, c in enumerate(df.columns, start=1)}
        wanted = list(df.columns)
        source = df
    if spread and id_col is None and ids != "ordered":
        # ordered ids range-partition anyway; the others would inherit the scan's
        # splits, which for a coarsely split input means one core
        source = spread_input(source)
    framed, ident, _ = _ids(source, ids, order_by, id_col, unique_keys, stages)
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for c in wanted:
        check_supported(c, types[c])
        pairs += [F.lit(positions[c]).cast("long"), to_text(qcol(c), types[c], nested)]
    if not pairs:
        return framed.select(ident.alias("id"), F.lit(None).cast("long").alias("num"),
                             F.lit(None).cast("string").alias("val")).where(F.lit(False))
    # ``stack`` emits the (num, val) pairs of a row straight from the generator,
    # without building an array of structs per row first
    cells = F.stack(F.lit(len(wanted)), *pairs).alias("num", "val")
    return framed.select(ident.alias("id"), cells)


def cells_to_key_value(cells: DataFrame) -> DataFrame:
    """``(id, num, val)`` -> ``(key = "id,num", val)``."""
    return cells.select(
        F.concat_ws(",", F.col("id").cast("string"), F.col("num").cast("string")).alias("key"),
        F.col("val"),
    )


def key_value_columns(df: DataFrame, ids: str = "unique",
                      order_by: Sequence[str | Column] | None = None,
                      id_col: str | Column | None = None,
                      columns: Sequence[str] | None = None,
                      nested: str = "json", unique_keys: bool = True,
                      spread: bool = True) -> DataFrame:
    """Melt to the two-column form ``(key string, val string)``.

    rows x columns rows, nulls kept. With ``ids="unique"`` (default) the plan
    is a single scan -> project -> generate stage: no shuffle, no job before it.
    """
    return cells_to_key_value(melt_cells(df, ids, order_by, id_col, columns, nested,
                                         unique_keys, spread))


# ------------------------------------------------------------ metadata side

def meta_rows(schema: T.StructType, name: str | None) -> list[tuple[int, int, str]]:
    """``(0, 0, name)`` then ``(0, k, one-field schema JSON)`` for each column."""
    rows = [] if name is None else [(0, 0, name)]
    for k, f in enumerate(schema.fields, start=1):
        check_supported(f.name, f.dataType)
        rows.append((0, k, field_json(f)))
    return rows


def meta_cells(spark: SparkSession, schema: T.StructType, name: str | None) -> DataFrame:
    """Metadata as ``(id, num, val)`` cells; built on the driver from the schema."""
    return spark.createDataFrame(meta_rows(schema, name),
                                 "id long, num long, val string")


def meta_columns(df: DataFrame, name: str) -> DataFrame:
    """Describe ``df`` in the key-value shape (T3): n+1 rows sorted by num.

    Runs no job over the data: the rows come from ``df.schema`` alone.
    """
    rows = [(f"{i},{n}", v) for i, n, v in meta_rows(df.schema, name)]
    # one partition, rows in num order (merging keeps the list's order)
    return df.sparkSession.createDataFrame(rows, "key string, val string").coalesce(1)


def _meta_only(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("id") == 0)


def schema_name(cells: DataFrame) -> tuple[T.StructType, str | None]:
    """Recover ``(schema, name)`` from ``(id, num, val)`` cells (T4).

    Columns are ordered by ``num``; non-struct JSON is ignored; no name row
    gives ``None``. Only the id-0 rows are collected (one per column).
    """
    meta = _meta_only(cells).select("num", "val").collect()
    names = [r["val"] for r in meta if r["num"] == 0]
    if len(names) > 1:
        raise ValueError("several name rows (0,0) in the metadata")
    fields: list[T.StructField] = []
    for row in sorted((r for r in meta if r["num"] is not None and r["num"] > 0),
                      key=lambda r: r["num"]):
        try:
            fields.extend(parse_field_json(row["val"]))
        except ValueError as e:
            raise ValueError(f"metadata cell 0,{row['num']} is not the JSON of a field: {row['val']!r:.200}") from e
    return T.StructType(fields), (names[0] if names else None)


def schema_frame(cells: DataFrame) -> DataFrame:
    """Recovered schema as rows ``(num, name, type, nullable)``, in Spark (T4).

    ``type`` is the JSON type text (a plain name for scalars). The frame filters
    the id-0 rows of the whole cell table; nothing is collected.
    """
    meta = _meta_only(cells).where(F.col("num") > 0)
    return meta.select(
        F.col("num"),
        F.get_json_object("val", "$.fields[0].name").alias("name"),
        F.get_json_object("val", "$.fields[0].type").alias("type"),
        F.get_json_object("val", "$.fields[0].nullable").try_cast("boolean").alias("nullable"),
    ).where(F.col("name").isNotNull())


def _packed(n: int):
    """An Arrow step that makes one row of cells that lie together: ``id``, for
    more than ``SLOTS`` columns their group ``g``, the number ``n`` of cells, a bit
    ``seen`` per column and the texts ``c<slot>``. A row ends where the id changes or the
    column numbers do not ascend, so no cell comes twice in one."""
    width = min(n, SLOTS)

    def pack(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, num = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            group, slot = np.divmod(num - 1, SLOTS)
            breaks = (ids[1:] != ids[:-1]) | (group[1:] != group[:-1]) | (slot[1:] <= slot[:-1])
            starts = np.append(0, np.flatnonzero(breaks) + 1)
            sizes = np.diff(np.append(starts, len(ids)))
            row = np.repeat(np.arange(len(starts)), sizes)
            bits = np.left_shift(np.uint64(1), slot.astype(np.uint64))
            seen = np.bitwise_or.reduceat(bits, starts).view(np.int64)
            by_slot = np.argsort(slot.astype(np.uint8), kind="stable")
            ends = np.cumsum(np.bincount(slot, minlength=width))
            texts = []
            for first, last in zip(np.append(0, ends), ends):
                cells = by_slot[first:last]
                if len(cells) < len(starts):
                    at = np.full(len(starts), -1)
                    at[row[cells]] = cells
                    cells = pa.array(at, mask=at < 0)
                texts.append(batch.column(2).take(pa.array(cells)))
            keys = {"id": ids[starts]} if n <= SLOTS else {"id": ids[starts], "g": group[starts]}
            longs = {k: pa.array(v) for k, v in (keys | {"n": sizes, "seen": seen}).items()}
            yield pa.RecordBatch.from_arrays([*longs.values(), *texts], [*longs, *[f"c{k}" for k in range(width)]])
    return pack


def _by_id(data: DataFrame) -> bool:
    """Whether the rows of an id lie in one partition already, as those of buckets do."""
    return exchanges(data.groupBy("id").count()) == exchanges(data)


def _shuffled(packed: DataFrame, n_cells: int | None) -> DataFrame:
    """``packed`` by id, in more partitions than the session's where these would hold
    over ``CELLS_PER_TASK`` cells each: a task sorts its partition, which would outgrow its memory."""
    needed = -(-(n_cells or 0) // CELLS_PER_TASK)
    if needed > int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return packed.repartition(needed, "id")
    return packed.repartition("id")


def _gathered(data: DataFrame, n: int, strict: bool, n_cells: int | None = None) -> DataFrame:
    """One row per id with the text of column ``k`` as ``c<k>``, for more than
    ``SLOTS`` columns in structs ``g<group>`` of that many. The greatest of
    several cells stays; ``strict`` raises on them."""
    width, keys = min(n, SLOTS), ["id"] if n <= SLOTS else ["id", "g"]
    slots = [f"c{k}" for k in range(width)]
    if _by_id(data):
        slot = F.pmod(F.col("num") - 1, F.lit(SLOTS))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.cast("int"))
        group = F.floor((F.col("num") - 1) / SLOTS)
        packed = data.select("id", group.alias("g"), F.lit(1).cast("long").alias("n"), bit.alias("seen"),
                             *[F.when(slot == k, F.col("val")).alias(c) for k, c in enumerate(slots)])
    else:
        # rows are packed in the order that cells come in, and only then shuffled: an
        # aggregation would sort all cells of a task before the shuffle
        ship_package(data.sparkSession)
        layout = ", ".join([f"{k} long" for k in (*keys, "n", "seen")] + [f"{c} string" for c in slots])
        packed = _shuffled(data.select("id", "num", "val").mapInArrow(_packed(n), layout), n_cells)
    rows = packed.groupBy(*keys).agg(F.sum("n").alias("n"), F.bit_or("seen").alias("seen"), *[F.max(c).alias(c) for c in slots])
    # one bit per column: fewer bits than cells mean that a cell came twice
    twice = F.when(F.bit_count("seen") < F.col("n"), F.raise_error(F.concat(
        F.lit("duplicate cell in row "), F.col("id").cast("string")))).otherwise(F.lit(True))
    rows = rows.where(twice) if strict else rows
    if n <= SLOTS:
        return rows.select("id", *[F.col(c).alias(f"c{k}") for k, c in enumerate(slots, 1)])
    of = lambda g: F.struct(*[F.col(f"c{k - 1 - g * SLOTS}").alias(f"c{k}")
                              for k in range(g * SLOTS + 1, min(n, (g + 1) * SLOTS) + 1)])
    groups = range(-(-n // SLOTS))
    return rows.groupBy("id").agg(*[F.max(F.when(F.col("g") == g, of(g))).alias(f"g{g}") for g in groups])


def plain_columns(cells: DataFrame, schema: T.StructType, mode: str = "strict",
                  bad_text: str = "null", n_cells: int | None = None) -> DataFrame:
    """Restore the typed table from ``(id, num, val)`` cells (T5).

    One row per data id (> 0) that has a cell of a column of ``schema``, with
    exactly its names, types, nullability and metadata. Row order is not
    promised, and no result depends on the order of cells.

    One shuffle at most, by ``id`` (none over bucketed cells). Cells that lie
    together are packed into one row before it, batch by batch, with no sort. The
    aggregation by id after it holds one slot per column, so its buffer is bounded
    however many cells a damaged table has for an id. Tables of more than ``SLOTS``
    columns are gathered in groups of columns first, so the work stays near linear
    in the cells.

    ``strict`` (default) fails on a duplicate cell, on a column number that the
    schema does not have, and on a null or negative row id or column number
    (an unreadable key). ``lenient`` keeps the greatest value among duplicates
    and drops the cells that fit nowhere. A missing cell gives null in both.
    ``bad_text="raise"`` fails on a non-null cell that does not parse as its
    type; by default such a cell becomes null (count them with the audit).
    ``n_cells``, the number of cells where the caller knows it (roughly is enough),
    sets the partitions of the shuffle for tables too large for the session's number.
    """
    if mode not in RESTORE_MODES:
        raise ValueError(f"mode must be one of {RESTORE_MODES}")
    if bad_text not in BAD_TEXT:
        raise ValueError(f"bad_text must be one of {BAD_TEXT}")
    fields = list(schema.fields)
    if not fields:
        raise ValueError("the schema has no column: no metadata rows were found")
    known = F.col("num").between(1, len(fields))
    if mode == "strict":
        odd = (F.col("id").isNull() | (F.col("id") < 0)
               | ((F.col("id") > 0) & ~F.coalesce(known, F.lit(False))))
        found = F.concat(F.lit("cell that fits no column: id "), F.coalesce(F.col("id").cast("string"), F.lit("?")),
                         F.lit(", num "), F.coalesce(F.col("num").cast("string"), F.lit("?")))
        data = cells.where(F.when(odd, F.raise_error(found)).otherwise(F.col("id") > 0))
    else:
        data = cells.where((F.col("id") > 0) & known)
    rows = _gathered(data, len(fields), mode == "strict", n_cells)
    out = []
    for k, f in enumerate(fields, 1):
        text = F.col(f"g{(k - 1) // SLOTS}")[f"c{k}"] if len(fields) > SLOTS else F.col(f"c{k}")
        value = from_text(text, f.dataType)
        if bad_text == "raise" and not isinstance(f.dataType, T.StringType):
            value = F.when(text.isNotNull() & value.isNull(), F.raise_error(
                F.concat(F.lit(f"cell of {f.name} does not parse as "
                               f"{f.dataType.simpleString()}: "), text))
            ).otherwise(value)
        if not f.nullable:
            value = non_null(value, f.dataType, f.name)
        out.append(value.alias(f.name, metadata=f.metadata))
    return rows.select(*out)


def restore(cells: DataFrame, mode: str = "strict", bad_text: str = "null",
            n_cells: int | None = None) -> tuple[DataFrame, str | None]:
    """Combined cells (metadata + data) -> (typed table, table name).

    The schema is always recovered from the id-0 rows.
    """
    schema, name = schema_name(cells)
    return plain_columns(cells, schema, mode, bad_text, n_cells), name


def restore_key_value(kv: DataFrame, mode: str = "strict", bad_text: str = "null",
                      n_cells: int | None = None) -> tuple[DataFrame, str | None]:
    """Combined ``(key, val)`` table -> (typed table, table name).

    The metadata rows are those whose parsed id is 0, however the key is written.
    """
    return restore(id_num_columns(kv), mode, bad_text, n_cells)


# ----------------------------------------------------------- combined form

def combined_cells(df: DataFrame, name: str, ids: str = "unique",
                   order_by: Sequence[str | Column] | None = None,
                   nested: str = "json", unique_keys: bool = True) -> DataFrame:
    """Metadata cells unioned with data cells (M6)."""
    meta = meta_cells(df.sparkSession, df.schema, name)
    return meta.unionByName(melt_cells(df, ids, order_by, nested=nested,
                                       unique_keys=unique_keys))


def combined_export(df: DataFrame, name: str, ids: str = "unique",
                    order_by: Sequence[str | Column] | None = None,
                    text_order: bool = False, nested: str = "json",
                    unique_keys: bool = True) -> DataFrame:
    """One ``(key, val)`` table with both parts, sorted.

    Sorted numerically by ``(id, num)``; ``text_order=True`` sorts by the key
    text instead (``"10,1"`` before ``"2,1"``), as a plain string sort would.
    The sort is a distributed range sort.
    """
    cells = combined_cells(df, name, ids, order_by, nested, unique_keys)
    if text_order:
        return cells_to_key_value(cells).orderBy("key")
    return cells.orderBy("id", "num").transform(cells_to_key_value)
