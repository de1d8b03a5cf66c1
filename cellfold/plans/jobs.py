"""The two jobs: load a table into key-value files (T6) and restore a table
from them (T7).

Layout written by ``load_key_value``: ``<target>/meta`` (n+1 rows, one file)
and ``<target>/data`` (rows x columns cells). The interchange format is CSV
or zipped CSV of ``(key, val)`` with an option set under which every text
survives (``KEY_VALUE_CSV``), or parquet of typed ``(id, num, val)``, on request
in buckets by id (``buckets``), from which a restore needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.operators.columns import clear_columns, id_num_columns
from cellfold.operators.keyvalue import (
    cells_to_key_value,
    melt_cells,
    meta_cells,
    plain_columns,
    restore,
    restore_key_value,
    schema_name,
)
from cellfold.functions.text import from_one_line, one_line
from cellfold.session import Stages
from cellfold.sinks.buckets import read_buckets, write_buckets
from cellfold.sinks.csv import write_csv
from cellfold.sources.csv import read_csv, repartition_input
from cellfold.sources.options import KEY_VALUE_CSV, KEY_VALUE_CSV_READ, overlay, parse_save_mode

SOURCE_FORMATS = ("csv", "excel", "zip", "parquet")
KV_FORMATS = ("csv", "parquet", "zip", "buckets")
KV_SCHEMA = "key string, val string"
# a double quote run becomes one apostrophe when quote clearing is asked for
_QUOTE_RUN, _QUOTE_REPLACEMENT = '"+', "'"


def read_source(spark: SparkSession, path: str, fmt: str = "csv",
                options: Mapping[str, object] | None = None, schema=None,
                stages: Stages | None = None) -> DataFrame:
    """Read the job's input in one of ``SOURCE_FORMATS``; ``stages`` holds what is
    unpacked once for several passes."""
    if fmt == "csv":
        return read_csv(spark, path, options, schema)
    if fmt == "zip":
        from cellfold.sources.zipped import read_zipped_csv
        return read_zipped_csv(spark, path, options, schema, stages=stages)
    if fmt == "excel":
        from cellfold.sources.workbook import read_workbooks
        return read_workbooks(spark, path, options, schema)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"fmt must be one of {SOURCE_FORMATS}")


def _as_key_value(frame: DataFrame) -> DataFrame:
    return cells_to_key_value(frame) if "id" in frame.columns else frame


def _as_cells(frame: DataFrame) -> DataFrame:
    return frame if "id" in frame.columns else id_num_columns(frame)


def write_key_value(kv: DataFrame, path: str, fmt: str = "csv",
                    options: Mapping[str, object] | None = None, mode: str | None = "overwrite",
                    n_files: int | None = None, coalesce: bool = False,
                    max_records_per_file: int | None = None) -> None:
    """Write key-value cells as CSV (safe option set), zip, parquet or buckets.

    Takes ``(key, val)`` or ``(id, num, val)``. CSV and zip hold the text form
    ``(key, val)``; parquet holds typed ``(id long, num long, val string)``:
    no key text to build or parse, smaller files, and min/max statistics on
    ``id`` that let the metadata filter ``id = 0`` skip row groups.
    """
    if fmt == "buckets":  # ``n_files`` buckets, a file each
        write_buckets(_as_cells(kv), path, n_files, mode)
        return
    frame = _as_cells(kv) if fmt == "parquet" else _as_key_value(kv)
    if n_files:
        frame = frame.coalesce(n_files) if coalesce else frame.repartition(n_files)
    null_text = overlay(KEY_VALUE_CSV, options).get("nullValue", "")
    if fmt == "csv":  # a line per record: files can be split between tasks
        frame = frame.withColumn("val", one_line(F.col("val"), null_text))
    if fmt == "zip":
        # a cell that reads like the null text would come back as null
        frame = frame.where(F.when(F.col("val") == null_text, F.raise_error(F.concat(
            F.lit(f"cell equals the null text {null_text!r}; set another nullValue: key "), F.col("key"))))
            .otherwise(F.lit(True)))
    if fmt == "csv":
        write_csv(frame, path, overlay(KEY_VALUE_CSV, options), mode,
                  max_records_per_file=max_records_per_file)
    elif fmt == "parquet":
        writer = frame.write.mode(parse_save_mode(mode)).options(**overlay(options))
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.parquet(path)
    elif fmt == "zip":
        from cellfold.sinks.zipped import write_zipped_csv
        write_zipped_csv(frame, path, overlay(KEY_VALUE_CSV, options), mode=mode,
                         max_records_per_file=max_records_per_file)
    else:
        raise ValueError(f"fmt must be one of {KV_FORMATS}")


def read_key_value(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv",
                   options: Mapping[str, object] | None = None) -> DataFrame:
    """Read key-value files written by ``write_key_value`` as ``(key, val)``. CSV
    files of other writers may hold line breaks inside cells: give
    ``multiLine=true`` for those (a task a file then)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv":
        read = spark.read.schema(KV_SCHEMA).options(**overlay(KEY_VALUE_CSV_READ, options)).csv(paths)
        return read.select("key", from_one_line(F.col("val")).alias("val"))
    if fmt in ("parquet", "buckets"):
        return _as_key_value(read_cells(spark, paths, fmt))
    if fmt == "zip":
        from cellfold.sources.zipped import read_zipped_csv
        opts = overlay(KEY_VALUE_CSV, {"comment": "", "mode": "FAILFAST"}, options)
        return read_zipped_csv(spark, paths, opts, schema=KV_SCHEMA)
    raise ValueError(f"fmt must be one of {KV_FORMATS}")


def read_cells(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv",
               options: Mapping[str, object] | None = None) -> DataFrame:
    """Read key-value files as ``(id, num, val)`` cells (parquet: as stored)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        return _as_cells(spark.read.parquet(*paths))
    if fmt == "buckets":
        return reduce(DataFrame.unionByName, [read_buckets(spark, p) for p in paths])
    return id_num_columns(read_key_value(spark, paths, fmt, options))


def load_key_value(spark: SparkSession, source: str | DataFrame, target: str,
                   name: str | None = None, fmt: str = "csv",
                   read_options: Mapping[str, object] | None = None,
                   write_options: Mapping[str, object] | None = None,
                   kv_format: str = "csv", mode: str | None = "overwrite",
                   n_partitions: int | None = None, ids: str = "unique",
                   order_by: Sequence[str | Column] | None = None,
                   clear_quotes: bool = False,
                   max_records_per_file: int | None = 5_000_000) -> tuple[str, str]:
    """Load job (T6): read -> describe + melt -> ``target/meta``, ``target/data``.

    The metadata comes from the schema (no pass over the data) and is written as
    one file; the data is melted in one pass for ``ids="unique"``, or after one
    materialised range sort for ``ids="ordered"``. ``clear_quotes`` reproduces
    the reference's turning of quote runs into ``'`` (lossy; restore accepts
    the metadata it produces). Returns the two output paths.
    """
    if name is None:
        name = source.rstrip("/").rsplit("/", 1)[-1] if isinstance(source, str) else "table"
    meta_path, data_path = f"{target.rstrip('/')}/meta", f"{target.rstrip('/')}/data"
    with Stages(spark) as stages:  # this job's own; freed after a failure too
        df = source if isinstance(source, DataFrame) else read_source(
            spark, source, fmt, read_options, stages=stages)
        df = repartition_input(df, n_partitions)
        meta = meta_cells(spark, df.schema, name)
        data = melt_cells(df, ids=ids, order_by=order_by, stages=stages)
        if clear_quotes:
            meta = clear_columns(meta, _QUOTE_RUN, _QUOTE_REPLACEMENT)
            data = clear_columns(data, _QUOTE_RUN, _QUOTE_REPLACEMENT)
        write_key_value(meta, meta_path, kv_format, write_options, mode, n_files=1, coalesce=True)
        write_key_value(data, data_path, kv_format, write_options, mode,
                        n_files=n_partitions if kv_format == "buckets" else None,
                        max_records_per_file=max_records_per_file)
    return meta_path, data_path


def _counted(cells: DataFrame, kv_format: str) -> int | None:
    """The number of cells of parquet files, from their footers; other formats would be read for it."""
    return cells.count() if kv_format == "parquet" else None


def restore_table(spark: SparkSession, source: str | Sequence[str], kv_format: str = "csv",
                  options: Mapping[str, object] | None = None, mode: str = "strict",
                  bad_text: str = "null", layout: str = "folders") -> tuple[DataFrame, str | None]:
    """Restore job (T7): key-value files -> id/num -> schema -> typed table.

    ``layout="folders"``: ``source`` is a load-job target, whatever its name; the
    schema is read from its small ``meta`` folder alone and the rows from
    ``data``. ``layout="combined"``: ``source`` is a path, or a list of paths, of
    tables that hold metadata and data rows together.
    """
    if layout not in ("folders", "combined"):
        raise ValueError("layout must be 'folders' or 'combined'")
    if layout == "folders":
        if not isinstance(source, str):
            raise ValueError("a list of paths needs layout='combined'")
        root = source.rstrip("/")
        schema, name = schema_name(read_cells(spark, f"{root}/meta", kv_format, options))
        data = read_cells(spark, f"{root}/data", kv_format, options)
        return plain_columns(data, schema, mode, bad_text, _counted(data, kv_format)), name
    paths = [source] if isinstance(source, str) else list(source)
    if kv_format in ("parquet", "buckets"):
        # typed ids: the id-0 filter reaches the parquet scan
        cells = read_cells(spark, paths, kv_format, options)
        return restore(cells, mode, bad_text, _counted(cells, kv_format))
    return restore_key_value(read_key_value(spark, paths, kv_format, options), mode, bad_text)
