"""CSV sink (K1) with option overlay (K4), save modes (K3) and file count (K5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from cellfold.sources.options import WRITER_CSV_DEFAULTS, overlay, parse_save_mode


def shape_files(df: DataFrame, n_files: int | None = None,
                coalesce: bool = False) -> DataFrame:
    """Fix the number of output files (K5): ``repartition(n)`` (a shuffle that
    evens the files) or, with ``coalesce=True``, merging partitions without one
    (for small tables such as the metadata)."""
    if n_files is None:
        return df
    return df.coalesce(n_files) if coalesce else df.repartition(n_files)


def write_csv(df: DataFrame, path: str, options: Mapping[str, object] | None = None,
              mode: str | None = "overwrite", n_files: int | None = None,
              coalesce: bool = False, max_records_per_file: int | None = None) -> None:
    """Write ``df`` as a CSV directory (K1)."""
    opts = overlay(WRITER_CSV_DEFAULTS, options)
    if max_records_per_file is not None:
        opts["maxRecordsPerFile"] = str(max_records_per_file)
    (shape_files(df, n_files, coalesce).write
     .mode(parse_save_mode(mode)).options(**opts).csv(path))
