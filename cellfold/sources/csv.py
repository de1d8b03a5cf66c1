"""CSV source (S1) and input repartition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol
from cellfold.sources.options import READER_CSV_DEFAULTS, overlay

_CORRUPT = "_cellfold_corrupt"


def read_csv(spark: SparkSession, path: str | list[str],
             options: Mapping[str, object] | None = None,
             schema: T.StructType | str | None = None) -> DataFrame:
    """Read CSV with the reference defaults overlaid by ``options``.

    Give ``schema`` at scale: inference costs a full extra pass. Without one the
    names (and, with ``inferSchema``, the types) are taken first. With
    ``mode=DROPMALFORMED`` the read runs as ``PERMISSIVE`` with a
    corrupt-record column and an explicit filter, so that ``count()`` and
    ``collect()`` agree (``DROPMALFORMED`` with column pruning counts malformed
    rows that a full read drops).
    """
    opts = overlay(READER_CSV_DEFAULTS, options)
    reader = spark.read
    if opts.get("mode", "").upper() == "DROPMALFORMED":
        if schema is None:
            schema = reader.options(**opts).csv(path).schema
        st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        if not st.fields:
            return reader.schema(st).options(**opts).csv(path)
        with_corrupt = T.StructType(list(st.fields) + [T.StructField(_CORRUPT, T.StringType())])
        # without column pruning the parser sees whole records in every query
        opts = overlay(opts, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false"})
        raw = reader.options(**opts).schema(with_corrupt).csv(path)
        # one cheap predicate on a data column, which the optimizer cannot fold: a
        # scan of the corrupt-record column alone is refused
        some = F.hash(qcol(st.fields[0].name)) >= F.lit(-(1 << 31))
        return raw.where(F.col(_CORRUPT).isNull() & some).drop(_CORRUPT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**opts).csv(path)


def repartition_input(df: DataFrame, n: int | None = None) -> DataFrame:
    """Spread a freshly read table over ``n`` partitions when asked.

    Without ``n`` the scan's own splits are kept: no shuffle.
    """
    return df if n is None else df.repartition(n)
