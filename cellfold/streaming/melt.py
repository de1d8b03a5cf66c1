"""Key-value melt of a streaming table.

Melting is stateless (a projection and a generator), so it runs on a
streaming DataFrame as it is; only the id must come from the data, because
the batch id strategies (partition, ordered) need counts over the whole
table. ``start_key_value_stream`` writes the ``(key, val)`` stream through the
file sink, whose metadata log gives exactly-once output across restarts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from cellfold.operators.keyvalue import key_value_columns

SINK_FORMATS = ("parquet", "csv", "json")


def stream_key_value(df: DataFrame, id_col: str | Column,
                     columns: Sequence[str] | None = None,
                     nested: str = "json") -> DataFrame:
    """``(key, val)`` cells of a (streaming or batch) table.

    ``id_col`` is a unique column or expression with values >= 1 (0 is the
    metadata row id); every column of ``df`` is melted, the id column too, or
    those in ``columns``, under their positions in ``df``.
    """
    return key_value_columns(df, id_col=id_col, columns=columns, nested=nested)


def start_key_value_stream(df: DataFrame, id_col: str | Column, path: str,
                           checkpoint: str, fmt: str = "parquet",
                           options: Mapping[str, str] | None = None,
                           available_now: bool = False,
                           processing_time: str | None = None,
                           max_records_per_file: int | None = None,
                           columns: Sequence[str] | None = None) -> StreamingQuery:
    """Start melting ``df`` (or ``columns`` of it) into ``path`` (append mode, file sink).

    ``available_now`` processes what is there and stops (batch-like runs);
    otherwise micro-batches run every ``processing_time`` (default: as fast
    as data arrives).
    """
    if fmt not in SINK_FORMATS:
        raise ValueError(f"fmt must be one of {SINK_FORMATS}")
    writer = (stream_key_value(df, id_col, columns).writeStream.format(fmt)
              .outputMode("append").option("checkpointLocation", checkpoint)
              .options(**(options or {})))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(path)
