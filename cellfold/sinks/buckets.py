"""Cells stored in buckets by row id, so that a restore shuffles nothing.

The cells of an id lie in one bucket file, sorted by (id, num). Read back with its
bucketing, such a table is partitioned by id already: the aggregation of the
restore needs no exchange.

Every write goes to a folder of its own. A small table beside them, the pointer,
names the folder that counts and the number of buckets; replacing it publishes
the write, and the old folder is deleted after that. A job that dies in between leaves the
old or the new cells, never both. Bucketing is a property of catalog tables, so
writing and reading use one under a name of its own, dropped at once (the files
are external to it and stay).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from cellfold.session import delete_tree
from cellfold.sources.options import parse_save_mode

POINTER = "current"
_COLUMNS = "id BIGINT, num BIGINT, val STRING"


def _pointer(spark: SparkSession, path: str) -> Row | None:
    try:
        return spark.read.schema("folder string, buckets int, at long").parquet(f"{path}/{POINTER}").orderBy("at").tail(1)[0]
    except (AnalysisException, IndexError):
        return None


def write_buckets(cells: DataFrame, path: str, n_buckets: int | None = None, mode: str | None = "overwrite") -> None:
    """Write ``(id, num, val)`` cells below ``path`` in ``n_buckets`` buckets
    (default: the shuffle partitions). One shuffle, by id; a file per bucket."""
    spark, path, mode = cells.sparkSession, path.rstrip("/"), parse_save_mode(mode)
    if mode == "append":
        raise ValueError("buckets are written whole: append is not possible")
    old = _pointer(spark, path)
    if old and mode != "overwrite":
        if mode == "ignore":
            return
        raise FileExistsError(path)
    n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, folder = f"cellfold_{uuid.uuid4().hex}", f"cells-{uuid.uuid4().hex}"
    try:
        (cells.select("id", "num", "val").repartition(n, "id").write.format("parquet").bucketBy(n, "id").sortBy("id", "num")
         .option("path", f"{path}/{folder}").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    publish(spark, path, folder, n, old)


def publish(spark: SparkSession, path: str, folder: str, n: int, old: Row | None) -> None:
    """Let the pointer name ``folder``; what it named before goes afterwards. The
    new pointer is added before the old one is replaced by it, and the later one counts."""
    now = spark.createDataFrame([(folder, n, (old["at"] if old else 0) + 1)], "folder string, buckets int, at long").coalesce(1)
    now.write.mode("append").parquet(f"{path}/{POINTER}")
    if old:
        delete_tree(spark, f"{path}/{old['folder']}")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The cells below ``path``, partitioned by id without a shuffle."""
    path = path.rstrip("/")
    now = _pointer(spark, path)
    if now is None:
        raise FileNotFoundError(f"no buckets at {path}")
    name, where = f"cellfold_{uuid.uuid4().hex}", f"{path}/{now['folder']}".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({_COLUMNS}) USING parquet CLUSTERED BY (id) SORTED BY (id, num) "
              f"INTO {now['buckets']} BUCKETS LOCATION '{where}'")
    try:
        return spark.table(name)  # bound to its files here, not to the name
    finally:
        spark.sql(f"DROP TABLE {name}")
