"""Session helpers: the shared scratch folder and stages written to it.

Intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a real cluster). Where that
is unset they go below ``spark.sql.warehouse.dir``; on a cluster a warehouse on
the local file system, its default, is refused, since executors would not see each
other's files. Nothing is written to a machine-local temporary folder, and no
setting is changed.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_SUBDIR = "cellfold-scratch"


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data (see the module docstring)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    found = spark.conf.get("spark.sql.warehouse.dir")
    one_machine = re.match(r"local(\[|$)", spark.conf.get("spark.master", "local"))
    if not one_machine and not re.match(r"(?!file:)[a-z][a-z0-9+.-]*:", found):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share ({found} is on one machine)")
    return found.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unused path below the shared scratch folder."""
    return f"{shared_root(spark)}/{_SCRATCH_SUBDIR}/{tag}-{uuid.uuid4().hex}"


def delete_tree(spark: SparkSession, path: str) -> bool:
    """Delete a folder through Spark's Hadoop file system, which serves every
    store that Spark writes to. False when there was nothing to delete; a
    failure is raised."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


class Stages:
    """Tables that one job writes to the shared folder and reads again.

    ``save`` cuts the lineage: later jobs see exactly the rows of one
    execution, and a lost executor costs only the tasks it ran, because the
    files of committed tasks are on the shared store. The stages belong to this
    object alone; ``release`` (or leaving the ``with`` block) deletes them,
    also after a failure, and never touches those of other jobs.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def save(self, df: DataFrame, tag: str = "stage") -> DataFrame:
        path = scratch_path(self.spark, tag)
        self.paths.append(path)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> int:
        """Delete this job's stages; returns how many were there."""
        found = 0
        while self.paths:
            found += delete_tree(self.spark, self.paths.pop())
        return found

    def __enter__(self) -> "Stages":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "cellfold") -> SparkSession:
    """A local session for tests and benches (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CELLFOLD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cellfold`` importable in Python tasks (``mapInPandas``, data sources).

    Zips the package once per application and hands it to ``addPyFile``, the
    standard way to distribute Python code to executors. Skipped when the
    executors can already import it (``CELLFOLD_INSTALLED=1``).
    """
    if os.environ.get("CELLFOLD_INSTALLED") == "1":
        return
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the package must be installed on the cluster
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile
    package_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(package_dir)))
    # the archive goes to the shared scratch folder, not a machine-local one
    from cellfold.sources.files import open_output
    archive = scratch_path(spark, "package") + "/cellfold.zip"
    sink = open_output(archive)
    sink.write(buf.getvalue())
    sink.close()
    sc.addPyFile(archive)
    _SHIPPED.add(app)
