"""Partition-level operators: tag rows with their partition, profile sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_partition_column(df: DataFrame, name: str = "part") -> DataFrame:
    """Append the physical partition index as a non-null int column."""
    if name in df.columns:
        raise ValueError(f"column {name!r} already exists")
    return df.withColumn(name, F.spark_partition_id())


def num_partitions(df: DataFrame) -> int:
    """Number of partitions ``df`` runs with.

    Plans without a shuffle answer from the scan; an adaptive plan has to run
    its shuffle stages to know the final count.
    """
    return df.rdd.getNumPartitions()


def partitions_length(df: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Rows per partition as ``(part int, n bigint)``, empty partitions included (A1).

    One aggregation pass; the partial counts are combined before the shuffle,
    so only one row per partition moves. ``n_partitions`` defaults to the
    partition count of ``df``; partitions without rows come from ``range``, and
    those beyond ``n_partitions`` are reported as well.
    """
    counts = (
        df.select(F.spark_partition_id().alias("part"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if n_partitions is None:
        n_partitions = num_partitions(df)
    spark = df.sparkSession
    every = spark.range(n_partitions).select(F.col("id").cast("int").alias("part"))
    # a sum over both, so that partitions beyond ``n_partitions`` stay too
    zeros = every.select("part", F.lit(0).cast("long").alias("n"))
    return counts.unionByName(zeros).groupBy("part").agg(F.sum("n").alias("n"))


def max_partition_length(df: DataFrame) -> int:
    """Largest partition size (A2); 0 for a table with no rows."""
    row = (
        df.select(F.spark_partition_id().alias("part"))
        .groupBy("part").count()
        .agg(F.max("count").alias("m"))
        .collect()[0]
    )
    return int(row["m"] or 0)


def spread_input(df: DataFrame, target: int | None = None) -> DataFrame:
    """Spread a coarsely split input over at least ``target`` partitions.

    A file with one large row group (or a few big unsplittable files) scans as
    one task; the row-local operators after it (melt, partial aggregation)
    would then run on one core. When the input has fewer partitions than
    ``target`` (default: the default parallelism) it is round-robin
    repartitioned, which cannot skew; input that is already split finely, as
    any large table is, is returned as it is (no shuffle), and so is a plan
    that already shuffles. Streaming frames are returned unchanged. Only the
    scan's split count is read (planning, no job).
    """
    if df.isStreaming:
        return df
    from cellfold.plans.inspect import exchanges
    if exchanges(df) > 0:
        # already shuffled: the partition count is the shuffle's (and adaptive
        # execution's) business, and asking for it would run the shuffle
        return df
    spark = df.sparkSession
    if target is None:
        try:
            target = spark.sparkContext.defaultParallelism
        except Exception:  # Spark Connect
            return df
    try:
        have = num_partitions(df)
    except Exception:
        return df
    return df.repartition(target) if have < target else df
