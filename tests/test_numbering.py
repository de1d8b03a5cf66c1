"""Numbering in key ranges: equal to row_number() on awkward tables, no staged copy."""

import os
from collections import Counter

import pytest
from conftest import SF_MID

from cellfold.operators.ids import with_row_ids
from cellfold.operators.numbering import BLOCK, group_row_numbers, number_rows
from cellfold.plans.inspect import exchanges, plan_text
from cellfold.session import shared_root
from pyspark.sql import Window
from pyspark.sql import functions as F


def awkward(spark):
    """Three quarters of the rows repeat in every column; null and signed keys."""
    base = spark.range(30_000)
    hot = F.col("id") % 4 > 0
    return base.select(
        F.when(hot, "big").when(F.col("id") % 8 > 0, F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.when(hot, -0.0).when(F.col("id") % 12 > 0, (F.col("id") % 11) / 4).alias("__key"),
        F.when(hot, 0).otherwise(F.col("id") % 100).alias("at.b"))


def expected(rows, group):
    out, seen = Counter(), Counter()
    for r in sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r)):
        g = r[0] if group else None
        seen[g] += 1
        out[(*map(str, r), seen[g])] += 1
    return out


@pytest.mark.parametrize("group", [True, False])
@pytest.mark.parametrize("ranges", [None, 1, 64])
def test_numbers_equal_a_plain_count(spark, group, ranges):
    df = awkward(spark)
    rows = [tuple(r) for r in df.collect()]
    if group:
        got = group_row_numbers(df, ["g"], ["__key", "`at.b`".strip("`")], "no", unique_keys=False, n_ranges=ranges)
    else:
        got = number_rows(df, "no", ["g", "__key"], unique_keys=False, n_ranges=ranges)
    assert got.columns == [*df.columns, "no"]
    found = Counter((*map(str, r[:-1]), r[-1]) for r in got.collect())
    strip = lambda c: Counter({(k[0], k[1].replace("-0.0", "0.0"), *k[2:]): n for k, n in c.items()})
    assert strip(found) == strip(expected(rows, group))
    assert Counter(k[:-1] for k in found.elements()) == Counter(tuple(map(str, r)) for r in rows)  # -0.0 stays


def test_repeated_rows_leave_in_blocks(spark):
    df = spark.range(2 * BLOCK + 5).select(F.lit(None).cast("string").alias("a"))
    got = number_rows(df, "no", ["a"], unique_keys=False, n_ranges=8)
    assert got.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first()[:] == (1, 2 * BLOCK + 5, 2 * BLOCK + 5)


def test_empty_maps_and_refusals(spark):
    empty = spark.createDataFrame([], "g string, k long")
    assert group_row_numbers(empty, ["g"], ["k"]).collect() == []
    assert number_rows(empty, "no", ["k"], unique_keys=False).collect() == []
    maps = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1}), (1, {"b": 2})], "k long, m map<string,int>")
    got = number_rows(maps, "no", ["k"], unique_keys=False).orderBy("no").collect()
    assert [(r["m"], r["no"]) for r in got] == [({"a": 1}, 1), ({"a": 1}, 2), ({"b": 2}, 3)]
    with pytest.raises(ValueError):
        number_rows(empty, "g", ["k"])
    with pytest.raises(ValueError):
        group_row_numbers(empty, [], ["k"])


def test_equals_a_window_on_lineitem_without_one_over_a_group(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    order = [c for c in li.columns if c != "l_returnflag"]
    got = group_row_numbers(li, ["l_returnflag"], order, "no")
    want = li.withColumn("no", F.row_number().over(Window.partitionBy("l_returnflag").orderBy(*order)).cast("long"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert exchanges(got) == 1
    spans = [x for x in plan_text(got).splitlines() if "windowspecdefinition" in x]
    assert spans and all("windowspecdefinition(__range" in x for x in spans)


def stages(spark):
    root = shared_root(spark).removeprefix("file:") + "/cellfold-scratch"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_ids_stage_nothing_and_agree(spark, scratch):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    before = stages(spark)
    ordered = with_row_ids(li, "ordered", order_by=li.columns, unique_keys=False)
    a, b = ordered.agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))), ordered.agg(F.count_distinct("id"), F.max("id"))
    again = with_row_ids(li.repartition(5), "ordered", order_by=li.columns, unique_keys=False, n_partitions=50)
    assert a.first() == again.agg(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()
    assert b.first()[:] == (60_000, 60_000)
    # positions in files: the same ids however the files are split, nothing shuffled
    path = scratch("files")
    li.repartition(6).write.option("parquet.block.size", 1 << 17).parquet(path)
    files = spark.read.parquet(path)
    one = with_row_ids(files, "partition")
    assert exchanges(one) == 0 and one.columns == ["id", *li.columns]
    had, parts = spark.conf.get("spark.sql.files.maxPartitionBytes"), one.rdd.getNumPartitions()
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
        two = with_row_ids(spark.read.parquet(path), "partition")
        assert two.rdd.getNumPartitions() > parts
        assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)
    assert one.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (1, 60_000, 60_000)
    assert with_row_ids(spark.read.parquet(path).where("l_tax < 0"), "partition").count() == 0
    some = with_row_ids(spark.read.parquet(path).where("l_quantity > 25"), "partition")
    assert some.agg(F.count("*") == F.count_distinct("id")).first()[0]
    assert stages(spark) == before | {os.path.basename(path)}
    # rows that are not rows of a file any more: unique ids from one staged copy, the rows unchanged
    flags = li.select("l_returnflag")
    for other in (flags.distinct(), flags.union(flags), flags.limit(9), flags.groupBy("l_returnflag").count(),
                  flags.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))):
        got = with_row_ids(other, "partition")
        assert got.agg(F.count("*") == F.count_distinct("id")).first()[0] and got.count() == other.count()
