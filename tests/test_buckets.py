"""Bucketed cells: restored without a shuffle, replaced in one step."""

import os

import pytest
from conftest import SF_MID, same_rows
from pyspark.sql import functions as F

from cellfold.operators.keyvalue import SLOTS, melt_cells, plain_columns
from cellfold.plans.inspect import exchanges
from cellfold.plans.jobs import load_key_value, read_cells, restore_table, write_key_value
from cellfold.sinks import buckets


def test_restore_from_buckets_has_no_exchange(spark, scratch):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    target = scratch("buckets")
    load_key_value(spark, li, target, name="lineitem", kv_format="buckets", n_partitions=6)
    table, name = restore_table(spark, target, kv_format="buckets")
    assert (name, table.schema) == ("lineitem", li.schema)
    assert exchanges(table) == 0
    assert same_rows(table, li)
    assert exchanges(table) == 0  # nor in the plan that ran
    one = [f for f in os.listdir(f"{target}/data/" + next(x for x in os.listdir(f"{target}/data") if x.startswith("cells")))
           if f.startswith("part")]
    assert len(one) == 6


def test_modes_and_a_failure_between_publish_and_delete(spark, scratch, monkeypatch):
    path = scratch("it's")
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (0, 0, "t")], "id long, num long, val string")
    second = first.withColumn("val", F.lit("b"))
    with pytest.raises(FileNotFoundError):
        read_cells(spark, path, "buckets")
    write_key_value(first, path, "buckets", n_files=3)
    write_key_value(second, path, "buckets", mode="ignore")
    with pytest.raises(FileExistsError):
        write_key_value(second, path, "buckets", mode="errorifexists")
    with pytest.raises(ValueError):
        write_key_value(second, path, "buckets", mode="append")
    rows = lambda: sorted(r["val"] or "" for r in read_cells(spark, path, "buckets").collect())
    assert rows() == ["", "a", "t"]

    def dies(*_):
        raise OSError("lost")
    monkeypatch.setattr(buckets, "delete_tree", dies)
    with pytest.raises(OSError):
        write_key_value(second, path, "buckets")
    monkeypatch.undo()
    assert rows() == ["b"] * 3  # the new cells alone
    monkeypatch.setattr(buckets, "publish", dies)
    with pytest.raises(OSError):
        write_key_value(first, path, "buckets")
    monkeypatch.undo()
    assert rows() == ["b"] * 3  # still those
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("cellfold")]


@pytest.mark.parametrize("n", [SLOTS, SLOTS + 2])
def test_wide_tables_and_damage(spark, n):
    wide = spark.range(1, 40).select(*[F.when(F.col("id") % (k + 2) > 0, F.col("id") * k).alias(f"x{k}") for k in range(n)])
    cells = melt_cells(wide, ids="ordered", order_by=["x0"])
    assert same_rows(plain_columns(cells, wide.schema), wide)
    again = cells.where(f"num = {n}").withColumn("val", F.lit("9999999"))
    with pytest.raises(Exception, match="duplicate cell in row"):
        plain_columns(cells.unionByName(again), wide.schema).collect()
    greatest = plain_columns(cells.unionByName(again), wide.schema, mode="lenient")
    last = greatest.agg(F.min(f"x{n - 1}")).first()[0]
    assert last is not None and greatest.count() == 39
    some = plain_columns(cells.where(f"num <> {n} and num <> 1"), wide.schema)
    assert some.where(F.col("x0").isNotNull() | F.col(f"x{n - 1}").isNotNull()).isEmpty() and some.count() == 39
