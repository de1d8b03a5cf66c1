"""Cells packed into rows before the shuffle of a restore."""

import re

import pyarrow as pa
import pytest
from conftest import SF_SMALL, same_rows
from pyspark.sql import functions as F

from cellfold.operators import keyvalue
from cellfold.operators.keyvalue import SLOTS, _packed, combined_cells, melt_cells, plain_columns, restore
from cellfold.plans.catalog import QUERIES
from cellfold.plans.inspect import plan_text
from cellfold.plans.jobs import load_key_value, restore_table


def sorts_below_the_exchange(df) -> int:
    tree = plan_text(df, "simple")
    return tree[tree.index("Exchange hashpartitioning(id"):].count("Sort")


def test_no_cell_is_sorted_before_the_shuffle(spark):
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    table, _ = restore(combined_cells(lineitem, "lineitem"))
    assert sorts_below_the_exchange(table) == 0
    assert same_rows(table, lineitem)


def test_cells_that_lie_together_are_one_row():
    def packed(n, *cells):
        ids, num, val = (pa.array(x) for x in zip(*cells))
        batch = pa.RecordBatch.from_arrays([ids.cast(pa.int64()), num.cast(pa.int64()), val.cast(pa.string())], names=["id", "num", "val"])
        return [tuple(r.values()) for out in _packed(n)([batch]) for r in out.to_pylist()]
    assert packed(3, (7, 1, "a"), (7, 3, "c"), (8, 2, None), (8, 3, "d"), (7, 2, "b")) == [
        (7, 2, 0b101, "a", None, "c"), (8, 2, 0b110, None, None, "d"), (7, 1, 0b10, None, "b", None)]
    # a cell that comes twice keeps both rows, for the aggregation to find
    assert packed(2, (1, 1, "a"), (1, 1, "b"), (1, 2, "c")) == [(1, 1, 1, "a", None), (1, 2, 3, "b", "c")]
    wide = packed(SLOTS + 1, (1, SLOTS, "a"), (1, SLOTS + 1, "b"))
    assert [r[:4] for r in wide] == [(1, 0, 1, -1 << 63), (1, 1, 1, 1)] and wide[0][-1] == "a" and wide[1][4] == "b"
    assert list(_packed(1)([pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2 + [pa.array([], pa.string())], names=["id", "num", "val"])])) == []


@pytest.mark.parametrize("n", [3, SLOTS, SLOTS + 2])
def test_cells_in_any_order(spark, n):
    table = spark.range(1, 400).select(*[F.when(F.col("id") % (k + 2) > 0, F.col("id") * k).alias(f"x{k}") for k in range(n)])
    cells = melt_cells(table, ids="ordered", order_by=["x0"])
    mixed = cells.repartition(7, F.xxhash64("id", "num")).sortWithinPartitions(F.xxhash64("num", "id"))
    assert same_rows(plain_columns(mixed, table.schema), table)
    with pytest.raises(Exception, match="duplicate cell in row"):
        plain_columns(mixed.unionByName(mixed.where("id = 9 and num = 2")), table.schema).collect()
    twice = mixed.unionByName(mixed.withColumn("val", F.lit(None).cast("string")))
    assert same_rows(plain_columns(twice, table.schema, mode="lenient"), table)


def test_parquet_cells_are_not_sorted_before_the_shuffle(spark, scratch):
    orders, target = spark.read.parquet(f"{SF_SMALL}/orders.parquet"), scratch("pq-pack")
    load_key_value(spark, orders, target, name="orders", kv_format="parquet")
    table, _ = restore_table(spark, target, kv_format="parquet")
    assert sorts_below_the_exchange(table) == 0
    assert same_rows(table, orders)


def test_nested_cells_are_not_sorted_before_the_shuffle(spark):
    rows = spark.range(300).select("id", F.struct(F.col("id").alias("a"), F.array("id").alias("b")).alias("s"),
                                   F.create_map("id", F.concat(F.lit("v"), "id")).alias("m"))
    table, _ = restore(combined_cells(rows, "nested"))
    assert sorts_below_the_exchange(table) == 0
    assert sorted(r["id"] for r in table.where("s.a = id and s.b[0] = id and m[id] = concat('v', id)").collect()) == list(range(300))


def partitions_after_the_shuffle(df) -> int:
    return int(re.search(r"Exchange hashpartitioning\(id[^,]*, (\d+)\)", plan_text(df, "simple"))[1])


def test_restore_from_parquet_has_partitions_for_its_cells(spark, scratch, monkeypatch):
    # the session's 8 partitions would each grow with the table, and with them what a task sorts
    orders, target = spark.read.parquet(f"{SF_SMALL}/orders.parquet"), scratch("pq-parts")
    load_key_value(spark, orders, target, name="orders", kv_format="parquet")
    cells = spark.read.parquet(f"{target}/data").count()
    assert partitions_after_the_shuffle(restore_table(spark, target, kv_format="parquet")[0]) == 8
    monkeypatch.setattr(keyvalue, "CELLS_PER_TASK", cells // 20)
    table, _ = restore_table(spark, target, kv_format="parquet")
    assert partitions_after_the_shuffle(table) >= 20
    assert same_rows(table, orders)


def test_restore_nested_has_partitions_for_its_cells(spark, monkeypatch):
    monkeypatch.setattr(keyvalue, "CELLS_PER_TASK", 200)
    table = QUERIES["restore_nested"](spark, SF_SMALL)
    n_events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert partitions_after_the_shuffle(table) == -(-n_events * 5 // 200) > 8
    assert table.count() == n_events
