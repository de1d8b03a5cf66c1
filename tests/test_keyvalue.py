"""Melt / describe / recover / restore: the round-trip law on every type."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from seeded import TYPE_LISTS, seeded_table
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold import (
    combined_cells,
    combined_export,
    id_num_columns,
    key_value_columns,
    melt_cells,
    meta_columns,
    number_cells,
    plain_columns,
    restore,
    restore_key_value,
    schema_frame,
    schema_name,
)
from conftest import SF_MID, SF_SMALL, same_rows

TYPED_SCHEMA = T.StructType([
    T.StructField("a", T.ByteType()), T.StructField("b", T.ShortType()),
    T.StructField("c", T.IntegerType()), T.StructField("d", T.LongType()),
    T.StructField("e", T.FloatType()), T.StructField("f", T.DoubleType()),
    T.StructField("g", T.BooleanType()), T.StructField("h", T.DecimalType(38, 18)),
    T.StructField("i", T.StringType()), T.StructField("j", T.DateType()),
    T.StructField("k", T.TimestampType()), T.StructField("l", T.TimestampNTZType()),
    T.StructField("m", T.BinaryType()),
    T.StructField("n", T.ArrayType(T.IntegerType())),
    T.StructField("o", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("p", T.StructType([T.StructField("x", T.IntegerType()),
                                     T.StructField("y", T.StringType())])),
])


def typed_rows():
    rows = []
    for i in range(40):
        nul = (i % 5 == 0)
        rows.append((
            None if nul else (i % 250) - 125, None if nul else -i * 300, i * 1000003,
            None if nul else i * 10**15, 0.1 * i + 1e-30 * i, None if nul else -1.5e300 / (i + 1),
            i % 2 == 0, None if nul else Decimal(f"{i}.123456789012345678"),
            None if nul else f"text {i} \"q\" ,\n\\ end ", date(1 + i * 200, 1 + i % 12, 1),
            None if nul else datetime(2020, 1, 1, 12, i, i, i * 1000),
            datetime(1999, 12, 31, 23, 59, 59, 999999),
            None if nul else bytes([i, 0, 255, 10]),
            None if nul else [i, None, -i], {"k": float(i)} if not nul else None,
            (i, None if i % 3 else "y") if not nul else None,
        ))
    return rows


@pytest.fixture(scope="module")
def typed(spark):
    return spark.createDataFrame(typed_rows(), TYPED_SCHEMA)


def round_trip(df, name="t", **kw):
    meta = meta_columns(df, name)
    kv = key_value_columns(df, **kw)
    back, got_name = restore_key_value(meta.unionByName(kv))
    return back, got_name


@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_round_trip_every_type(typed, mode):
    cells = combined_cells(typed, "t")
    back = plain_columns(cells, typed.schema, mode=mode)
    assert back.schema == typed.schema
    assert same_rows(back, typed)
    meta = meta_columns(typed, "t")
    back2, name = restore_key_value(meta.unionByName(key_value_columns(typed)), mode=mode)
    assert name == "t" and same_rows(back2, typed)


@pytest.mark.parametrize("ids", ["unique", "partition"])
def test_round_trip_id_strategies(typed, ids):
    back, _ = round_trip(typed.repartition(7), ids=ids)
    assert same_rows(back, typed)


@pytest.mark.parametrize("kind", sorted(TYPE_LISTS))
def test_round_trip_seeded_tables(spark, kind):
    df = seeded_table(spark, 300, TYPE_LISTS[kind], seed=3, null_share=0.2)
    back, _ = round_trip(df)
    assert back.schema == df.schema
    assert same_rows(back, df)


def test_melt_counts_and_keeps_nulls(typed):
    kv = key_value_columns(typed)
    assert kv.count() == typed.count() * len(typed.columns)
    assert kv.where(F.col("val").isNull()).count() > 0
    assert kv.columns == ["key", "val"]


def test_ordered_ids_are_dense_and_follow_keys(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cells = melt_cells(orders, ids="ordered", order_by=["o_orderkey"])
    first = cells.where("num = 1").select("id", F.col("val").cast("long").alias("k"))
    rows = first.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, orders.count() + 1))
    keys = [r["k"] for r in rows]
    assert keys == sorted(keys)


def test_ordered_ids_stable_across_runs(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(5)
    a = melt_cells(orders, ids="ordered", order_by=["o_orderkey"])
    b = melt_cells(orders, ids="ordered", order_by=["o_orderkey"])
    assert same_rows(a, b)


def test_ordered_ids_with_hot_duplicate_key(spark):
    # a third of the rows share one key: salted ties still give dense ids
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 5).alias("v"))
    cells = melt_cells(df, ids="ordered", order_by=["k"], unique_keys=False)
    ids = cells.select("id").distinct()
    assert ids.count() == 3000
    assert ids.agg(F.min("id"), F.max("id")).first() == (1, 3000)


def test_number_cells_shape(typed):
    nc = number_cells(typed.select("c", "i"))
    assert nc.columns == ["key_c", "key_i"]
    f = nc.schema["key_c"].dataType
    assert [x.name for x in f.fields] == ["key", "val"]
    assert [x.name for x in f.fields[0].dataType.fields] == ["id", "num"]
    assert f.fields[1].dataType == T.IntegerType()
    nums = nc.select("key_i.key.num").distinct().collect()
    assert nums == [Row(num=2)]


def test_meta_json_in_jvm_key_order(typed):
    rows = meta_columns(typed.select("c", "n"), "tbl").collect()
    assert rows[0] == Row(key="0,0", val="tbl")
    assert rows[1].key == "0,1"
    assert rows[1].val == ('{"type":"struct","fields":[{"name":"c","type":"integer",'
                           '"nullable":true,"metadata":{}}]}')
    assert json.loads(rows[2].val)["fields"][0]["type"]["type"] == "array"


def test_schema_name_and_frame(spark, typed):
    cells = combined_cells(typed, "typed")
    schema, name = schema_name(cells)
    assert schema == typed.schema and name == "typed"
    frame = schema_frame(cells).orderBy("num").collect()
    assert [r["name"] for r in frame] == typed.columns
    assert frame[0]["type"] == "byte" and frame[0]["nullable"] is True


def test_schema_name_without_name_row(spark):
    kv = spark.createDataFrame(
        [("0,1", '{"type":"struct","fields":[{"name":"a","type":"long","nullable":true,'
                 '"metadata":{}}]}'), ("0,2", '"not a struct"'), ("1,1", "5")],
        "key string, val string")
    schema, name = schema_name(id_num_columns(kv))
    assert name is None
    assert schema.names == ["a"]


def test_quote_cleared_metadata_is_accepted(spark):
    text = "{'type':'struct','fields':[{'name':'a','type':'long','nullable':true,'metadata':{}}]}"
    kv = spark.createDataFrame([("0,0", "x"), ("0,1", text), ("1,1", "3")],
                               "key string, val string")
    back, name = restore_key_value(kv)
    assert back.collect() == [Row(a=3)]


def test_not_null_columns_restored_and_enforced(spark):
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("age", T.IntegerType(), False)])
    df = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    back, _ = round_trip(df)
    assert back.schema == schema
    assert same_rows(back, df)
    # a missing cell in a non-null column stops the job with a message
    cells = combined_cells(df, "p").where(~((F.col("id") > 0) & (F.col("num") == 2)
                                            & (F.col("val") == "2")))
    bad, _ = restore(cells)
    with pytest.raises(Exception, match="null value in non-nullable column age"):
        bad.collect()


def test_strict_restore_rejects_duplicate_cells(spark):
    kv = spark.createDataFrame([("1,1", "a"), ("1,1", "b"), ("1,2", "x")],
                               "key string, val string")
    schema = T.StructType([T.StructField("p", T.StringType()), T.StructField("q", T.StringType())])
    strict = plain_columns(id_num_columns(kv), schema, mode="strict")
    with pytest.raises(Exception, match="duplicate cell in row 1"):
        strict.collect()
    for bad in (("1,3", "z"), ("x", "z"), ("-1,1", "z"), ("2,", "z")):
        stray = spark.createDataFrame([("1,1", "a"), bad], "key string, val string")
        with pytest.raises(Exception, match="cell that fits no column"):
            plain_columns(id_num_columns(stray), schema).collect()
        assert plain_columns(id_num_columns(stray), schema, mode="lenient").collect() == [Row(p="a", q=None)]
    lenient = plain_columns(id_num_columns(kv), schema, mode="lenient").collect()
    assert lenient == [Row(p="b", q="x")]


def test_restore_checks_duplicates_missing_and_bad_text(spark):
    kv = spark.createDataFrame(
        [("1,1", "7"), ("1,2", "a"), ("2,2", "b"), ("3,1", "9"), ("3,1", "9")],
        "key string, val string")
    schema = T.StructType([T.StructField("n", T.IntegerType()),
                           T.StructField("s", T.StringType())])
    ok = plain_columns(id_num_columns(kv).where("id < 3"), schema).collect()
    assert sorted(ok, key=str) == sorted([Row(n=7, s="a"), Row(n=None, s="b")], key=str)
    with pytest.raises(Exception, match="duplicate cell in row 3"):
        plain_columns(id_num_columns(kv), schema).collect()
    bad = spark.createDataFrame([("1,1", "x"), ("1,2", "a")], "key string, val string")
    with pytest.raises(Exception, match="does not parse as int"):
        plain_columns(id_num_columns(bad), schema, bad_text="raise").collect()


def test_missing_cell_gives_null_and_bad_text_policy(spark):
    kv = spark.createDataFrame([("1,1", "7"), ("2,1", "x"), ("2,2", "y"), ("3,2", "z")],
                               "key string, val string")
    schema = T.StructType([T.StructField("n", T.IntegerType()),
                           T.StructField("s", T.StringType())])
    rows = sorted(plain_columns(id_num_columns(kv), schema).collect(), key=str)
    assert Row(n=7, s=None) in rows and Row(n=None, s="y") in rows and Row(n=None, s="z") in rows
    with pytest.raises(Exception, match="does not parse as int"):
        plain_columns(id_num_columns(kv), schema, bad_text="raise").collect()


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x", 2.5, "k", "v")], ["a.b", "a b", "id", "key", "val"])
    df = df.toDF("a.b", "a b", "id", "key", "val")
    back, _ = round_trip(df)
    assert back.schema == df.schema
    assert same_rows(back, df)


def test_duplicate_column_names_melt_by_position(spark):
    df = spark.createDataFrame([(1, 2)], "x int, y int").toDF("x", "x")
    kv = key_value_columns(df).collect()
    assert sorted(r.val for r in kv) == ["1", "2"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    for ids in ("unique", "partition"):
        back, name = round_trip(df, ids=ids)
        assert back.count() == 0 and back.schema == df.schema
    cells = melt_cells(df, ids="ordered", order_by=["a"])
    assert cells.count() == 0


def test_few_rows_over_many_partitions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "a int, b string").repartition(100)
    for ids in ("unique", "partition"):
        back, _ = round_trip(df, ids=ids)
        assert same_rows(back, df)
    cells = melt_cells(df, ids="ordered", order_by=["a"])
    assert sorted(r.id for r in cells.where("num = 1").collect()) == [1, 2, 3]


def test_combined_export_orders(spark):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    rows = combined_export(nation, "nation", ids="ordered", order_by=["n_nationkey"]).collect()
    keys = [tuple(int(x) for x in r.key.split(",")) for r in rows]
    assert keys == sorted(keys) and keys[0] == (0, 0)
    text = combined_export(nation, "nation", ids="ordered", order_by=["n_nationkey"],
                           text_order=True).collect()
    assert [r.key for r in text] == sorted(r.key for r in text)


def test_columns_subset_melts_only_those(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cells = melt_cells(orders, columns=["o_totalprice", "o_orderkey"])
    assert sorted(r.num for r in cells.select("num").distinct().collect()) == [1, 4]
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in plan


def test_lineitem_round_trip_sf001(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    back, _ = restore(combined_cells(li, "lineitem"))
    assert back.schema == li.schema
    assert same_rows(back, li)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_round_trip_with_and_without_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        schema = T.StructType([T.StructField(f"c{i}", t, False) for i, t in enumerate([
            T.ByteType(), T.ShortType(), T.FloatType(), T.DecimalType(38, 18), T.BinaryType(),
            T.DateType(), T.TimestampNTZType()])])
        df = spark.createDataFrame([(1, 2, 1.5, Decimal("1.5"), b"x", date(2020, 1, 1),
                                     datetime(2020, 1, 1, 1, 1, 1))], schema)
        back, _ = restore(combined_cells(df, "t"))
        assert back.schema == df.schema and back.collect() == df.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
