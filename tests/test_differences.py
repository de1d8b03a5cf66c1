"""Differing rows, samples, tables like a given one, maps of any key, id guards."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import SF_SMALL, same_rows
from seeded import seeded_table
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.operators.audit import describe_table, differing_rows, profile_columns, sample_rows
from cellfold.operators.keyvalue import combined_cells, key_value_columns, melt_cells, restore, schema_name
from cellfold.operators.likeness import table_like
from cellfold.plans.inspect import exchanges


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("capacity", [1 << 10, 4])
def test_differing_rows_with_repeats_nulls_and_maps(spark, capacity):
    schema = "h long, n string, m map<int,string>, d double"
    a = [(1, "a", {1: "x", 2: "y"}, 0.5)] * 3 + [(None, "b", None, None), (2, None, {}, float("nan")), (3, "b", None, None)]
    a += [(i, "same", {i: "z"}, i / 3) for i in range(100, 900)]
    b = [(1, "a", {2: "y", 1: "x"}, 0.5)] + [(3, None, None, None), (2, None, {}, float("nan")), (3, "b", None, None)]
    b += [(i, "same", {i: "z"}, i / 3) for i in range(100, 900)] + [(5, "new", None, 1.0)] * 2 + [(50 + i, "more", None, 1.0) for i in range(9)]
    got = differing_rows(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), capacity)
    assert got.columns == ["h", "n", "m", "d", "side", "n", "method"]
    found = sorted((str(r[0]), str(r[1]), r[4], r[5]) for r in got.collect())
    want = [("1", "a", "missing", 2), ("None", "b", "missing", 1), ("3", "None", "extra", 1), ("5", "new", "extra", 2)]
    assert found == sorted(want + [(str(50 + i), "more", "extra", 1) for i in range(9)])
    assert {r[6] for r in got.collect()} == {"sketch" if capacity > 4 else "shuffle"}


def test_equal_and_empty_tables_differ_in_nothing(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert differing_rows(orders, orders.repartition(7)).count() == 0
    assert differing_rows(orders.limit(0), orders.limit(0)).count() == 0
    with pytest.raises(ValueError):
        differing_rows(orders, orders.drop("o_custkey"))


def test_samples_do_not_depend_on_partitions(spark):
    df = seeded_table(spark, 400, ["bigint", "string", "date", "boolean"], seed=4, null_share=0.2)
    one, two = sample_rows(df, 7).collect(), sample_rows(df.repartition(9).sortWithinPartitions(df.columns[0]), 7).collect()
    assert one == two and len(one) == 7
    got = describe_table(df, sample=3).collect()
    assert [r["sample"] for r in got] == [[row[k] for row in one[:3]] for k in range(4)]
    empty = describe_table(df.limit(0), sample=3).collect()
    assert all(r["sample"] == [] and r["n_rows"] == 0 and r["least"] is None for r in empty)


def test_profiles(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("decimal(5,1)").alias("d"), F.concat(F.lit("t"), F.col("id") % 3).alias("t"),
                                  F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("n"), F.create_map("id", "id").alias("m"),
                                  F.lit(None).cast("date").alias("none"))
    got = {r["name"]: r for r in profile_columns(df).collect()}
    assert set(got) == {"id", "d", "t", "n", "none"}  # maps have no order
    assert got["id"]["quartiles"] == ["249", "499", "749"] and abs(got["id"]["n_distinct"] - 1000) <= 60
    assert got["d"]["quartiles"] == ["2.0", "4.0", "7.0"] and got["d"]["n_distinct"] == 10
    assert got["t"]["quartiles"] is None and got["t"]["n_distinct"] == 3
    assert got["n"]["quartiles"][1] == "2021-05-14 00:00:00" and got["none"]["quartiles"] is None
    assert {r["n_distinct"] for r in profile_columns(df.limit(0)).collect()} == {0}


def test_tables_like_one(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType()),
        T.StructField("flag", T.StringType()), T.StructField("when", T.TimestampNTZType()), T.StructField("none", T.StringType()),
        T.StructField("amount", T.DecimalType(10, 2)), T.StructField("tags", T.ArrayType(T.StringType()))])
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(i % 90), None if i % 4 == 0 else i / 7, "ab"[i % 10 == 0], dt.datetime(2021, 1, 1, i % 24),
             None, Decimal(i) / 4, [f"t{i % 3}"]) for i in range(2000)]
    df = spark.createDataFrame(rows, schema)
    made = table_like(df, 5000, seed=3)
    assert made.schema == schema and made.count() == 5000
    assert same_rows(made, table_like(df.coalesce(1), 5000, seed=3).repartition(5))
    assert not same_rows(made, table_like(df, 5000, seed=4))
    n = made.agg(F.count_if(F.col("x").isNull()), F.count_if(F.col("flag") == "b"), F.min("id"), F.max("id"), F.min("d"), F.max("d"),
                 F.count("none"), F.avg("id"), F.max("amount"), F.count_distinct("tags")).first()
    assert 1100 < n[0] < 1400 and 400 < n[1] < 600 and 0 <= n[2] < 50 and 1950 < n[3] < 2000
    assert n[4] >= dt.date(2020, 1, 1) and n[5] <= dt.date(2020, 3, 30) and n[6] == 0 and 950 < n[7] < 1050 and n[8] < 500 and n[9] == 3
    assert table_like(df, 0).count() == 0 and table_like(df.limit(0).drop("id"), 5).where("d is not null").count() == 0
    with pytest.raises(Exception, match="null value"):
        table_like(df.limit(0), 5).collect()


def test_maps_of_any_key_come_back(spark):
    schema = ("a map<bigint,double>, b map<date,string>, c array<map<int,map<timestamp_ntz,int>>>, "
              "d struct<x: map<boolean,binary>, y: string>, e map<string,map<decimal(5,2),array<int>>>, f map<struct<p:int,q:string>,int>")
    day, now = dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 1, 2, 3, 4)
    rows = [({2: 0.5, 1: None, -7: float("inf")}, {day: "x", dt.date(1, 1, 1): None}, [{1: {now: 3}}, None, {}], ({True: b"\0\xff"}, "y"),
             {"k": {Decimal("1.50"): [1, None]}}, {(1, "s"): 2, (None, None): 3}),
            ({}, None, None, None, {"k": None}, {}), (None, {}, [], (None, None), None, None)]
    df = spark.createDataFrame(rows, schema)
    assert same_rows(restore(combined_cells(df, "maps"))[0], df)
    assert [r.asDict(True) for r in restore(combined_cells(df, "m"))[0].orderBy(F.size("a").desc_nulls_last()).collect()] == [
        r.asDict(True) for r in df.orderBy(F.size("a").desc_nulls_last()).collect()]
    # the order of the keys does not show in the text
    one, two = (spark.createDataFrame([(m,)], "a map<bigint,double>") for m in ({1: 1.0, 2: 2.0}, {2: 2.0, 1: 1.0}))
    assert rows_of(melt_cells(one)) == rows_of(melt_cells(two))
    # spoilt text is no map
    spoilt = combined_cells(one, "m").withColumn("val", F.when(F.col("id") > 0, '[{"key":null,"value":1}]').otherwise(F.col("val")))
    assert restore(spoilt)[0].first()[0] is None


def test_ids_below_one_and_bad_metadata_are_named(spark):
    df = spark.createDataFrame([(0, "a"), (3, "b")], "k long, v string")
    for ident in ("k", F.col("k") - 5, F.lit(None)):
        with pytest.raises(Exception, match="row ids have to be 1 or more"):
            key_value_columns(df, id_col=ident).collect()
    assert key_value_columns(df, id_col=F.col("k") + 1).count() == 4
    cells = combined_cells(df, "t").withColumn("val", F.when(F.expr("id = 0 and num = 2"), "spoilt").otherwise(F.col("val")))
    with pytest.raises(ValueError, match="metadata cell 0,2 is not"):
        schema_name(cells)
