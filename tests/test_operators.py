"""Column-set, nested, partition, audit and streaming operators, and plan shape."""

import pytest
from seeded import TYPE_LISTS, seeded_table
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold import (
    add_partition_column,
    array_column,
    array_to_struct,
    clear_columns,
    convert_struct_column,
    explode_column,
    id_num_columns,
    key_value_columns,
    max_partition_length,
    partitions_length,
    prefix_columns,
    restore_key_value,
    rows_matching,
    split_struct_column,
    string_columns,
    with_row_ids,
)
from cellfold.operators.audit import audit_round_trip, describe_table
from cellfold.operators.keyvalue import (
    combined_cells,
    melt_cells,
    meta_cells,
    plain_columns,
    restore,
)
from cellfold.plans.inspect import exchanges, has_python_or_rdd_scan, plan_text
from cellfold.streaming import stream_key_value
from conftest import SF_MID, SF_SMALL, same_rows


@pytest.fixture(scope="module")
def people(spark):
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("age", T.IntegerType(), False),
                           T.StructField("gender", T.StringType())])
    return spark.createDataFrame([("Ann", 31, "f"), ("Bob", 42, None), ("Cy", 7, "m")], schema)


def test_string_columns_keeps_names_and_order(spark):
    df = spark.createDataFrame([(1, 2.5, True, [1, 2], b"\x00\x01")],
                               "a int, b double, c boolean, d array<int>, e binary")
    out = string_columns(df)
    assert out.columns == df.columns
    assert all(isinstance(f.dataType, T.StringType) for f in out.schema.fields)
    assert out.first() == Row(a="1", b="2.5", c="true", d="[1,2]", e="AAE=")
    assert string_columns(df, nested="cast").first().d == "[1, 2]"


def test_prefix_and_clear(people):
    assert prefix_columns(people).columns == ["__name", "__age", "__gender"]
    cleared = clear_columns(people, "[aeiou]", "_").collect()
    assert cleared[0] == Row(name="Ann", age=31, gender="f")
    assert cleared[1].name == "B_b" and cleared[1].age == 42


def test_id_num_parses_keys(spark):
    kv = spark.createDataFrame([("12,3", "x"), ("bad", "y"), ("7,", "z")], "key string, val string")
    rows = id_num_columns(kv).collect()
    assert rows[0] == Row(id=12, num=3, val="x")
    assert rows[1].id is None and rows[2].num is None


def test_rows_matching(people):
    assert sorted(r.name for r in rows_matching(people, "^[AC]").collect()) == ["Ann", "Cy"]
    assert rows_matching(people, "^m$").count() == 1


def test_struct_split_and_convert(spark):
    df = spark.createDataFrame([("Ann", (31, "f")), ("Bob", (42, None))],
                               "name string, info struct<age:int, gender:string>")
    assert split_struct_column(df).columns == ["name", "age", "gender"]
    conv = convert_struct_column(df).collect()
    assert conv[0].info == "31,f" and conv[1].info == "42"
    assert convert_struct_column(df, null_text="").collect()[1].info == "42,"
    dup = spark.createDataFrame([(1, (2,))], "age int, info struct<age:int>")
    with pytest.raises(ValueError, match="duplicate"):
        split_struct_column(dup)


def test_array_ops(spark):
    df = spark.createDataFrame([("a", "b"), ("c", None)], "x string, y string")
    arr = array_column(df)
    assert arr.collect() == [Row(arr=["a", "b"]), Row(arr=["c", None])]
    with pytest.raises(TypeError):
        array_column(spark.createDataFrame([("a", 1)], "x string, y int"))
    vec = spark.createDataFrame([(1, [1, 2, 3]), (2, [4]), (3, None), (4, [])],
                                "k int, v array<int>")
    st = array_to_struct(vec, 2).orderBy("k").collect()
    assert st[0].struct == Row(col_0=1, col_1=2) and st[1].struct == Row(col_0=4, col_1=None)
    assert st[2].struct == Row(col_0=None, col_1=None)
    ex = explode_column(vec).orderBy("k", "explode").collect()
    assert [r.explode for r in ex] == [1, 2, 3, 4, None, None]
    with pytest.raises(ValueError, match="no array"):
        explode_column(df)


def test_partition_operators(spark):
    df = spark.range(10).repartition(4)
    tagged = add_partition_column(df)
    assert tagged.schema["part"].nullable is False
    assert {r.part for r in tagged.collect()} <= {0, 1, 2, 3}
    sparse = spark.createDataFrame([(1,), (2,), (3,)], "a int").repartition(100)
    prof = partitions_length(sparse).collect()
    assert len(prof) == 100 and sum(r.n for r in prof) == 3
    assert max_partition_length(sparse) == 1
    assert max_partition_length(spark.createDataFrame([], "a int")) == 0


def test_with_row_ids_strategies(spark):
    df = spark.read.parquet(f"{SF_SMALL}/part.parquet").repartition(3)
    for strategy in ("unique", "partition"):
        ids = with_row_ids(df, strategy)
        assert ids.select("id").distinct().count() == df.count()
        assert ids.agg(F.min("id")).first()[0] >= 1
    dense = with_row_ids(df, "ordered", order_by=["p_partkey"]).orderBy("id").collect()
    assert [r.id for r in dense] == list(range(1, 201))
    assert [r.p_partkey for r in dense] == sorted(r.p_partkey for r in dense)
    with pytest.raises(ValueError):
        with_row_ids(df, "ordered")


def test_audit_round_trip(spark):
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    cells = combined_cells(customer, "customer")
    restored, _ = restore(cells)
    metrics = dict(audit_round_trip(customer, cells, restored).collect())
    assert metrics["rows"] == 150 and metrics["cells_expected"] == 750
    assert metrics["data_cells"] == 750 and metrics["meta_cells"] == 6
    assert metrics["missing_rows"] == 0 and metrics["extra_rows"] == 0
    assert metrics["unparsed_cells"] == 0 and metrics["schema_equal"] == 1
    damaged = cells.withColumn("val", F.when((F.col("id") == 3) & (F.col("num") == 1),
                                             F.lit("x")).otherwise(F.col("val")))
    bad, _ = restore(damaged)
    m2 = dict(audit_round_trip(customer, damaged, bad).collect())
    assert m2["unparsed_cells"] == 1 and m2["missing_rows"] == 1
    fast = dict(audit_round_trip(customer, cells, restored, exact=False).collect())
    assert fast["original_hash_a"] == fast["restored_hash_a"]


def test_describe_table(spark):
    df = seeded_table(spark, 500, [t for ts in TYPE_LISTS.values() for t in ts], 1, 0.3)
    rows = describe_table(df).orderBy("num").collect()
    assert [r.name for r in rows] == df.columns
    nulls = df.select([F.count_if(F.col(c).isNull()) for c in df.columns]).first()
    assert [r.n_nulls for r in rows] == list(nulls)
    assert all(r.n_rows == 500 for r in rows)


def test_partition_profile_loses_no_partition(spark):
    df = spark.range(100, numPartitions=8)
    assert partitions_length(df, 4).agg(F.sum("n"), F.count("*")).first()[:] == (100, 8)
    empty = spark.createDataFrame([(1,)], "a int").repartition(5)
    assert partitions_length(empty, 7).agg(F.sum("n"), F.count("*")).first()[:] == (1, 7)


def test_melt_of_chosen_columns_with_an_id_column(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    some = ["o_totalprice", "o_orderstatus"]
    orders = orders.withColumn("o_orderkey", F.col("o_orderkey") + 1)
    got = key_value_columns(orders, id_col="o_orderkey", columns=some)
    want = key_value_columns(orders, id_col="o_orderkey").where(F.split("key", ",")[1].isin("3", "4"))
    assert same_rows(got, want) and got.count() == 3000


def test_streaming_melt_matches_batch(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = (spark.readStream.schema(events.schema)
              .option("pathGlobFilter", "events.parquet").parquet(SF_SMALL))
    kv = stream_key_value(stream, F.col("event_id") + 1)
    assert kv.isStreaming
    q = kv.writeStream.format("memory").queryName("kv_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("kv_stream")
    want = key_value_columns(events, id_col=F.col("event_id") + 1)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


# ------------------------------------------------------------- plan shape

def test_unique_melt_is_one_stage_without_shuffle(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    kv = key_value_columns(orders, spread=False)
    assert exchanges(kv) == 0
    assert not has_python_or_rdd_scan(kv)
    # scan, projection and generator fused into one whole-stage codegen span
    assert "* Generate" in plan_text(kv) and "* ColumnarToRow" in plan_text(kv)


def test_spread_only_for_coarse_input(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")  # one row group: one split
    text = plan_text(key_value_columns(orders))
    assert exchanges(key_value_columns(orders)) == 1 and "RoundRobinPartitioning" in text
    wide = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism)
    assert exchanges(key_value_columns(wide)) == 0


def test_melt_reads_only_chosen_columns(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    kv = key_value_columns(orders, columns=["o_orderkey"], spread=False)
    text = plan_text(kv)
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_restore_has_one_exchange(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cells = meta_cells(spark, orders.schema, "orders").unionByName(
        melt_cells(orders, spread=False))
    schema = orders.schema
    assert exchanges(plain_columns(cells, schema)) == 1  # the shuffle by id; nothing else
    assert "Window" not in plan_text(plain_columns(cells, schema))
    assert exchanges(restore(cells)[0]) == 1


def test_ordered_ids_use_no_global_window(spark):
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet")
    kv = key_value_columns(orders, ids="ordered", order_by=["o_orderkey"])
    text = plan_text(kv)
    windows = [x for x in text.splitlines() if "windowspecdefinition" in x]
    assert all("windowspecdefinition(__range" in x for x in windows) and exchanges(kv) == 1


def test_streaming_restart_is_exactly_once(spark, scratch):
    from cellfold.streaming import start_key_value_stream
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out, ckpt = scratch("so"), scratch("sc")

    def run():
        stream = (spark.readStream.schema(events.schema)
                  .option("pathGlobFilter", "events.parquet").parquet(SF_SMALL))
        start_key_value_stream(stream, F.col("event_id") + 1, out, ckpt,
                               available_now=True).awaitTermination()

    run()
    run()  # restart on the same checkpoint: nothing new, nothing twice
    got = spark.read.parquet(out)
    assert got.count() == events.count() * len(events.columns)
    assert got.select("key").distinct().count() == got.count()


def test_spread_leaves_shuffled_plans_alone(spark):
    from cellfold.operators.partitions import spread_input
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    grouped = orders.groupBy("o_custkey").count()
    assert spread_input(grouped) is grouped
    assert exchanges(spread_input(orders)) == 1
