"""Registered queries over the given tables, each with its DuckDB oracle.

Every query reads whole tables from ``sf_dir`` (``<sf_dir>/<table>.parquet``)
and returns a DataFrame whose column names equal those of the oracle SQL.
Row ids come from the ``ordered`` strategy on a unique key wherever ids show
in the result, so Spark and the oracle agree row for row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.operators.audit import QUARTILES, audit_round_trip, describe_table, differing_rows, profile_columns
from cellfold.operators.columns import (
    clear_columns,
    id_num_columns,
    prefix_columns,
    rows_matching,
    string_columns,
)
from cellfold.operators.ids import with_row_ids
from cellfold.operators.keyvalue import (
    combined_cells,
    combined_export,
    key_value_columns,
    melt_cells,
    meta_cells,
    meta_columns,
    number_cells,
    plain_columns,
    restore,
    restore_key_value,
    schema_frame,
    schema_name,
)
from cellfold.operators.likeness import table_like
from cellfold.operators.nested import (
    array_column,
    array_to_struct,
    convert_struct_column,
    explode_column,
    split_struct_column,
)
from cellfold.operators.numbering import group_row_numbers
from cellfold.operators.partitions import add_partition_column, max_partition_length, partitions_length
from cellfold.plans import sqltext as S
from cellfold.plans.jobs import load_key_value, read_key_value, restore_table, write_key_value
from cellfold.session import Stages, scratch_path
from cellfold.sinks.csv import write_csv
from cellfold.sinks.workbook import write_workbooks
from cellfold.sinks.zipped import write_zipped_csv
from cellfold.sources.csv import read_csv
from cellfold.sources.workbook import read_workbooks
from cellfold.sources.zipped import read_zipped_csv
from cellfold.streaming.melt import start_key_value_stream
from cellfold.sources.options import KEY_VALUE_CSV, WHOLE_CSV_READ, overlay

Query = Callable[[SparkSession, str], DataFrame]

# Column layouts of the given tables: (name, DuckDB type, Spark JSON type).
TABLES = {
    "region": [("r_regionkey", "INTEGER", "integer"), ("r_name", "VARCHAR", "string")],
    "nation": [("n_nationkey", "INTEGER", "integer"), ("n_name", "VARCHAR", "string"),
               ("n_regionkey", "INTEGER", "integer")],
    "customer": [("c_custkey", "BIGINT", "long"), ("c_name", "VARCHAR", "string"),
                 ("c_nationkey", "INTEGER", "integer"), ("c_acctbal", "DOUBLE", "double"),
                 ("c_mktsegment", "VARCHAR", "string")],
    "orders": [("o_orderkey", "BIGINT", "long"), ("o_custkey", "BIGINT", "long"),
               ("o_orderstatus", "VARCHAR", "string"), ("o_totalprice", "DOUBLE", "double"),
               ("o_orderdate", "TIMESTAMP", "timestamp_ntz"),
               ("o_orderpriority", "VARCHAR", "string")],
    "lineitem": [("l_orderkey", "BIGINT", "long"), ("l_partkey", "BIGINT", "long"),
                 ("l_suppkey", "BIGINT", "long"), ("l_linenumber", "INTEGER", "integer"),
                 ("l_quantity", "DOUBLE", "double"), ("l_extendedprice", "DOUBLE", "double"),
                 ("l_discount", "DOUBLE", "double"), ("l_tax", "DOUBLE", "double"),
                 ("l_returnflag", "VARCHAR", "string"), ("l_linestatus", "VARCHAR", "string"),
                 ("l_shipdate", "TIMESTAMP", "timestamp_ntz")],
    "events": [("event_id", "BIGINT", "long"), ("ts", "TIMESTAMP", "timestamp_ntz"),
               ("user_id", "BIGINT", "long"), ("event_type", "VARCHAR", "string"),
               ("value", "DOUBLE", "double"), ("props", "VARCHAR", "string")],
}
LINEITEM_ORDER = [c for c, _, _ in TABLES["lineitem"]]
EMBEDDING_STRUCT_LENGTH = 66  # two more than the stored vectors: tail fields are null
MATCH_PATTERN = r"aux[.]|^sys"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _json_of(name: str, spark_type: str) -> str:
    return ('{"type":"struct","fields":[{"name":"%s","type":"%s","nullable":true,'
            '"metadata":{}}]}' % (name, spark_type))


def _scratch(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, tag)


def _parts(df: DataFrame, least: int, rows: int) -> DataFrame:
    """``df`` in ``least`` partitions, in more where these would hold over ``rows`` rows:
    a task writes a partition, so its work must not grow with the table."""
    return df.repartition(max(least, -(-df.count() // rows)))


def _n_cells(df: DataFrame) -> int:
    """Cells of a table of files that know their number of rows."""
    return df.count() * len(df.columns)


# ------------------------------------------------------------------ melt

def q_key_value(spark, d):
    return key_value_columns(_table(spark, d, "orders"), ids="ordered", order_by=["o_orderkey"])


def q_key_value_lineitem(spark, d):
    # lineitem has no unique key: order by every column, salt ties
    return key_value_columns(_table(spark, d, "lineitem"), ids="ordered",
                             order_by=LINEITEM_ORDER, unique_keys=False)


def q_number_cells(spark, d):
    numbered = number_cells(_table(spark, d, "orders"), ids="ordered", order_by=["o_orderkey"])
    cols = []
    for c, _, _ in TABLES["orders"]:
        cols += [F.col(f"key_{c}.key.id").alias(f"{c}__id"),
                 F.col(f"key_{c}.key.num").alias(f"{c}__num"),
                 F.col(f"key_{c}.val").alias(f"{c}__val")]
    return numbered.select(*cols)


def q_meta_key_value(spark, d):
    return meta_columns(_table(spark, d, "orders"), "orders")


def q_recover_schema(spark, d):
    return schema_frame(combined_cells(_table(spark, d, "orders"), "orders"))


def q_id_num(spark, d):
    kv = key_value_columns(_table(spark, d, "region"), ids="ordered", order_by=["r_regionkey"])
    return id_num_columns(kv)


def q_id_num_orders(spark, d):
    return id_num_columns(key_value_columns(_table(spark, d, "orders"), ids="ordered", order_by=["o_orderkey"]))


def q_restore_table(spark, d):
    lineitem = _table(spark, d, "lineitem")
    table, _ = restore(combined_cells(lineitem, "lineitem"), n_cells=_n_cells(lineitem))
    return table


def q_restore_combined(spark, d):
    # one text (key, val) table with metadata and data rows, schema recovered from it
    orders = _table(spark, d, "orders")
    kv = meta_columns(orders, "orders").unionByName(key_value_columns(orders))
    return restore_key_value(kv, n_cells=_n_cells(orders))[0]


def q_restore_lenient(spark, d):
    orders = _table(spark, d, "orders")
    cells = combined_cells(orders, "orders")
    schema, _ = schema_name(cells)
    return plain_columns(cells, schema, mode="lenient", n_cells=_n_cells(orders))


def q_key_value_subset(spark, d):
    # melt two columns only: the scan reads just those (and the key)
    return key_value_columns(_table(spark, d, "lineitem"), ids="ordered",
                             order_by=LINEITEM_ORDER, unique_keys=False,
                             columns=["l_extendedprice", "l_shipdate"])


def q_key_value_id_subset(spark, d):
    # two columns under ids taken from the data; positions are those of the table
    return key_value_columns(_table(spark, d, "events"), id_col=F.col("event_id") + 1,
                             columns=["user_id", "value"])


def q_meta_counts(spark, d):
    # the description of a table next to what its data cells hold
    cells = combined_cells(_table(spark, d, "orders"), "orders")
    held = (cells.where(F.col("id") > 0).groupBy("num")
            .agg(F.count(F.lit(1)).alias("n_cells"), F.count("val").alias("n_values")))
    return schema_frame(cells).join(held, "num")


def _nested_events(spark, d):
    e = _table(spark, d, "events")
    return e.select("event_id", F.struct("ts", F.array("user_id", "event_id").alias("ids")).alias("info"),
                    F.create_map(F.col("event_type"), F.col("value")).alias("measured"),
                    F.create_map("user_id", "value").alias("by_user"),
                    F.array(F.create_map(F.to_date("ts"), F.col("event_type"))).alias("by_day"))


def q_restore_nested(spark, d):
    events = _nested_events(spark, d)
    table, _ = restore(combined_cells(events, "events"), n_cells=_n_cells(events))
    return table.select("event_id", "info.ts", F.col("info.ids")[0].alias("user_id"),
                        F.map_keys("measured")[0].alias("event_type"),
                        F.map_values("measured")[0].alias("value"),
                        F.element_at("by_user", F.col("info.ids")[0]).alias("value_of_user"),
                        F.element_at(F.col("by_day")[0], F.to_date("info.ts")).alias("type_of_day"))


def q_combined_export_text(spark, d):
    return combined_export(_table(spark, d, "nation"), "nation", ids="ordered",
                           order_by=["n_nationkey"], text_order=True)


def q_combined_export(spark, d):
    return combined_export(_table(spark, d, "nation"), "nation", ids="ordered",
                           order_by=["n_nationkey"])


def _emitted(export: DataFrame) -> DataFrame:
    """The rows of an ordered export numbered in the order they come out."""
    # staged, so that the order seen is the order of one execution of the sort
    came_out = Stages(export.sparkSession).save(export.withColumn("at", F.monotonically_increasing_id()))
    return with_row_ids(came_out, "ordered", order_by=["at"]).drop("at")


def q_combined_export_order(spark, d):
    return _emitted(combined_export(_table(spark, d, "orders"), "orders", ids="ordered",
                                    order_by=["o_orderkey"]))


def q_combined_export_text_order(spark, d):
    return _emitted(combined_export(_table(spark, d, "orders"), "orders", ids="ordered",
                                    order_by=["o_orderkey"], text_order=True))


# ----------------------------------------------------------- projections

def q_string_columns(spark, d):
    return string_columns(_table(spark, d, "events"))


def q_prefix_columns(spark, d):
    return prefix_columns(_table(spark, d, "customer"))


def q_clear_columns(spark, d):
    return clear_columns(_table(spark, d, "conversations"), r"\d+", "#")


def q_rows_matching(spark, d):
    return rows_matching(_table(spark, d, "conversations"), MATCH_PATTERN)


def _nation_packed(spark, d):
    n = _table(spark, d, "nation")
    info = F.struct(F.col("n_name"),
                    F.when(F.col("n_regionkey") != 0, F.col("n_regionkey")).alias("n_regionkey"))
    return n.select("n_nationkey", info.alias("info"))


def q_split_struct(spark, d):
    return split_struct_column(_nation_packed(spark, d))


def q_convert_struct(spark, d):
    return convert_struct_column(_nation_packed(spark, d))


def _events_packed(spark, d):
    e = _table(spark, d, "events")
    info = F.struct("event_type", F.when(F.col("user_id") % 3 > 0, F.col("user_id")).alias("user_id"), "props")
    return e.select("event_id", F.when(F.col("event_id") % 7 > 0, info).alias("info"))


def q_split_struct_events(spark, d):
    return split_struct_column(_events_packed(spark, d))


def q_convert_struct_events(spark, d):
    return convert_struct_column(_events_packed(spark, d))


def q_array_column(spark, d):
    arr = array_column(string_columns(_table(spark, d, "supplier")))
    return arr.select(F.to_json("arr").alias("arr"))


def _embeddings_damaged(spark, d):
    e = _table(spark, d, "embeddings")
    emb = (F.when(F.col("label") == 0, F.lit(None))
           .when(F.col("label") == 1, F.array().cast("array<float>"))
           .otherwise(F.col("embedding")))
    return e.select("vec_id", emb.alias("embedding"), "label")


def q_array_to_struct(spark, d):
    s = array_to_struct(_embeddings_damaged(spark, d), EMBEDDING_STRUCT_LENGTH)
    return split_struct_column(s)


def q_explode_column(spark, d):
    return explode_column(_embeddings_damaged(spark, d))


# ------------------------------------------------------- partitions, ids

def q_partition_profile(spark, d):
    prof = partitions_length(_table(spark, d, "lineitem").repartition(8), n_partitions=8)
    return prof.agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n").alias("n_rows"),
                    F.count_if(F.col("n") == 0).alias("n_empty"))


def q_partition_profile_empty(spark, d):
    # at most three of eight partitions have rows; no count is given
    prof = partitions_length(_table(spark, d, "orders").repartition(8, "o_orderstatus"))
    return prof.agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n").alias("n_rows"),
                    (F.count_if(F.col("n") == 0) >= 5).alias("has_empty"))


def q_add_partition(spark, d):
    tagged = add_partition_column(_table(spark, d, "lineitem").repartition(8))
    return tagged.agg(F.count_distinct("part").alias("n_partitions"),
                      F.count(F.lit(1)).alias("n_rows"),
                      F.min("part").alias("min_part"), F.max("part").alias("max_part"))


def _id_summary(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct("id").alias("n_ids"),
                  (F.min("id") >= 1).alias("ids_positive"))


def q_unique_ids(spark, d):
    return _id_summary(with_row_ids(_table(spark, d, "lineitem"), "unique"))


def q_partition_ids(spark, d):
    return _id_summary(with_row_ids(_table(spark, d, "lineitem").repartition(8), "partition"))


def q_partition_ids_rows(spark, d):
    # ids from the positions of the rows in their files
    return with_row_ids(_table(spark, d, "lineitem"), "partition")


def q_group_row_numbers(spark, d):
    # three groups of 200 thousand rows each (at sf0.1); ties by the other columns
    return group_row_numbers(_table(spark, d, "lineitem"), ["l_returnflag"], LINEITEM_ORDER,
                             unique_keys=False)


def q_group_row_numbers_keys(spark, d):
    # many small groups, null groups, an expression as key
    o = _table(spark, d, "orders").withColumn("big", F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey")))
    return group_row_numbers(o, ["big", "o_orderstatus"], [-F.col("o_totalprice"), "o_orderkey"], name="place")


def q_max_partition_rows(spark, d):
    # rows dealt to partitions by their flag: the largest holds the commonest flag
    flag = F.ascii("l_returnflag") - F.lit(ord("A"))
    dealt = _table(spark, d, "lineitem").repartitionById(26, flag)
    return spark.createDataFrame([(max_partition_length(dealt),)], "n_rows long")


def q_ordered_ids(spark, d):
    ids = with_row_ids(_table(spark, d, "part"), "ordered", order_by=["p_partkey"])
    return ids.select("id", "p_partkey", "p_name")


def q_ordered_ids_rows(spark, d):
    return with_row_ids(_table(spark, d, "lineitem"), "ordered", order_by=LINEITEM_ORDER,
                        unique_keys=False)


# ------------------------------------------------------------------ audit

def q_audit_cells(spark, d):
    customer = _table(spark, d, "customer")
    cells = combined_cells(customer, "customer")
    restored, _ = restore(cells)
    return audit_round_trip(customer, cells, restored)


def _damaged_customer(spark, d):
    # every name whose text ends in 7 is lost and every balance's text spoilt in
    # rows of segment BUILDING
    customer = _table(spark, d, "customer")
    ident, segment = F.col("c_custkey") + 1, F.col("c_mktsegment") == "BUILDING"
    in_building = melt_cells(customer.where(segment), id_col=ident, columns=["c_acctbal"])
    spoilt = (meta_cells(spark, customer.schema, "customer")
              .unionByName(melt_cells(customer, id_col=ident)
                           .where(~((F.col("num") == 2) & F.col("val").endswith("7")))
                           .join(in_building.select("id", "num", F.lit(True).alias("bad")), ["id", "num"], "left")
                           .select("id", "num", F.when(F.col("bad"), "spoilt").otherwise(F.col("val")).alias("val"))))
    return customer, spoilt, restore(spoilt)[0]


def q_audit_damaged(spark, d):
    # the audit has to count the lost and the spoilt cells
    return audit_round_trip(*_damaged_customer(spark, d))


def q_audit_damaged_rows(spark, d):
    # and to name their rows, before and after
    customer, _, restored = _damaged_customer(spark, d)
    return differing_rows(customer, restored).select("c_custkey", "c_name", "c_acctbal", "side", "n")


def q_table_like(spark, d):
    # twice as many rows as orders, in its schema, within its ranges and null shares
    orders = _table(spark, d, "orders")
    orders = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")))
    made = table_like(orders, 2 * orders.count(), seed=7)
    return describe_table(made).join(describe_table(orders).toDF(*[f"o_{c}" for c in describe_table(orders).columns]),
                                     F.col("num") == F.col("o_num")).select(
        "num", "name", "type", "n_rows",
        (F.abs(F.col("n_nulls") / F.col("n_rows") - F.col("o_n_nulls") / F.col("o_n_rows")) < 0.02).alias("nulls_alike"),
        (~F.col("type").isin("string") | ((F.col("least") >= F.col("o_least")) & (F.col("greatest") <= F.col("o_greatest"))))
        .alias("texts_within"))


def q_describe_table(spark, d):
    return describe_table(_table(spark, d, "customer"), sample=5)


def q_profile_columns(spark, d):
    # distinct counts within 8 percent and quartiles within a thousandth of the rows, by exact counts
    orders = _table(spark, d, "orders")
    rows = []
    for r in profile_columns(orders).collect():
        c = F.col(r["name"])
        near = F.abs(r["n_distinct"] - F.count_distinct(c)) <= F.greatest(0.08 * F.count_distinct(c), F.lit(1))
        below = [F.abs(F.count_if(c <= F.lit(q).cast(orders.schema[r["name"]].dataType)) / F.count(c) - p) <= 0.001
                 for q, p in zip(r["quartiles"] or [], QUARTILES)]
        rows.append(F.struct(F.lit(r["num"]).alias("num"), F.lit(r["name"]).alias("name"), near.alias("near"),
                             (reduce(and_, below) if below else F.lit(None).cast("boolean")).alias("quartiles_near")))
    return orders.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


# --------------------------------------------------------- sources, jobs

def q_csv_read(spark, d):
    path = _scratch(spark, "csv-read")
    write_csv(_table(spark, d, "part"), path, {"header": "true"})
    return read_csv(spark, path, {"header": "true", "inferSchema": "true"})


def q_csv_read_schema(spark, d):
    # reference writer defaults out, reference reader defaults in (DROPMALFORMED,
    # comment '#', empty null text), with the table's schema given
    orders = _table(spark, d, "orders")
    path = _scratch(spark, "csv-read-schema")
    write_csv(orders, path)
    return read_csv(spark, path, schema=orders.schema)


def q_csv_round_trip(spark, d):
    docs = _table(spark, d, "documents")
    path = _scratch(spark, "csv-round-trip")
    write_csv(docs, path, KEY_VALUE_CSV)
    return (spark.read.schema(docs.schema)
            .options(**overlay(WHOLE_CSV_READ)).csv(path))


def q_csv_malformed(spark, d):
    # no schema, ';', all cells quoted; every seventh line has a cell too many
    path = _scratch(spark, "csv-malformed")
    cells = ["p_partkey", "p_name", "p_size"]
    line = F.concat_ws(";", *[F.concat(F.lit('"'), F.col(c).cast("string"), F.lit('"')) for c in cells])
    more = F.when(F.col("p_partkey") % 7 == 3, F.concat(line, F.lit(';"extra"'))).otherwise(line)
    _table(spark, d, "part").select(more.alias("value")).write.text(path)
    read = read_csv(spark, path, {"sep": ";"}).toDF(*cells)
    return read.withColumn("n_counted", F.lit(read.count()).cast("long"))


def q_save_modes(spark, d):
    path, part = _scratch(spark, "save-modes"), _table(spark, d, "part")
    schema = part.schema
    kept = []
    for step, mode in enumerate(["append", "append", "ignore", "overwrite"], 1):
        write_csv(part, path, mode=mode, n_files=2)
        # counted now: the next step replaces the files
        kept.append((step, mode, read_csv(spark, path, schema=schema).count()))
    return spark.createDataFrame(kept, "step int, mode string, n_rows long")


def q_load_files(spark, d):
    # the partition count asked for shows in the files; the metadata is one file
    target = _scratch(spark, "load-files")
    meta, data = load_key_value(spark, _table(spark, d, "orders"), target, name="orders",
                                n_partitions=3, max_records_per_file=None)
    read = read_key_value(spark, [meta, data]).withColumn("file", F.input_file_name())
    kind = F.when(F.col("file").contains("/meta/"), "meta").otherwise("data").alias("kind")
    return read.groupBy(kind).agg(F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))


def q_load_job(spark, d):
    target = _scratch(spark, "load-job")
    meta, data = load_key_value(spark, _table(spark, d, "orders"), target, name="orders",
                                ids="ordered", order_by=["o_orderkey"])
    return read_key_value(spark, [meta, data])


def q_restore_job(spark, d):
    target = _scratch(spark, "restore-job")
    load_key_value(spark, _table(spark, d, "orders"), target, name="orders")
    table, _ = restore_table(spark, target)
    return table


def q_parquet_restore_job(spark, d):
    target = _scratch(spark, "restore-job-parquet")
    load_key_value(spark, _table(spark, d, "lineitem"), target, name="lineitem",
                   kv_format="parquet")
    table, _ = restore_table(spark, target, kv_format="parquet")
    return table


def q_bucketed_restore(spark, d):
    # cells in buckets by id: the restore of the whole table shuffles nothing
    target = _scratch(spark, "restore-job-buckets")
    load_key_value(spark, _table(spark, d, "lineitem"), target, name="lineitem", kv_format="buckets")
    return restore_table(spark, target, kv_format="buckets")[0]


def q_csv_restore_documents(spark, d):
    # whole documents, line breaks and all, through key-value CSV that can be split
    target = _scratch(spark, "csv-restore")
    load_key_value(spark, _table(spark, d, "documents"), target, name="documents")
    return restore_table(spark, target)[0]


def q_zip_read(spark, d):
    path = _scratch(spark, "zip-read")
    write_zipped_csv(_table(spark, d, "nation").repartition(3), path, {"header": "true"})
    return read_zipped_csv(spark, path, {"header": "true", "inferSchema": "true"})


def q_zip_entries(spark, d):
    # three archives or more of several entries, each with its header; ';' and a date format
    path = _scratch(spark, "zip-entries")
    orders = _table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice",
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("o_orderdate"))
    layout = {"header": "true", "sep": ";"}
    write_zipped_csv(_parts(orders, 3, 50_000), path, layout, max_records_per_file=1000)
    return read_zipped_csv(spark, path, layout | {"inferSchema": "true", "dateFormat": "dd.MM.yyyy"})


def q_zip_documents(spark, d):
    # whole documents, with line breaks, '#' lines and quotes inside cells
    path = _scratch(spark, "zip-documents")
    docs = _table(spark, d, "documents")
    layout = {"header": "true", "nullValue": "\\N"}
    write_zipped_csv(_parts(docs, 4, 10_000), path, layout, max_records_per_file=200)
    return read_zipped_csv(spark, path, layout, schema=docs.schema)


def q_zip_key_value(spark, d):
    path = _scratch(spark, "zip-key-value")
    docs = _table(spark, d, "documents")
    kv = key_value_columns(docs, ids="ordered", order_by=["doc_id"])
    write_key_value(kv, path, "zip")
    return read_key_value(spark, path, "zip")


def q_zip_restore_job(spark, d):
    target = _scratch(spark, "zip-restore-job")
    load_key_value(spark, _table(spark, d, "customer"), target, name="customer",
                   kv_format="zip")
    table, _ = restore_table(spark, target, kv_format="zip")
    return table


def q_workbook_read(spark, d):
    path = _scratch(spark, "workbook-read")
    write_workbooks(_parts(_table(spark, d, "supplier"), 3, 50_000), path, {"header": "true"})
    return read_workbooks(spark, path, {"header": "true", "inferSchema": "true"})


def q_workbook_load_job(spark, d):
    books, target = _scratch(spark, "workbook-src"), _scratch(spark, "workbook-load")
    write_workbooks(_parts(_table(spark, d, "supplier"), 2, 50_000), books, {"header": "true"})
    meta, data = load_key_value(spark, books, target, name="supplier", fmt="excel",
                                read_options={"header": "true", "inferSchema": "true"},
                                ids="ordered", order_by=["s_suppkey"])
    return read_key_value(spark, [meta, data])


def q_csv_load_job(spark, d):
    src, target = _scratch(spark, "csv-src"), _scratch(spark, "csv-load")
    write_csv(_table(spark, d, "part"), src, {"header": "true"})
    meta, data = load_key_value(spark, src, target, name="part", fmt="csv",
                                read_options={"header": "true", "inferSchema": "true"},
                                ids="ordered", order_by=["p_partkey"])
    return read_key_value(spark, [meta, data])


def q_stream_key_value(spark, d):
    events = _table(spark, d, "events")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .parquet(d))
    out, ckpt = _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt")
    query = start_key_value_stream(stream, F.col("event_id") + 1, out, ckpt,
                                   available_now=True)
    query.awaitTermination()
    return spark.read.parquet(out)


def q_stream_key_value_subset(spark, d):
    events = _table(spark, d, "events")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .parquet(d))
    out, ckpt = _scratch(spark, "stream-out"), _scratch(spark, "stream-ckpt")
    query = start_key_value_stream(stream, F.col("event_id") + 1, out, ckpt,
                                   available_now=True, columns=["user_id", "value"])
    query.awaitTermination()
    return spark.read.parquet(out)


QUERIES: dict[str, Query] = {
    "key_value": q_key_value,
    "key_value_lineitem": q_key_value_lineitem,
    "number_cells": q_number_cells,
    "meta_key_value": q_meta_key_value,
    "recover_schema": q_recover_schema,
    "id_num": q_id_num,
    "id_num_orders": q_id_num_orders,
    "split_struct_events": q_split_struct_events,
    "convert_struct_events": q_convert_struct_events,
    "restore_table": q_restore_table,
    "combined_export": q_combined_export,
    "combined_export_text": q_combined_export_text,
    "restore_combined": q_restore_combined,
    "restore_lenient": q_restore_lenient,
    "key_value_subset": q_key_value_subset,
    "string_columns": q_string_columns,
    "prefix_columns": q_prefix_columns,
    "clear_columns": q_clear_columns,
    "rows_matching": q_rows_matching,
    "split_struct": q_split_struct,
    "convert_struct": q_convert_struct,
    "array_column": q_array_column,
    "array_to_struct": q_array_to_struct,
    "explode_column": q_explode_column,
    "partition_profile": q_partition_profile,
    "add_partition": q_add_partition,
    "unique_ids": q_unique_ids,
    "partition_ids": q_partition_ids,
    "partition_ids_rows": q_partition_ids_rows,
    "group_row_numbers": q_group_row_numbers,
    "group_row_numbers_keys": q_group_row_numbers_keys,
    "max_partition_rows": q_max_partition_rows,
    "ordered_ids": q_ordered_ids,
    "ordered_ids_rows": q_ordered_ids_rows,
    "audit_cells": q_audit_cells,
    "describe_table": q_describe_table,
    "profile_columns": q_profile_columns,
    "csv_read": q_csv_read,
    "csv_read_schema": q_csv_read_schema,
    "csv_round_trip": q_csv_round_trip,
    "load_job": q_load_job,
    "restore_job": q_restore_job,
    "parquet_restore_job": q_parquet_restore_job,
    "bucketed_restore": q_bucketed_restore,
    "csv_restore_documents": q_csv_restore_documents,
    "zip_read": q_zip_read,
    "zip_key_value": q_zip_key_value,
    "zip_restore_job": q_zip_restore_job,
    "workbook_read": q_workbook_read,
    "workbook_load_job": q_workbook_load_job,
    "csv_load_job": q_csv_load_job,
    "stream_key_value": q_stream_key_value,
    "key_value_id_subset": q_key_value_id_subset,
    "meta_counts": q_meta_counts,
    "restore_nested": q_restore_nested,
    "combined_export_order": q_combined_export_order,
    "combined_export_text_order": q_combined_export_text_order,
    "partition_profile_empty": q_partition_profile_empty,
    "audit_damaged": q_audit_damaged,
    "audit_damaged_rows": q_audit_damaged_rows,
    "table_like": q_table_like,
    "csv_malformed": q_csv_malformed,
    "save_modes": q_save_modes,
    "load_files": q_load_files,
    "zip_entries": q_zip_entries,
    "zip_documents": q_zip_documents,
    "stream_key_value_subset": q_stream_key_value_subset,
}


# ---------------------------------------------------------------- oracle

def _cols(table):
    return [(c, t) for c, t, _ in TABLES[table]]


def _meta_sql(table):
    return S.meta_values(table, [_json_of(c, j) for c, _, j in TABLES[table]])


def _select_all(table):
    return f"SELECT * FROM {table}"


_ORDERS_CELLS = S.cells("orders", _cols("orders"), ["o_orderkey"])
_NATION_CELLS = S.cells("nation", _cols("nation"), ["n_nationkey"])


def _number_cells_sql():
    sel = []
    for k, (c, _, _) in enumerate(TABLES["orders"], start=1):
        sel += [f"id AS {c}__id", f"CAST({k} AS BIGINT) AS {c}__num", f"{c} AS {c}__val"]
    return f"SELECT {', '.join(sel)} FROM ({S.numbered('orders', ['o_orderkey'])}) r"


def _recover_sql():
    rows = ", ".join(f"(CAST({k} AS BIGINT), '{c}', '{j}', true)"
                     for k, (c, _, j) in enumerate(TABLES["orders"], start=1))
    return f"SELECT * FROM (VALUES {rows}) AS s(num, name, type, nullable)"


def _string_columns_sql():
    return "SELECT " + ", ".join(f"{S.text_of(c, t)} AS {c}" for c, t in _cols("events")) + \
        " FROM events"


def _prefix_sql():
    return "SELECT " + ", ".join(f"{c} AS __{c}" for c, _ in _cols("customer")) + " FROM customer"


_EVENTS_INFO = ("SELECT event_id, CASE WHEN event_id % 7 > 0 THEN event_type END AS event_type, "
                "CASE WHEN event_id % 7 > 0 AND user_id % 3 > 0 THEN user_id END AS user_id, "
                "CASE WHEN event_id % 7 > 0 THEN props END AS props FROM events")
_NATION_INFO = ("SELECT n_nationkey, n_name, CASE WHEN n_regionkey <> 0 THEN n_regionkey END "
                "AS n_regionkey FROM nation")


def _array_column_sql():
    items = "s_suppkey, s_name, s_nationkey, s_acctbal"
    cast = ", ".join(f"CAST({c} AS VARCHAR)" for c in items.split(", "))
    return f"SELECT CAST(to_json([{cast}]) AS VARCHAR) AS arr FROM supplier"


_EMB_DAMAGED = ("SELECT vec_id, CASE WHEN label = 0 THEN NULL WHEN label = 1 "
                "THEN CAST([] AS FLOAT[]) ELSE embedding END AS embedding, label "
                "FROM embeddings")


def _array_to_struct_sql():
    fields = ", ".join(f"embedding[{i + 1}] AS col_{i}" for i in range(EMBEDDING_STRUCT_LENGTH))
    return f"SELECT vec_id, label, {fields} FROM ({_EMB_DAMAGED}) e"


def _explode_sql():
    return (f"WITH e AS ({_EMB_DAMAGED}) "
            "SELECT vec_id, label, unnest(embedding) AS explode FROM e "
            "WHERE len(embedding) > 0 "
            "UNION ALL SELECT vec_id, label, CAST(NULL AS FLOAT) AS explode FROM e "
            "WHERE embedding IS NULL OR len(embedding) = 0")


def _describe_sql():
    parts, cols = [], _cols("customer")
    row = "concat_ws(chr(1), " + ", ".join(f"coalesce({S.text_of(c, t)}, chr(2))" for c, t in cols) + ")"
    for k, (c, t) in enumerate(cols, start=1):
        st = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}[t]
        text = S.text_of(c, t)
        parts.append(f"SELECT CAST({k} AS BIGINT) AS num, '{c}' AS name, '{st}' AS type, "
                     f"true AS nullable, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
                     f"CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest, "
                     f"(SELECT list(t ORDER BY h) FROM (SELECT {text} AS t, sha256({row}) AS h FROM customer "
                     "ORDER BY h LIMIT 5) s) AS sample FROM customer")
    return " UNION ALL ".join(parts)


def _damaged_rows_sql():
    spoilt = "c_mktsegment = 'BUILDING' AND c_acctbal IS NOT NULL"
    return (f"WITH x AS (SELECT *, c_name LIKE '%7' AS lost, {spoilt} AS bad FROM customer) "
            "SELECT c_custkey, c_name, c_acctbal, 'missing' AS side, CAST(1 AS BIGINT) AS n FROM x WHERE lost OR bad "
            "UNION ALL SELECT c_custkey, CASE WHEN NOT lost THEN c_name END, CASE WHEN NOT bad THEN c_acctbal END, "
            "'extra', 1 FROM x WHERE lost OR bad")


def _table_like_sql():
    return " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS num, '{c}' AS name, '{dt}' AS type, 2 * count(*) AS n_rows, true AS nulls_alike, "
        "true AS texts_within FROM orders" for k, (c, dt) in enumerate(
            [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
             ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")], start=1))


def _profile_sql():
    return " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS num, '{c}' AS name, count({c}) > 0 AS near, "
        f"{'CAST(NULL AS BOOLEAN)' if t == 'VARCHAR' else f'count({c}) > 0'} AS quartiles_near FROM orders"
        for k, (c, t) in enumerate(_cols("orders"), start=1))


def _audit_sql():
    metrics = [("rows", "count(*)"), ("columns", "5"), ("cells_expected", "count(*) * 5"),
               ("data_cells", "count(*) * 5"), ("meta_cells", "6"),
               ("restored_rows", "count(*)"), ("unparsed_cells", "0"), ("schema_equal", "1"),
               ("missing_rows", "0"), ("extra_rows", "0")]
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({v} AS BIGINT) AS value"
        + (" FROM customer" if "count" in v else "") for m, v in metrics)


def _damaged_sql():
    lost, spoilt = "c_name LIKE '%7'", "c_mktsegment = 'BUILDING' AND c_acctbal IS NOT NULL"
    metrics = [("rows", "count(*)"), ("columns", "5"), ("cells_expected", "count(*) * 5"),
               ("data_cells", f"count(*) * 5 - count(*) FILTER ({lost})"), ("meta_cells", "6"),
               ("restored_rows", "count(*)"), ("unparsed_cells", f"count(*) FILTER ({spoilt})"),
               ("schema_equal", "1"),
               ("missing_rows", f"count(*) FILTER ({lost} OR ({spoilt}))"),
               ("extra_rows", f"count(*) FILTER ({lost} OR ({spoilt}))")]
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({v} AS BIGINT) AS value"
        + (" FROM customer" if "count" in v else "") for m, v in metrics)


def _meta_counts_sql():
    return " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS num, '{c}' AS name, '{j}' AS type, true AS nullable, "
        f"count(*) AS n_cells, count({c}) AS n_values FROM orders"
        for k, (c, _, j) in enumerate(TABLES["orders"], start=1))


def _export_order_sql(text_order):
    """Rows of the export of ``orders`` numbered by the order asked for."""
    export = f"{_meta_sql('orders')} UNION ALL {S.key_value(_ORDERS_CELLS)}"
    by = "key" if text_order else ("CAST(split_part(key, ',', 1) AS BIGINT), "
                                   "CAST(split_part(key, ',', 2) AS BIGINT)")
    return f"SELECT row_number() OVER (ORDER BY {by}) AS id, key, val FROM ({export}) x"


def _id_subset_sql():
    cells = S.cells("events", _cols("events"), [], id_expr="event_id + 1")
    return S.key_value(f"SELECT id, num, val FROM ({cells}) c WHERE num IN (3, 5)")


def _rows_matching_sql():
    p = MATCH_PATTERN
    return (f"SELECT * FROM conversations WHERE regexp_matches(role, '{p}') "
            f"OR regexp_matches(text, '{p}')")


ORACLE_SQL: dict[str, str] = {
    "key_value": S.key_value(_ORDERS_CELLS),
    "key_value_lineitem": S.key_value(S.cells("lineitem", _cols("lineitem"), LINEITEM_ORDER)),
    "number_cells": _number_cells_sql(),
    "meta_key_value": _meta_sql("orders"),
    "recover_schema": _recover_sql(),
    "id_num": f"SELECT id, num, val FROM ({S.cells('region', _cols('region'), ['r_regionkey'])}) c",
    "id_num_orders": _ORDERS_CELLS,
    "split_struct_events": _EVENTS_INFO,
    "convert_struct_events": ("SELECT event_id, concat_ws(',', event_type, CAST(user_id AS VARCHAR), props) "
                              f"AS info FROM ({_EVENTS_INFO}) e"),
    "restore_table": _select_all("lineitem"),
    "combined_export": _meta_sql("nation") + " UNION ALL " + S.key_value(_NATION_CELLS),
    "combined_export_text": _meta_sql("nation") + " UNION ALL " + S.key_value(_NATION_CELLS),
    "restore_combined": _select_all("orders"),
    "restore_lenient": _select_all("orders"),
    "key_value_subset": S.key_value(
        f"SELECT id, num, val FROM ({S.cells('lineitem', _cols('lineitem'), LINEITEM_ORDER)}) c "
        "WHERE num IN (6, 11)"),
    "string_columns": _string_columns_sql(),
    "prefix_columns": _prefix_sql(),
    "clear_columns": ("SELECT conv_id, turn, regexp_replace(role, '\\d+', '#', 'g') AS role, "
                      "regexp_replace(text, '\\d+', '#', 'g') AS text FROM conversations"),
    "rows_matching": _rows_matching_sql(),
    "split_struct": _NATION_INFO,
    "convert_struct": (f"SELECT n_nationkey, concat_ws(',', n_name, CAST(n_regionkey AS VARCHAR)) "
                       f"AS info FROM ({_NATION_INFO}) n"),
    "array_column": _array_column_sql(),
    "array_to_struct": _array_to_struct_sql(),
    "explode_column": _explode_sql(),
    "partition_profile": ("SELECT CAST(8 AS BIGINT) AS n_partitions, count(*) AS n_rows, "
                          "CAST(0 AS BIGINT) AS n_empty FROM lineitem"),
    "add_partition": ("SELECT CAST(8 AS BIGINT) AS n_partitions, count(*) AS n_rows, "
                      "0 AS min_part, 7 AS max_part FROM lineitem"),
    "unique_ids": ("SELECT count(*) AS n_rows, count(*) AS n_ids, true AS ids_positive "
                   "FROM lineitem"),
    "partition_ids": ("SELECT count(*) AS n_rows, count(*) AS n_ids, true AS ids_positive "
                      "FROM lineitem"),
    "partition_ids_rows": "SELECT row_number() OVER () AS id, * FROM lineitem",
    "group_row_numbers": ("SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY "
                          f"{', '.join(LINEITEM_ORDER)}) AS row_number FROM lineitem"),
    "group_row_numbers_keys": (
        "SELECT *, row_number() OVER (PARTITION BY big, o_orderstatus ORDER BY -o_totalprice, o_orderkey) "
        "AS place FROM (SELECT *, CASE WHEN o_custkey % 5 > 0 THEN o_custkey END AS big FROM orders) o"),
    "max_partition_rows": ("SELECT max(n) AS n_rows FROM (SELECT count(*) AS n FROM lineitem "
                           "GROUP BY l_returnflag) g"),
    "ordered_ids": "SELECT row_number() OVER (ORDER BY p_partkey) AS id, p_partkey, p_name "
                   "FROM part",
    "ordered_ids_rows": S.numbered("lineitem", LINEITEM_ORDER),
    "audit_cells": _audit_sql(),
    "describe_table": _describe_sql(),
    "profile_columns": _profile_sql(),
    "csv_read": ("SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, "
                 "p_size, p_retailprice FROM part"),
    "csv_read_schema": _select_all("orders"),
    "csv_round_trip": _select_all("documents"),
    "load_job": _meta_sql("orders") + " UNION ALL " + S.key_value(_ORDERS_CELLS),
    "restore_job": _select_all("orders"),
    "parquet_restore_job": _select_all("lineitem"),
    "bucketed_restore": _select_all("lineitem"),
    "csv_restore_documents": _select_all("documents"),
    "zip_read": _select_all("nation"),
    "zip_key_value": S.key_value(S.cells("documents", [
        ("doc_id", "BIGINT"), ("text", "VARCHAR"), ("lang", "VARCHAR"), ("source", "VARCHAR"),
        ("n_chars", "BIGINT")], ["doc_id"])),
    "zip_restore_job": _select_all("customer"),
    "workbook_read": ("SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, "
                      "s_acctbal FROM supplier"),
    "workbook_load_job": S.meta_values("supplier", [
        _json_of("s_suppkey", "integer"), _json_of("s_name", "string"),
        _json_of("s_nationkey", "integer"), _json_of("s_acctbal", "double")])
    + " UNION ALL " + S.key_value(S.cells("supplier", [
        ("s_suppkey", "BIGINT"), ("s_name", "VARCHAR"), ("s_nationkey", "INTEGER"),
        ("s_acctbal", "DOUBLE")], ["s_suppkey"])),
    "csv_load_job": S.meta_values("part", [
        _json_of("p_partkey", "integer"), _json_of("p_name", "string"),
        _json_of("p_brand", "string"), _json_of("p_type", "string"),
        _json_of("p_size", "integer"), _json_of("p_retailprice", "double")])
    + " UNION ALL " + S.key_value(S.cells("part", [
        ("p_partkey", "BIGINT"), ("p_name", "VARCHAR"), ("p_brand", "VARCHAR"),
        ("p_type", "VARCHAR"), ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE")],
        ["p_partkey"])),
    "stream_key_value": S.key_value(S.cells("events", _cols("events"), [],
                                            id_expr="event_id + 1")),
    "key_value_id_subset": _id_subset_sql(),
    "meta_counts": _meta_counts_sql(),
    "restore_nested": ("SELECT event_id, ts, user_id, event_type, value, value AS value_of_user, "
                       "event_type AS type_of_day FROM events"),
    "combined_export_order": _export_order_sql(False),
    "combined_export_text_order": _export_order_sql(True),
    "partition_profile_empty": ("SELECT CAST(8 AS BIGINT) AS n_partitions, count(*) AS n_rows, "
                                "true AS has_empty FROM orders"),
    "audit_damaged": _damaged_sql(),
    "audit_damaged_rows": _damaged_rows_sql(),
    "table_like": _table_like_sql(),
    "csv_malformed": ("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, "
                      "CAST(p_size AS VARCHAR) AS p_size, count(*) OVER () AS n_counted "
                      "FROM part WHERE p_partkey % 7 <> 3"),
    "save_modes": " UNION ALL ".join(
        f"SELECT {step} AS step, '{mode}' AS mode, count(*) * {times} AS n_rows FROM part"
        for step, mode, times in [(1, "append", 1), (2, "append", 2), (3, "ignore", 2),
                                  (4, "overwrite", 1)]),
    "load_files": ("SELECT 'data' AS kind, CAST(3 AS BIGINT) AS n_files, count(*) * 6 AS n_rows "
                   "FROM orders UNION ALL SELECT 'meta', 1, 7"),
    "zip_entries": ("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderpriority, o_totalprice, "
                    "CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"),
    "zip_documents": _select_all("documents"),
    "stream_key_value_subset": _id_subset_sql(),
}
