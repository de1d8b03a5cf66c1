"""The driver contract of __spark_entry__.py."""

import duckdb

import __spark_entry__ as E
from conftest import SF_SMALL


def test_every_query_of_the_catalog_has_an_oracle():
    from cellfold.plans.catalog import ORACLE_SQL, QUERIES
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert len(QUERIES) >= 40


def test_entry_runs_on_the_smoke_tables(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "val"]
    assert df.count() == 1500 * 6


def test_oracle_sql_runs_and_names_match_for_cheap_queries(spark):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "events", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for name in ("key_value", "string_columns", "prefix_columns", "clear_columns",
                 "split_struct", "convert_struct", "describe_table", "id_num"):
        cur = con.execute(E.oracle_sql()[name])
        oracle_cols = sorted(d[0] for d in cur.description)
        assert sorted(E.queries()[name](spark, SF_SMALL).columns) == oracle_cols, name


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from cellfold.session import shared_root

    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}

    local, remote = "file:/w", "hdfs://n/w"
    assert shared_root(Session(spark_master="local[4]", spark_sql_warehouse_dir=local)) == local
    assert shared_root(Session(spark_master="yarn", spark_sql_warehouse_dir=remote)) == remote
    assert shared_root(Session(spark_master="yarn", spark_sql_warehouse_dir=local, spark_checkpoint_dir="/mnt/x/")) == "/mnt/x"
    for where in (local, "/w", "w"):
        with pytest.raises(ValueError, match="all executors share"):
            shared_root(Session(spark_master="spark://h:1", spark_sql_warehouse_dir=where))
