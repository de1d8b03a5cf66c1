"""Archives of many entries: work per record and per archive, not per use or entry."""

import os
import zipfile

import pyarrow as pa
import pytest
from conftest import same_rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_sources import local

from cellfold.plans import catalog
from cellfold.plans.inspect import plan_text
from cellfold.sinks.zipped import write_zipped_csv
from cellfold.sources import zipped
from cellfold.sources.zipped import read_zipped_csv


def test_a_task_opens_an_archive_once(spark, scratch, monkeypatch):
    path = local(scratch("zip-once"))
    os.makedirs(path)
    for name in "ab":
        with zipfile.ZipFile(f"{path}/{name}.zip", "w") as zf:
            for k in range(4):
                zf.writestr(f"e{k}.csv", f"{name},{k}\n")
    opened = []
    monkeypatch.setattr(zipped, "open_input", lambda p: opened.append(p) or open(p, "rb"))
    entries = [{"path": f"{path}/{name}.zip", "entry": f"e{k}.csv", "entry_index": k, "size": 4} for name in "ab" for k in range(4)]
    found = [r for b in zipped._entry_reader({})([pa.RecordBatch.from_pylist(entries[:3]), pa.RecordBatch.from_pylist(entries[3:])])
             for r in b.to_pylist()]
    assert opened == [f"{path}/a.zip", f"{path}/b.zip"]
    assert [(r["line"], r["entry_index"], r["rec"]) for r in found] == [(f"{name},{k}", k, 0) for name in "ab" for k in range(4)]


def test_a_record_is_parsed_once(spark, scratch):
    path = scratch("zip-parse")
    table = spark.range(50).select("id", (F.col("id") / 4).alias("x"), F.concat(F.lit("t"), "id").alias("t"))
    write_zipped_csv(table, path, {"header": "true"})
    read = read_zipped_csv(spark, path, {"header": "true"}, schema="id bigint, x double, t string")
    tree = plan_text(read, "simple")
    assert tree.count("from_csv(") == 1
    assert same_rows(read, table)


@pytest.mark.parametrize("odd", [None, "x"])
def test_types_that_the_first_records_suggest_are_checked_on_all(spark, scratch, odd):
    path = scratch("zip-late")
    table = spark.range(0, 3000, 1, 1).select(F.when(F.col("id") == 2999, F.lit(odd)).otherwise(F.col("id").cast("string")).alias("n"),
                                              F.when(F.col("id") > 2500, F.lit("7.5")).alias("late"))
    write_zipped_csv(table, path, {"header": "true"}, max_records_per_file=1000)
    read = read_zipped_csv(spark, path, {"header": "true", "inferSchema": "true"})
    assert [f.dataType for f in read.schema] == [T.StringType() if odd else T.IntegerType(), T.DoubleType()]
    assert read.count() == 3000 and read.where("late = 7.5").count() == 499


def test_archives_grow_in_number(spark):
    assert catalog._parts(spark.range(10), 3, 4).rdd.getNumPartitions() == 3
    assert catalog._parts(spark.range(41), 3, 4).rdd.getNumPartitions() == 11


def test_documents_fill_more_archives_as_they_grow(spark, scratch, monkeypatch):
    folder, path = local(scratch("zip-docs-in")), scratch("zip-docs")
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("#\n\""), "id").alias("text"))
    docs.write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(catalog, "_scratch", lambda *_: path)
    assert same_rows(catalog.q_zip_documents(spark, folder), docs)
    assert sum(f.endswith(".zip") for f in os.listdir(local(path))) == 6
