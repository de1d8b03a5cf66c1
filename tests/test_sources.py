"""Sources and sinks: CSV, zipped CSV, workbooks, option sets, save modes."""

import os
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.plans.jobs import load_key_value, read_key_value, restore_table
from cellfold.sinks.csv import write_csv
from cellfold.sinks.workbook import write_workbooks
from cellfold.sinks.zipped import write_zipped_csv
from cellfold.sources.csv import read_csv
from cellfold.sources.options import (
    KEY_VALUE_CSV,
    WHOLE_CSV_READ,
    options_for,
    overlay,
    parse_save_mode,
)
from cellfold.sources.workbook import column_index, column_letters, parse_address, read_workbooks
from cellfold.sources.zipped import read_zipped_csv, zip_entries
from conftest import SF_SMALL, same_rows

NASTY = ["line\nbreak", "crlf\r\nend", 'say "hi"', '""', "back\\slash", 'esc\\"q', "",
         None, "#hash", " lead", "trail ", "a,b", "\\N x", '{"k": "v"}', '{"k": "a\\"b"}']


def local(uri: str) -> str:
    return uri[len("file:"):] if uri.startswith("file:") else uri


@pytest.fixture()
def nasty(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(NASTY)], "i int, s string")


def test_option_overlay_and_prefix():
    assert overlay({"a": "1", "b": "2"}, {"b": 3, "c": True}, {"a": None}) == {"b": "3", "c": "true"}
    conf = {"reader.csv.header": "true", "reader.csv.delimiter": ";", "writer.csv.header": "x"}
    assert options_for(conf, "reader.csv") == {"header": "true", "delimiter": ";"}


def test_save_modes():
    assert parse_save_mode(" Append ") == "append"
    assert parse_save_mode(None) == "overwrite"
    assert parse_save_mode("ERRORIFEXISTS") == "errorifexists"
    with pytest.raises(ValueError):
        parse_save_mode("replace")


def test_csv_reference_defaults(spark, scratch):
    path = scratch("csv")
    os.makedirs(local(path))
    with open(local(path) + "/t.csv", "w") as f:
        f.write("a;b;c;d\n1;2;3;text, with comma\n# comment\n4;5;6;more\n")
    df = read_csv(spark, path, {"header": "true", "delimiter": ";", "inferSchema": "true"})
    assert df.columns == ["a", "b", "c", "d"]
    assert df.count() == 2
    assert df.schema["a"].dataType == T.IntegerType()


def test_csv_malformed_count_equals_collect(spark, scratch):
    path = scratch("csv-bad")
    os.makedirs(local(path))
    with open(local(path) + "/t.csv", "w") as f:
        f.write("1,x\n2,y\nnot-a-number,z\n3,w\n4\n")
    df = read_csv(spark, path, schema="n int, s string")
    assert df.count() == len(df.collect()) == 3


def test_csv_nasty_text_round_trip(spark, scratch, nasty):
    path = scratch("csv-nasty")
    write_csv(nasty, path, KEY_VALUE_CSV)
    back = spark.read.schema(nasty.schema).options(**WHOLE_CSV_READ).csv(path)
    assert sorted(back.collect(), key=lambda r: r.i) == sorted(nasty.collect(), key=lambda r: r.i)


def test_zip_nasty_text_round_trip(spark, scratch, nasty):
    path = scratch("zip-nasty")
    write_zipped_csv(nasty.repartition(3), path, KEY_VALUE_CSV)
    back = read_zipped_csv(spark, path, overlay(KEY_VALUE_CSV, {"comment": ""}),
                           schema="i int, s string")
    assert sorted(back.collect(), key=lambda r: r.i) == sorted(nasty.collect(), key=lambda r: r.i)


def test_zip_several_archives_entries_headers(spark, scratch):
    path = local(scratch("zip-many"))
    os.makedirs(path)
    for a in range(3):
        with zipfile.ZipFile(f"{path}/arch{a}.zip", "w") as zf:
            zf.writestr("dir/", "")
            zf.writestr("empty.csv", "")
            for e in range(2):
                rows = "".join(f"{a * 100 + e * 10 + r},name {r},{r * 1.5}\n" for r in range(4))
                zf.writestr(f"dir/e{e}.csv", "id,name,score\n" + rows)
    entries = zip_entries(spark, path)
    assert entries.count() == 9  # directory entries are skipped, the empty one listed
    df = read_zipped_csv(spark, path, {"header": "true", "inferSchema": "true"})
    assert df.columns == ["id", "name", "score"]
    assert df.count() == 3 * 2 * 4
    assert dict((f.name, f.dataType) for f in df.schema.fields) == {
        "id": T.IntegerType(), "name": T.StringType(), "score": T.DoubleType()}
    assert df.agg(F.sum("id")).first()[0] == sum(
        a * 100 + e * 10 + r for a in range(3) for e in range(2) for r in range(4))


def test_zip_malformed_modes(spark, scratch):
    path = local(scratch("zip-bad"))
    os.makedirs(path)
    with zipfile.ZipFile(f"{path}/x.zip", "w") as zf:
        zf.writestr("a.csv", "1,a\n2\nx,b\n3,c,extra\n4,d\n")
    keep = read_zipped_csv(spark, path, {"mode": "PERMISSIVE"}, schema="n int, s string")
    assert keep.count() == 5
    drop = read_zipped_csv(spark, path, {"mode": "DROPMALFORMED"}, schema="n int, s string")
    assert sorted(drop.collect()) == [Row(n=1, s="a"), Row(n=4, s="d")]
    with pytest.raises(Exception, match="malformed record"):
        read_zipped_csv(spark, path, {"mode": "FAILFAST"}, schema="n int, s string").collect()


def test_key_value_through_zip_restores(spark, scratch):
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    target = scratch("zip-job")
    load_key_value(spark, customer, target, name="customer", kv_format="zip")
    back, name = restore_table(spark, target, kv_format="zip")
    assert name == "customer" and back.schema == customer.schema
    assert same_rows(back, customer)


def test_load_job_quote_clearing_can_be_restored(spark, scratch):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").drop("props")
    target = scratch("clear-job")
    load_key_value(spark, events, target, name="events", clear_quotes=True)
    meta = read_key_value(spark, f"{target}/meta").collect()
    assert all('"' not in r.val for r in meta)
    back, _ = restore_table(spark, target)
    assert same_rows(back, events)


def test_parquet_key_value_job(spark, scratch):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    target = scratch("pq-job")
    load_key_value(spark, orders, target, kv_format="parquet")
    back, name = restore_table(spark, target, kv_format="parquet")
    assert same_rows(back, orders)


def test_save_mode_errorifexists_and_ignore(spark, scratch):
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    path = scratch("modes")
    write_zipped_csv(region, path)
    with pytest.raises(FileExistsError):
        write_zipped_csv(region, path, mode="errorifexists")
    write_zipped_csv(region, path, mode="ignore")
    write_zipped_csv(region, path, mode="append")
    assert read_zipped_csv(spark, path, schema="k int, n string").count() == 10


def test_address_helpers():
    assert column_index("A") == 0 and column_index("AA") == 26 and column_letters(27) == "AB"
    assert parse_address("'My Sheet'!B3:D10") == ("My Sheet", 1, 2, 3, 9)
    assert parse_address("C4") == (None, 2, 3, None, None)


def _hand_made_workbook(path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><sheets>'
                    '<sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels",
                    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                    'relationships"><Relationship Id="rId1" Target="worksheets/s.xml" '
                    'Type="x"/></Relationships>')
        zf.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>name</t></si><si><t>when</t></si>'
                    '<si><r><t>rich </t></r><r><t>text</t></r></si></sst>')
        zf.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/>'
                    '<xf numFmtId="14"/></cellXfs></styleSheet>')
        zf.writestr("xl/worksheets/s.xml", f'<worksheet {ns}><sheetData>'
                    '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c>'
                    '<c r="D2" t="inlineStr"><is><t>flag</t></is></c></row>'
                    '<row r="3"><c r="B3" t="s"><v>2</v></c><c r="C3" s="1"><v>45000</v></c>'
                    '<c r="D3" t="b"><v>1</v></c></row>'
                    '<row r="4"><c r="B4"><v>12.5</v></c><c r="D4" t="b"><v>0</v></c></row>'
                    '</sheetData></worksheet>')


def test_workbook_shared_strings_dates_offsets(spark, scratch):
    path = local(scratch("xlsx-hand"))
    os.makedirs(path)
    _hand_made_workbook(f"{path}/a.xlsx")
    df = read_workbooks(spark, path, {"header": "true", "dataAddress": "'Data'!B2",
                                      "inferSchema": "true"})
    assert df.columns == ["name", "when", "flag"]
    rows = sorted(df.collect(), key=lambda r: str(r.name))
    assert rows[0].name == "12.5" and rows[0].when is None and rows[0].flag is False
    assert rows[1].name == "rich text" and str(rows[1].when) == "2023-03-15"
    assert rows[1].flag is True


def test_workbook_sink_rolls_files_at_row_limit(spark, scratch):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet").select("p_partkey", "p_name")
    path = scratch("xlsx-roll")
    write_workbooks(part.coalesce(1), path, {"header": "true", "maxRowsPerFile": "51"})
    files = [f for f in os.listdir(local(path)) if f.endswith(".xlsx")]
    assert len(files) == 4  # 200 rows, 50 per file next to the header
    back = read_workbooks(spark, path, {"header": "true"}, schema="p_partkey long, p_name string")
    assert same_rows(back, part)


def test_load_jobs_release_only_their_own_stages(spark, scratch, monkeypatch):
    from cellfold import session
    made, gone = [], []
    save, delete = session.Stages.save, session.delete_tree
    monkeypatch.setattr(session.Stages, "save", lambda self, df, tag="stage": (save(self, df, tag), made.extend(self.paths))[0])
    monkeypatch.setattr(session, "delete_tree", lambda s, p: (delete(s, p), gone.append(p))[0])
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    other = session.Stages(spark)
    kept = other.save(orders.limit(3), "other")
    target = scratch("release") + ".csv"  # the name of a target says nothing about its layout
    dealt = orders.distinct()  # rows without positions in files: these ids need a copy
    load_key_value(spark, dealt, target, ids="partition")
    assert set(made) - set(other.paths) == set(gone) and gone and kept.count() == 3
    back, _ = restore_table(spark, target)
    assert same_rows(back, orders)
    bad = orders.withColumn("o_orderpriority", F.lit("\\N"))
    with pytest.raises(Exception, match="equals the null text"):
        load_key_value(spark, bad.distinct(), target + "-zip", kv_format="zip", ids="partition")
    assert set(made) - set(other.paths) == set(gone)
    other.release()


def test_zipped_cells_may_hold_comments_and_any_length(spark, scratch):
    path = scratch("zipnasty")
    rows = [(1, "line one\n# heading\nline three"), (2, "x" * 200_000), (3, "plain")]
    df = spark.createDataFrame(rows, "id long, txt string").coalesce(1)
    write_zipped_csv(df, path, {"header": "true", "sep": ";"})
    back = read_zipped_csv(spark, path, {"header": "true", "sep": ";"}, schema="id long, txt string")
    assert same_rows(back, df)


def test_workbook_round_trip_types_and_hostile_text(spark, scratch):
    from datetime import date, datetime
    rows = [(1, 2.5, True, date(2024, 2, 29), datetime(2024, 1, 2, 3, 4, 5), "a<b>&\"c'"),
            (2, -1e-3, False, date(1999, 12, 31), datetime(1970, 1, 1, 0, 0, 0), "tab\tnl\nx"),
            (3, None, None, None, None, "ctl\x01\x1fz"),
            (4, 1e15, True, date(2000, 1, 1), datetime(2038, 1, 19, 3, 14, 7), None)]
    schema = "i int, d double, b boolean, day date, at timestamp_ntz, s string"
    df = spark.createDataFrame(rows, schema)
    path = scratch("xlsx-types")
    write_workbooks(df.repartition(2), path, {"header": "true"})
    back = read_workbooks(spark, path, {"header": "true"}, schema=schema)
    assert same_rows(back, df)


def test_zip_reader_spreads_entries_and_prunes_contents(spark, scratch):
    from cellfold.plans.inspect import plan_text
    region = spark.read.parquet(f"{SF_SMALL}/region.parquet")
    path = scratch("zip-plan")
    write_zipped_csv(region.repartition(2), path)
    df = read_zipped_csv(spark, path, schema="k int, n string")
    text = plan_text(df)
    head = text.split("\n\n\n", 1)[0]
    # listing -> exchange (entries over tasks) -> reading
    assert head.count("MapInPandas") == 1 and head.count("MapInArrow") == 1 and "Exchange" in head
    assert "ReadSchema: struct<path:string>" in text  # contents are not loaded
    assert df.count() == 5


def test_csv_without_schema_counts_what_it_collects(spark, scratch):
    path = scratch("bad-csv")
    spark.createDataFrame([("1,a",), ("2,b,extra",), ("3",), ("4,d",)], "value string").coalesce(1).write.text(path)
    for options in ({}, {"inferSchema": "true"}):
        df = read_csv(spark, path, options)
        assert df.count() == len(df.collect()) == 2
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string"]


def test_zip_formats_duplicate_headers_and_paths_with_spaces(spark, scratch):
    path = scratch("zip") + "/a folder with 100%"
    rows = [("31.12.2024", "1", "x`y"), ("01.02.2025", "2", None)]
    df = spark.createDataFrame(rows, "`a.b` string, `n` string, `A.B` string")
    layout = {"header": "true", "sep": ";", "encoding": "UTF-16"}
    write_zipped_csv(df.coalesce(1), path, layout, max_records_per_file=1)
    assert zip_entries(spark, path).count() == 2
    back = read_zipped_csv(spark, path, layout | {"inferSchema": "true", "dateFormat": "dd.MM.yyyy"})
    assert back.columns == ["a.b0", "n", "A.B2"]
    assert [f.dataType.simpleString() for f in back.schema] == ["date", "int", "string"]
    assert sorted((str(a), n, t) for a, n, t in back.collect()) == [("2024-12-31", 1, "x`y"), ("2025-02-01", 2, None)]


def test_zip_sink_writes_binary_and_nested_text(spark, scratch):
    path = scratch("zip-binary")
    df = spark.sql("select X'00FF' as b, array(1, 2) as a, struct(TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' as t) as s")
    write_zipped_csv(df, path)
    back = read_zipped_csv(spark, path, schema=df.schema)
    assert back.collect() == df.collect()


def test_zip_overwrite_leaves_new_files_only(spark, scratch):
    path = scratch("zip-twice")
    for n in (5, 3):
        write_zipped_csv(spark.range(n), path)
    assert read_zipped_csv(spark, path, schema="id long").count() == 3
    write_zipped_csv(spark.range(2), path, mode="append")
    assert read_zipped_csv(spark, path, schema="id long").count() == 5


@pytest.mark.parametrize("stored, text", [
    ("9007199254740993", "9007199254740993"), ("12345678901234567890.123456", "12345678901234567890.123456"),
    ("5.0", "5"), ("0.10000000000000001", "0.1"), ("1E+20", "1e+20"), ("-0.5", "-0.5")])
def test_workbook_numbers_keep_their_digits(stored, text):
    from cellfold.sources.workbook import _number_text
    assert _number_text(stored) == text


def test_key_value_csv_is_split_and_keeps_every_text(spark, scratch, monkeypatch):
    texts = ["", "\\N", "%=", "%=%n", "a%nb\nc", "\r", "\r\n", '"\n"', " x ", "\\", "\\\n\\", "%p%", ",", "\u2028", "#", None, "é\n\U0001F600"]
    rows = [(i, t if i < len(texts) else f"line {i}\n" * 30) for i, t in enumerate(texts + [""] * 3000)]
    df = spark.createDataFrame(rows, "n long, txt string").coalesce(1)
    target = scratch("split")
    load_key_value(spark, df, target, max_records_per_file=None, n_partitions=1)
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        read = read_key_value(spark, f"{target}/data")
        assert len(read.inputFiles()) == 1 and read.rdd.getNumPartitions() >= 4
        back, _ = restore_table(spark, target)
        assert same_rows(back, df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)
    # files of other writers, with line breaks inside cells
    other = scratch("other")
    write_csv(spark.createDataFrame([("1,1", "a\nb"), ("1,2", "c")], "key string, val string"), other, KEY_VALUE_CSV)
    assert read_key_value(spark, other, options={"multiLine": "true"}).count() == 2


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_failed_overwrite_leaves_one_table(spark, scratch, step):
    """A commit that dies before its manifest is in place leaves the old rows, after it the new ones."""
    from cellfold.sinks.staged import StagedFiles, Staging
    from cellfold.sources.files import filesystem
    path = scratch("torn")
    old, new = (spark.createDataFrame([(k, i) for i in range(20)], "k string, i int").repartition(3) for k in ("old", "new"))
    layout = {"header": "true"}
    rows = lambda: sorted(tuple(r) for r in read_zipped_csv(spark, path, layout, schema="k string, i int").collect())
    write_zipped_csv(old, path, layout)
    other = scratch("other")  # an archive that somebody else adds is read too
    write_zipped_csv(spark.createDataFrame([("foreign", 0)], "k string, i int").coalesce(1), other, layout)
    f, root = filesystem(path)
    one = next(n for n in os.listdir(filesystem(other)[1]) if n.endswith(".zip"))
    f.copy_file(f"{filesystem(other)[1]}/{one}", f"{root}/foreign.zip")
    before = rows()
    assert {k for k, _ in before} == {"old", "foreign"} and len(before) == 21
    # the same files, as a task would have staged them, committed by a driver that dies
    side = scratch("side")
    write_zipped_csv(new, side, layout)
    staging = Staging(path, overwrite=True)
    moves = []
    for n, name in enumerate(x for x in os.listdir(filesystem(side)[1]) if x.endswith(".zip")):
        final = f"part-{n:05d}-000-{staging.job}.zip"
        f.create_dir(f"{root}/_temporary/{staging.job}")
        f.copy_file(f"{filesystem(side)[1]}/{name}", f"{root}/_temporary/{staging.job}/{final}")
        moves.append((f"{path}/_temporary/{staging.job}/{final}", f"{path}/{final}"))

    import cellfold.sinks.staged as staged
    real, dies = staged.filesystem, OSError("the driver is lost")

    class Dying:
        def __getattr__(self, name):
            return getattr(f, name)

        def move(self, a, b):
            if step == "before" and "_manifest" in b:
                raise dies
            f.move(a, b)

        def delete_file(self, p):
            raise dies

        delete_dir = delete_file
    staged.filesystem = lambda uri: (Dying(), real(uri)[1])
    try:
        with pytest.raises(OSError, match="lost"):
            staging.commit([StagedFiles(moves)])
    finally:
        staged.filesystem = real
    assert rows() == (before if step == "before" else sorted(("new", i) for i in range(20)))
    write_zipped_csv(old, path, layout, mode="append")  # the next writer goes on from what counts
    assert {k for k, _ in rows()} == ({"old", "foreign"} if step == "before" else {"new", "old"})
    write_zipped_csv(new, path, layout)
    assert rows() == sorted(("new", i) for i in range(20)) and len([x for x in os.listdir(root) if x.startswith("_manifest")]) == 1


def test_inference_unpacks_archives_once(spark, scratch):
    from cellfold.plans.inspect import has_python_or_rdd_scan
    from cellfold.session import Stages
    orders, path = spark.read.parquet(f"{SF_SMALL}/orders.parquet").drop("o_orderdate"), scratch("once")
    layout = {"header": "true", "inferSchema": "true"}
    write_zipped_csv(orders.repartition(3), path, layout)
    with Stages(spark) as stages:
        read = read_zipped_csv(spark, path, layout, stages=stages)
        assert not has_python_or_rdd_scan(read) and len(stages.paths) == 1
        assert same_rows(read.select(*[F.col(c).cast(t) for c, t in orders.dtypes]), orders)
    target = scratch("once-loaded")
    load_key_value(spark, path, target, name="orders", fmt="zip", read_options=layout)
    back, name = restore_table(spark, target)
    assert name == "orders" and back.count() == orders.count()
