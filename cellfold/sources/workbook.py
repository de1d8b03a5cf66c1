"""Workbook source (S2): bulk ingest of ``.xlsx`` files, one workbook per task.

Read with the standard library only (``zipfile`` + ``xml.etree`` streaming
parse): shared strings, inline strings, numbers, booleans, formulas (their
cached value) and dates (numbers whose cell style is a date format). Cells are
rendered as text per sheet row; names, null text, types and the malformed
policy are then applied JVM-side (``records.typed_table``) exactly as for the
zipped-CSV source.

Options (reference defaults): ``dataAddress`` (``A1``, ``B3``, ``'Sheet'!B3``,
``B3:F100``), ``header``, ``treatEmptyValuesAsNulls``, ``inferSchema``,
``dateFormat`` / ``timestampFormat`` (text form of date cells).
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.session import ship_package
from cellfold.sources.files import current_files, open_input
from cellfold.sources.options import READER_EXCEL_DEFAULTS, flag, overlay
from cellfold.sources.records import safe_names, typed_table

RECORD_SCHEMA = "path string, sheet string, rec long, fields array<string>"
_BATCH = 4096
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that show dates or times (ECMA-376).
_DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_TIME_FORMAT_IDS = {18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = datetime(1899, 12, 30)
_ADDRESS = re.compile(r"^(?:'?(?P<sheet>[^'!]+)'?!)?(?P<c1>[A-Z]+)(?P<r1>\d+)"
                      r"(?::(?P<c2>[A-Z]+)(?P<r2>\d+))?$")


def column_index(letters: str) -> int:
    """``A`` -> 0, ``Z`` -> 25, ``AA`` -> 26."""
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def column_letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rem = divmod(index - 1, 26)
        out = chr(65 + rem) + out
    return out


def parse_address(text: str) -> tuple[str | None, int, int, int | None, int | None]:
    """``(sheet, first col, first row, last col, last row)``, 0-based."""
    m = _ADDRESS.match(text.strip())
    if not m:
        raise ValueError(f"bad dataAddress {text!r}")
    c2 = column_index(m["c2"]) if m["c2"] else None
    r2 = int(m["r2"]) - 1 if m["r2"] else None
    return m["sheet"], column_index(m["c1"]), int(m["r1"]) - 1, c2, r2


_ESCAPED = re.compile(r"_x([0-9A-F]{4})_")


def _unescape(text: str) -> str:
    """Characters XML cannot hold are stored as ``_xHHHH_``."""
    return _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), text) if "_x" in text else text


def _bare(code: str) -> str:
    return re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code).lower()


def _is_date_code(code: str) -> bool:
    bare = _bare(code)
    return bool(re.search(r"[dmyhs]", bare)) and "general" not in bare


def _has_time(code: str) -> bool:
    return bool(re.search(r"[hs]", _bare(code)))


class _Book:
    """Index of one workbook: sheets, shared strings, date styles."""

    def __init__(self, zf: zipfile.ZipFile):
        self.zf = zf
        names = set(zf.namelist())
        wb = ET.fromstring(zf.read("xl/workbook.xml"))
        rels = {}
        if "xl/_rels/workbook.xml.rels" in names:
            for r in ET.fromstring(zf.read("xl/_rels/workbook.xml.rels")):
                target = r.get("Target", "")
                target = target.lstrip("/") if target.startswith("/") else "xl/" + target
                rels[r.get("Id")] = target
        for pr in wb.iter(f"{_NS}workbookPr"):
            if pr.get("date1904") in ("1", "true"):
                raise ValueError("workbooks with the 1904 date system are not supported")
        self.sheets = []
        for s in wb.iter(f"{_NS}sheet"):
            rid = s.get(f"{_REL_NS}id")
            self.sheets.append((s.get("name"), rels.get(rid, f"xl/worksheets/sheet{len(self.sheets) + 1}.xml")))
        self.strings = []
        if "xl/sharedStrings.xml" in names:
            for _, el in ET.iterparse(zf.open("xl/sharedStrings.xml")):
                if el.tag == f"{_NS}si":
                    self.strings.append(_unescape(
                        "".join(t.text or "" for t in el.iter(f"{_NS}t"))))
                    el.clear()
        self.date_styles: dict[int, bool] = {}  # style -> shows a time
        if "xl/styles.xml" in names:
            st = ET.fromstring(zf.read("xl/styles.xml"))
            custom = {}
            fmts = st.find(f"{_NS}numFmts")
            if fmts is not None:
                for f in fmts:
                    custom[int(f.get("numFmtId"))] = f.get("formatCode", "")
            xfs = st.find(f"{_NS}cellXfs")
            if xfs is not None:
                for i, xf in enumerate(xfs):
                    fid = int(xf.get("numFmtId", "0"))
                    if fid in _DATE_FORMAT_IDS:
                        self.date_styles[i] = fid in _TIME_FORMAT_IDS
                    elif fid in custom and _is_date_code(custom[fid]):
                        self.date_styles[i] = _has_time(custom[fid])

    def sheet_path(self, name: str | None) -> tuple[str, str]:
        if not self.sheets:
            raise ValueError("workbook has no sheet")
        if name is None:
            return self.sheets[0]
        for s in self.sheets:
            if s[0] == name:
                return s
        raise ValueError(f"no sheet named {name!r}")


def _date_text(serial: float, date_fmt_has_time: bool) -> str:
    # serials are float days: round to the microsecond so 12:00 never reads 11:59:59.999999
    moment = _EPOCH + timedelta(microseconds=round(serial * 86_400_000_000))
    if moment.hour == moment.minute == moment.second == moment.microsecond == 0 \
            and not date_fmt_has_time:
        return moment.strftime("%Y-%m-%d")
    text = moment.strftime("%Y-%m-%d %H:%M:%S")
    if moment.microsecond:
        text += f".{moment.microsecond:06d}".rstrip("0")
    return text


def _number_text(v: str) -> str:
    v = v.strip()
    if re.fullmatch(r"-?\d+", v) or len(re.sub(r"[eE].*|\D", "", v).strip("0")) > 17:
        return v  # whole numbers and more digits than a double holds: as stored
    x = float(v)
    if x.is_integer() and abs(x) < 2 ** 53:
        return str(int(x))
    return repr(x)


def _cell_text(c: ET.Element, book: _Book) -> str | None:
    t = c.get("t", "n")
    if t == "inlineStr":
        node = c.find(f"{_NS}is")
        return None if node is None else _unescape(
            "".join(x.text or "" for x in node.iter(f"{_NS}t")))
    v = c.find(f"{_NS}v")
    if v is None or v.text is None:
        return None
    if t == "s":
        return book.strings[int(v.text)]
    if t == "b":
        return "true" if v.text.strip() == "1" else "false"
    if t in ("str", "e"):
        return v.text
    style = int(c.get("s", "0"))
    if style in book.date_styles:
        return _date_text(float(v.text), book.date_styles[style])
    return _number_text(v.text)


def _sheet_rows(book: _Book, part: str, c1: int, r1: int, c2: int | None,
                r2: int | None, empty_as_null: bool) -> Iterator[list[str | None]]:
    """Rows of the addressed range in order; rows missing in the file are
    skipped, missing cells inside a row are null."""
    for _, el in ET.iterparse(book.zf.open(part)):
        if el.tag != f"{_NS}row":
            continue
        r = int(el.get("r")) - 1 if el.get("r") else None
        if r is not None and (r < r1 or (r2 is not None and r > r2)):
            el.clear()
            continue
        cells: dict[int, str | None] = {}
        pos = 0
        for c in el.findall(f"{_NS}c"):
            ref = c.get("r")
            col = column_index(re.match(r"[A-Z]+", ref).group()) if ref else pos
            pos = col + 1
            if col < c1 or (c2 is not None and col > c2):
                continue
            text = _cell_text(c, book)
            if empty_as_null and text == "":
                text = None
            cells[col - c1] = text
        el.clear()
        width = (c2 - c1 + 1) if c2 is not None else (max(cells) + 1 if cells else 0)
        yield [cells.get(i) for i in range(width)]


def _workbook_reader(opts: Mapping[str, str], limit: int | None = None):
    sheet_name, c1, r1, c2, r2 = parse_address(opts.get("dataAddress", "A1"))
    empty_as_null = flag(opts, "treatEmptyValuesAsNulls", True)

    def read(batches: Iterator) -> Iterator:
        import pandas as pd
        cols = ["path", "sheet", "rec", "fields"]
        for pdf in batches:
            for path in pdf["path"]:
                with open_input(path) as fh, zipfile.ZipFile(fh) as zf:
                    book = _Book(zf)
                    name, part = book.sheet_path(sheet_name)
                    buf = []
                    for rec, fields in enumerate(_sheet_rows(book, part, c1, r1, c2, r2,
                                                             empty_as_null)):
                        if limit is not None and rec >= limit:
                            break
                        buf.append((path, name, rec, fields))
                        if len(buf) >= _BATCH:
                            yield pd.DataFrame(buf, columns=cols)
                            buf = []
                    if buf:
                        yield pd.DataFrame(buf, columns=cols)
    return read


def _books(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` of every workbook, whatever the case of its suffix."""
    paths = current_files(paths)
    if not paths:
        return spark.createDataFrame([], "path string")
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.[xX][lL][sS][xXmM]").load(paths))
    return files.select("path")


def workbook_records(spark: SparkSession, path: str | Sequence[str],
                     options: Mapping[str, object] | None = None,
                     n_tasks: int | None = None) -> DataFrame:
    """Raw rows ``(path, sheet, rec, fields)`` of the addressed sheet of every
    workbook; workbooks are hash-spread over ``n_tasks`` tasks."""
    ship_package(spark)
    opts = overlay(READER_EXCEL_DEFAULTS, options)
    paths = [path] if isinstance(path, str) else list(path)
    n = n_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    books = _books(spark, paths).repartition(n, "path")
    return books.mapInPandas(_workbook_reader(opts), RECORD_SCHEMA)


def read_workbooks(spark: SparkSession, path: str | Sequence[str],
                   options: Mapping[str, object] | None = None,
                   schema: T.StructType | str | None = None,
                   n_tasks: int | None = None) -> DataFrame:
    """Read the addressed sheet of every workbook under ``path`` as one table.

    Column names come from the first row of the first workbook (``header``)
    or are ``_c0…``; all workbooks are parsed to one schema (given, inferred
    in one pass with ``inferSchema``, or all strings).
    """
    opts = overlay(READER_EXCEL_DEFAULTS, options)
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = flag(opts, "header")
    records = workbook_records(spark, path, opts, n_tasks)
    if header:
        records = records.where(F.col("rec") > 0)
    if st is not None:
        names = st.names
    else:
        paths = [path] if isinstance(path, str) else list(path)
        first = (_books(spark, paths).orderBy("path").limit(1)
                 .mapInPandas(_workbook_reader(opts, limit=1), RECORD_SCHEMA)
                 .select("fields").collect())
        if not first:
            return spark.createDataFrame([], T.StructType([]))
        row = first[0]["fields"]
        sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
        names = safe_names(row, sensitive) if header else [f"_c{i}" for i in range(len(row))]
    # workbooks have no text for null: only real empty cells are null; date cells
    # come as ISO text, whatever format they are shown in
    plain = {"nullValue": None, "dateFormat": None, "timestampFormat": None}
    return typed_table(records, names, overlay(opts, plain), st)
