"""Workbook sink (K2): sharded ``.xlsx`` export, written by the tasks.

Each task streams its rows into workbooks of at most one sheet's row limit
(1,048,576 rows, header included), so a partition of any size becomes one or
more files; files are staged and committed by the driver (``Staging``).
Strings are written inline (no shared-strings table to hold in memory),
numbers and booleans natively, dates and timestamps as serial numbers with a
date style, other types as text.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Mapping
from datetime import date, datetime
from decimal import Decimal
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from cellfold.sinks.staged import StagedFiles, Staging
from cellfold.sources.files import exists, open_output
from cellfold.sources.options import WRITER_EXCEL_DEFAULTS, canonical, flag, overlay, parse_save_mode
from cellfold.sources.workbook import column_letters, parse_address

FORMAT = "cellfold_xlsx"
# The sheet row limit of the format.
SHEET_ROW_LIMIT = 1_048_576

_BAD_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
_EPOCH_ORDINAL = datetime(1899, 12, 30).toordinal()

_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
    '</Types>')
_ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
    '</Relationships>')
_BOOK_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
    '</Relationships>')
# style 0 general, 1 date, 2 date and time
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm:ss"/></numFmts>'
    '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/>'
    '<xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>')


def _book_xml(sheet: str) -> str:
    return ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            f'<sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')


def _serial(v) -> float:
    if isinstance(v, datetime):
        day = v.toordinal() - _EPOCH_ORDINAL
        secs = v.hour * 3600 + v.minute * 60 + v.second + v.microsecond / 1e6
        return day + secs / 86400.0
    return float(v.toordinal() - _EPOCH_ORDINAL)


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float, Decimal)):
        return f'<c r="{ref}"><v>{v}</v></c>'
    if isinstance(v, datetime):
        return f'<c r="{ref}" s="2"><v>{_serial(v)!r}</v></c>'
    if isinstance(v, date):
        return f'<c r="{ref}" s="1"><v>{_serial(v)!r}</v></c>'
    text = v.hex() if isinstance(v, (bytes, bytearray)) else str(v)
    text = _BAD_XML.sub(lambda m: f"_x{ord(m.group()):04X}_", text)
    return (f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}'
            f'</t></is></c>')


class WorkbookWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str], schema, overwrite: bool):
        self.options = overlay(WRITER_EXCEL_DEFAULTS, canonical(options))
        self.staging = Staging(self.options["path"], overwrite)
        self.names = [f.name for f in schema.fields]
        sheet, self.c0, self.r0, _, _ = parse_address(self.options.get("dataAddress", "A1"))
        self.sheet = sheet or self.options.get("sheetName", "Sheet1")
        self.header = flag(self.options, "header")
        self.limit = int(self.options.get("maxRowsPerFile", SHEET_ROW_LIMIT))

    def _open(self, seq: int):
        temp, final = self.staging.task_names(".xlsx", seq)
        sink = open_output(temp)
        zf = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
        zf.writestr("[Content_Types].xml", _CONTENT_TYPES)
        zf.writestr("_rels/.rels", _ROOT_RELS)
        zf.writestr("xl/workbook.xml", _book_xml(self.sheet))
        zf.writestr("xl/_rels/workbook.xml.rels", _BOOK_RELS)
        zf.writestr("xl/styles.xml", _STYLES)
        part = zf.open("xl/worksheets/sheet1.xml", "w")
        part.write(b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                   b'<sheetData>')
        return (temp, final), sink, zf, part

    @staticmethod
    def _close(sink, zf, part):
        part.write(b"</sheetData></worksheet>")
        part.close()
        zf.close()
        sink.close()

    def _row(self, r: int, values) -> bytes:
        cells = "".join(_cell(f"{column_letters(self.c0 + i)}{r + 1}", v)
                        for i, v in enumerate(values))
        return f'<row r="{r + 1}">{cells}</row>'.encode("utf-8")

    def write(self, iterator: Iterator) -> StagedFiles:
        moves, total = [], 0
        seq, opened, row = 0, None, 0
        capacity = self.limit - self.r0 - (1 if self.header else 0)
        if capacity <= 0:
            raise ValueError("dataAddress leaves no room for rows")

        def start():
            nonlocal opened, row, seq
            names, sink, zf, part = self._open(seq)
            moves.append(names)
            seq += 1
            row = self.r0
            if self.header:
                part.write(self._row(row, self.names))
                row += 1
            opened = (sink, zf, part)

        start()
        in_file = 0
        for batch in iterator:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for values in zip(*cols):
                if in_file == capacity:
                    self._close(*opened)
                    start()
                    in_file = 0
                opened[2].write(self._row(row, values))
                row += 1
                in_file += 1
                total += 1
        self._close(*opened)
        return StagedFiles(moves, total)

    def commit(self, messages) -> None:
        self.staging.commit(messages)

    def abort(self, messages) -> None:
        self.staging.abort(messages)


class WorkbookDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(self.options, schema, overwrite)


def register(spark) -> None:
    from cellfold.session import ship_package
    ship_package(spark)
    spark.dataSource.register(WorkbookDataSource)


def write_workbooks(df: DataFrame, path: str, options: Mapping[str, object] | None = None,
                    mode: str | None = "overwrite") -> None:
    """Write ``df`` as workbooks: per partition one or more row-bounded files."""
    mode = parse_save_mode(mode)
    if mode in ("errorifexists", "ignore") and exists(path):
        if mode == "ignore":
            return
        raise FileExistsError(path)
    register(df.sparkSession)
    save_mode = "overwrite" if mode == "overwrite" else "append"
    df.write.format(FORMAT).mode(save_mode).options(**overlay(options)).save(path)
