"""Zipped-CSV source (S3): every CSV entry of every archive under ``path`` is
one logical table.

Plan: list archives (``binaryFile`` with only ``path`` selected, so contents
are not loaded) -> list entries per archive from its central directory (a
Python task per group of archives) -> spread ``(archive, entry)`` pairs over
tasks -> each task streams its entries in blocks and cuts them into records, a
record being text up to a line break outside quotes -> Spark's CSV parser
(``from_csv``) takes the cells; header, null text, types and the malformed-row
policy are applied JVM-side too (``records.typed_table``).

Cutting works on whole blocks with numpy: line breaks after an even number of
quotes end records. Only blocks where that is not enough (a quote inside an
unquoted cell, comment lines beside quotes) are walked, from one quote or line break to
the next. No archive content passes through the driver and archives larger than
2 GB work, as files are streamed; one entry is the unit of parallelism.
"""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.session import Stages, ship_package
from cellfold.sources.files import current_files, open_input
from cellfold.sources.options import READER_CSV_DEFAULTS, flag, overlay
from cellfold.sources.records import safe_names, typed_table, with_fields

ENTRY_SCHEMA = "path string, entry string, entry_index int, size long"
RECORD_SCHEMA = "path string, entry string, entry_index int, rec long, line string"
_BLOCK = 4 << 20  # bytes cut at a time


def _list_entries(batches: Iterator) -> Iterator:
    import pandas as pd
    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            with open_input(path) as fh, zipfile.ZipFile(fh) as zf:
                for i, info in enumerate(zf.infolist()):
                    if not info.is_dir():
                        rows.append((path, info.filename, i, info.file_size))
        yield pd.DataFrame(rows, columns=["path", "entry", "entry_index", "size"])


def csv_dialect(opts: Mapping[str, str]) -> dict:
    """``csv`` module arguments equivalent to the Spark CSV options."""
    quote = opts.get("quote", '"') or None
    escape = opts.get("escape", "\\") or None
    args = {"delimiter": opts.get("delimiter", opts.get("sep", ",")), "quotechar": quote}
    if quote is None:
        args["quoting"] = csv.QUOTE_NONE
    if escape is not None and escape != quote:
        args.update(escapechar=escape, doublequote=False)
    else:
        args.update(doublequote=True)
    return args


class Cutter:
    """Cuts the bytes of a CSV text into records. ``cut`` takes the next block and
    gives the ends of the records that it completes."""

    def __init__(self, opts: Mapping[str, str]):
        code = lambda key, default="": ord((opts.get(key, default) or "\0")[0]) if opts.get(key, default) else -1
        self.quote, self.escape, self.comment = code("quote", '"'), code("escape", "\\"), code("comment")
        self.delimiter = (opts.get("delimiter") or opts.get("sep") or ",").encode()[-1]
        if self.quote > 127 or self.escape > 127 or self.comment > 127:
            raise ValueError("quote, escape and comment have to be ASCII characters")

    def ends(self, data: np.ndarray, last: bool) -> np.ndarray:
        """Positions after the line breaks that end records in ``data``, which
        starts at a record."""
        breaks = data == 10
        alone = np.flatnonzero(data == 13)
        if len(alone):  # a carriage return without a line feed breaks as well
            alone = alone[alone + 1 < len(data)] if not last else alone
            follows = np.minimum(alone + 1, len(data) - 1)
            breaks[alone[(data[follows] != 10) | (follows == alone)]] = True
        quotes = np.flatnonzero(data == self.quote) if self.quote >= 0 else alone[:0]
        if self.escape >= 0 and self.escape != self.quote and len(quotes):
            quotes = quotes[~self._escaped(data, quotes)]
        at = np.flatnonzero(breaks)
        starts = np.append(0, at + 1)
        starts = starts[starts < len(data)]
        comments = self.comment >= 0 and bool((data[starts] == self.comment).any())
        if not len(quotes):
            return at + 1
        if comments or self._stray(data, quotes):
            return self._walk(data, quotes, at)
        inside = np.searchsorted(quotes, at) & 1
        return at[inside == 0] + 1

    def _escaped(self, data: np.ndarray, quotes: np.ndarray) -> np.ndarray:
        """Which quotes follow an odd number of escape characters."""
        odd, at, more = np.zeros(len(quotes), dtype=bool), quotes - 1, np.ones(len(quotes), dtype=bool)
        while True:
            more &= (at >= 0) & (data[np.maximum(at, 0)] == self.escape)
            if not more.any():
                return odd
            odd ^= more
            at = at - 1

    def _stray(self, data: np.ndarray, quotes: np.ndarray) -> bool:
        """Whether an opening quote stands elsewhere than at the start of a cell."""
        opens = quotes[::2]
        before = data[np.maximum(opens - 1, 0)]
        doubled = np.zeros(len(opens), dtype=bool)
        doubled[1:] = opens[1:] == quotes[1::2][:len(opens) - 1] + 1  # "" inside a cell
        return bool((~((opens == 0) | (before == self.delimiter) | (before == 10) | (before == 13) | doubled)).any())

    def _walk(self, data: np.ndarray, quotes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """The ends of records from one quote or break to the next."""
        events = np.concatenate([quotes, breaks])
        order = np.argsort(events, kind="stable")
        kinds = (order >= len(quotes)).tolist()
        out, start, inside, closed = [], 0, False, -2
        for at, is_break in zip(events[order].tolist(), kinds):
            comment = not inside and start < len(data) and data[start] == self.comment
            if is_break:
                if not inside or comment:
                    out.append(at + 1)
                    start, inside = at + 1, False
            elif comment:
                continue
            elif inside:
                inside, closed = False, at
            # a quote opens a cell at its start, and goes on with one that it doubles
            elif at == start or data[at - 1] == self.delimiter or closed == at - 1:
                inside = True
        return np.array(out, dtype=np.int64)

    def blocks(self, raw, charset: str):
        """(bytes, ends of records) over a binary stream; the last record may have
        no line break. Text of another charset is recoded."""
        utf8 = charset.replace("-", "").upper() in ("UTF8", "USASCII", "ASCII")
        source = raw if utf8 else io.TextIOWrapper(raw, encoding=charset, newline="")
        rest = b""
        while True:
            block = source.read(max(_BLOCK, len(rest)))
            block = block if utf8 else block.encode()
            data = rest + block
            if not data:
                return
            view = np.frombuffer(data, dtype=np.uint8)
            ends = self.ends(view, last=not block)
            if not block:
                if not len(ends) or ends[-1] < len(data):
                    ends = np.append(ends, len(data))
                yield data, ends
                return
            if len(ends):
                rest = data[ends[-1]:]
                yield data[:ends[-1]], ends
            else:
                rest = data


def _entry_reader(opts: Mapping[str, str], limit: int | None = None):
    cutter = Cutter(opts)
    charset = opts.get("charset", opts.get("encoding", "UTF-8"))

    def read(batches: Iterator) -> Iterator:
        rows = (row for batch in batches for row in batch.to_pylist())
        # an archive stays open, its directory read once, for its entries that come in a row
        for path, entries in groupby(rows, key=lambda row: row["path"]):
            with open_input(path) as fh, zipfile.ZipFile(fh) as zf:
                for row in entries:
                    yield from records(row, zf)

    def records(row: dict, zf: zipfile.ZipFile) -> Iterator:
        done = 0
        with zf.open(row["entry"]) as raw:
            for data, ends in cutter.blocks(raw, charset):
                if limit is not None and done >= limit:
                    break
                n = len(ends)
                offsets = np.zeros(n + 1, dtype=np.int64)
                offsets[1:] = ends
                lines = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data))
                if done == 0 and data.startswith(codecs.BOM_UTF8):
                    lines = pc.replace_substring(lines, "\ufeff", "", max_replacements=1)
                if cutter.comment >= 0:
                    lines = lines.filter(pc.invert(pc.starts_with(lines, chr(cutter.comment))))
                lines = pc.replace_substring_regex(lines, r"\r?\n\z|\r\z", "")
                n = len(lines)
                same = lambda v, t: pa.repeat(pa.scalar(v, t), n)
                yield pa.RecordBatch.from_arrays(
                    [same(row["path"], pa.string()), same(row["entry"], pa.string()),
                     same(row["entry_index"], pa.int32()), pa.array(np.arange(done, done + n)), lines.cast(pa.string())],
                    names=["path", "entry", "entry_index", "rec", "line"])
                done += n
    return read


def zip_entries(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, entry, entry_index, size)`` of every file entry of every archive."""
    ship_package(spark)
    paths = current_files([path] if isinstance(path, str) else list(path))
    archives = (spark.read.format("binaryFile").load(paths).select("path") if paths
                else spark.createDataFrame([], "path string"))
    return archives.mapInPandas(_list_entries, ENTRY_SCHEMA)


def zip_records(spark: SparkSession, path: str | Sequence[str],
                options: Mapping[str, object] | None = None,
                n_tasks: int | None = None) -> DataFrame:
    """Raw records ``(path, entry, entry_index, rec, line)`` of all entries.

    Entries are hash-spread over ``n_tasks`` tasks (default: the shuffle
    partition count); the number is explicit so that adaptive execution does
    not fold the tiny listing into one task. Each task takes its entries archive by
    archive, so it reads the directory of an archive once.
    """
    opts = overlay(READER_CSV_DEFAULTS, options)
    n = n_tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = zip_entries(spark, path).repartition(n, "path", "entry").sortWithinPartitions("path", "entry_index")
    return entries.mapInArrow(_entry_reader(opts), RECORD_SCHEMA)


def _first_record(spark, path, opts) -> list[str] | None:
    """First record of the first entry (in archive, entry order) that has one.

    Tries the first non-empty entry alone; only if that holds no record (e.g.
    only comment lines) reads the first record of every entry and keeps the
    earliest, a distributed top-1.
    """
    entries = zip_entries(spark, path)
    read_one = _entry_reader(opts, limit=1)
    first = (entries.where(F.col("size") > 0).orderBy("path", "entry_index").limit(1)
             .mapInArrow(read_one, RECORD_SCHEMA).where("rec = 0").select("line").collect())
    if not first:
        first = (entries.mapInArrow(read_one, RECORD_SCHEMA).where("rec = 0")
                 .orderBy("path", "entry_index").limit(1).select("line").collect())
    if not first:
        return None
    csv.field_size_limit(2**31 - 1)
    return next(csv.reader([first[0]["line"]], **csv_dialect(opts)), [])


def read_zipped_csv(spark: SparkSession, path: str | Sequence[str],
                    options: Mapping[str, object] | None = None,
                    schema: T.StructType | str | None = None,
                    n_tasks: int | None = None, stages: Stages | None = None) -> DataFrame:
    """Read all CSV entries of the archives under ``path`` as one table (S3).

    Options as for CSV (reference defaults: no header, ``,``, ``"``, ``\\``,
    ``DROPMALFORMED``, comment ``#``, null text empty); ``dateFormat`` and
    ``timestampFormat`` are obeyed. Column names come from
    the first entry's header (``header=true``) or are ``_c0…``; every entry is
    parsed to one schema: the given one, one inferred over all entries in a
    single pass (``inferSchema=true``), or all strings. Inference reads all
    records first: with ``stages`` they are unpacked once, into a stage that its owner
    frees after the last use of the result; without, once more for the result.
    """
    opts = overlay(READER_CSV_DEFAULTS, options)
    st = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = flag(opts, "header")
    records = zip_records(spark, path, opts, n_tasks)
    if header:
        records = records.where(F.col("rec") > 0)
    if st is not None:
        names = st.names
    else:
        first = _first_record(spark, path, opts)
        if first is None:
            return spark.createDataFrame([], T.StructType([]))
        sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
        names = safe_names(first, sensitive) if header else [f"_c{i}" for i in range(len(first))]
        if stages is not None and flag(opts, "inferSchema"):
            records = stages.save(records, "zip-records")
    return typed_table(with_fields(records, len(names), opts), names, opts, st)
