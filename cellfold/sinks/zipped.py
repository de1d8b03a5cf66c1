"""Zipped-CSV sink: one archive per task, holding one CSV entry.

Records are made by Spark (``to_csv``); a Python data source writer
(``DataSourceArrowWriter``) packs them: each task streams its Arrow batches into ``_temporary/<attempt>.zip``; the driver's ``commit``
moves the archives of successful tasks into place, ``abort`` removes them, so
retried or lost tasks leave no partial or duplicate archive behind. This is
the counterpart of the zipped-CSV source, used to produce its archives.
"""

from __future__ import annotations

import codecs
import zipfile
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from cellfold.functions.text import to_text
from cellfold.sinks.staged import StagedFiles, Staging
from cellfold.sources.files import exists, open_output
from cellfold.sources.options import WRITER_CSV_DEFAULTS, canonical, flag, overlay, parse_save_mode

FORMAT = "cellfold_zipcsv"


class ZippedCsvWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str], schema, overwrite: bool):
        self.options = overlay(WRITER_CSV_DEFAULTS, canonical(options))
        self.staging = Staging(self.options["path"], overwrite)

    def write(self, iterator: Iterator) -> StagedFiles:
        temp, final = self.staging.task_names(".zip")
        stem = final.rsplit("/", 1)[-1][:-len(".zip")]
        limit = int(self.options.get("maxRecordsPerFile", 0)) or None
        rows, number, held, text = 0, 0, 0, None
        sink = open_output(temp)
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as zf:
            def opened():
                raw = zf.open(f"{stem}-{number:03d}.csv", "w", force_zip64=True)
                # a stream writer sets the byte order mark that UTF-16 needs
                out = codecs.getwriter(self.options.get("charset", "UTF-8"))(raw)
                if flag(self.options, "header"):
                    out.write(self.options["headerLine"] + "\n")
                return out
            for batch in iterator:
                lines = batch.column(0)
                while len(lines):
                    if text is None or (limit and held >= limit):
                        if text is not None:
                            text.stream.close()
                            number, held = number + 1, 0
                        text = opened()
                    part = lines.slice(0, limit - held if limit else len(lines))
                    text.write("\n".join(part.to_pylist()) + "\n")
                    rows, held, lines = rows + len(part), held + len(part), lines.slice(len(part))
            if text is None:  # no rows: an entry with the header alone, or empty
                text = opened()
            text.stream.close()
        sink.close()
        return StagedFiles([(temp, final)], rows)

    def commit(self, messages) -> None:
        self.staging.commit(messages)

    def abort(self, messages) -> None:
        self.staging.abort(messages)


class ZippedCsvDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> ZippedCsvWriter:
        return ZippedCsvWriter(self.options, schema, overwrite)


def register(spark) -> None:
    from cellfold.session import ship_package
    ship_package(spark)
    spark.dataSource.register(ZippedCsvDataSource)


def write_zipped_csv(df: DataFrame, path: str, options: Mapping[str, object] | None = None,
                     mode: str | None = "overwrite",
                     max_records_per_file: int | None = None) -> None:
    """Write ``df`` as zipped CSV: one archive per partition, with a new entry
    (the unit that one task reads back) every ``max_records_per_file`` records.
    Cells are turned to text in Spark (``to_text``), so binary and nested values
    are written in the form that restore reads."""
    mode = parse_save_mode(mode)
    if mode in ("errorifexists", "ignore") and exists(path):
        if mode == "ignore":
            return
        raise FileExistsError(path)
    register(df.sparkSession)
    save_mode = "overwrite" if mode == "overwrite" else "append"
    slots = [f"__c{i}" for i in range(len(df.columns))]  # by position: names may repeat
    texts = df.toDF(*slots).select(*[to_text(F.col(c), f.dataType).alias(f.name)
                                     for c, f in zip(slots, df.schema.fields)])
    opts = overlay(WRITER_CSV_DEFAULTS, options, {"maxRecordsPerFile": max_records_per_file} if max_records_per_file else None)
    csv_options = {"sep": opts.get("delimiter", ","), "quote": opts.get("quote") or "\0", "escape": opts.get("escape") or "\0",
                   "nullValue": opts.get("nullValue", ""), "emptyValue": '""', "lineSep": "\n",
                   "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    # records are made by Spark's CSV writer; tasks pack them
    lines = texts.toDF(*slots).select(F.to_csv(F.struct(*slots), csv_options).alias("line"))
    opts["headerLine"] = _header(df, csv_options)
    lines.write.format(FORMAT).mode(save_mode).options(**opts).save(path)


def _header(df: DataFrame, csv_options: Mapping[str, str]) -> str:
    names = df.sparkSession.range(1).select(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("s"))
    return names.select(F.to_csv("s", csv_options)).first()[0] if df.columns else ""
