"""Reader and writer option sets (S4, K4) and save modes (K3).

Options are plain dicts: defaults, then any number of overlays, later ones
winning. A flat configuration map can be cut down to one prefix
(``reader.csv.header`` -> ``header``).
"""

from __future__ import annotations

from collections.abc import Mapping

# Defaults of the reference's reader and writer configuration.
READER_CSV_DEFAULTS = {
    "header": "false",
    "delimiter": ",",
    "quote": '"',
    "escape": "\\",
    "mode": "DROPMALFORMED",
    "charset": "UTF-8",
    "inferSchema": "false",
    "comment": "#",
    "nullValue": "",
    "dateFormat": "yyyy-MM-dd",
}
READER_EXCEL_DEFAULTS = {
    "dataAddress": "A1",
    "header": "false",
    "treatEmptyValuesAsNulls": "true",
    "inferSchema": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.fffffffff]",
}
WRITER_CSV_DEFAULTS = {
    "header": "false",
    "delimiter": ",",
    "quote": '"',
    "escape": "\\",
    "charset": "UTF-8",
    "nullValue": "",
    "dateFormat": "yyyy-MM-dd",
}
WRITER_EXCEL_DEFAULTS = {
    "dataAddress": "A1",
    "header": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.fffffffff]",
}
# End of fixed values.

# Our option set for key-value files: every text survives a write and a read
# (newline, CR, quotes, backslash, edge spaces, empty string vs null).
KEY_VALUE_CSV = {
    "header": "false",
    "delimiter": ",",
    "quote": '"',
    "escape": "\\",
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "charset": "UTF-8",
    "lineSep": "\n",  # an explicit separator keeps CRLF inside quoted values on read
}
KEY_VALUE_CSV_READ = {**KEY_VALUE_CSV, "mode": "FAILFAST"}
# the same for files with line breaks inside cells, which cannot be split
WHOLE_CSV_READ = {**KEY_VALUE_CSV_READ, "multiLine": "true"}

SAVE_MODES = ("append", "overwrite", "errorifexists", "ignore")


# option names that mean the same, so that a later layer replaces an earlier one
_SAME = {"sep": "delimiter", "encoding": "charset"}


def overlay(*layers: Mapping[str, object] | None) -> dict[str, str]:
    """Merge option layers left to right; later keys win; values as text."""
    out: dict[str, str] = {}
    for layer in layers:
        for k, v in (layer or {}).items():
            k = _SAME.get(k.lower(), k)
            if v is None:
                out.pop(k, None)
            elif isinstance(v, bool):
                out[k] = "true" if v else "false"
            else:
                out[k] = str(v)
    return out


_KNOWN_KEYS = sorted({k for d in (READER_CSV_DEFAULTS, READER_EXCEL_DEFAULTS, WRITER_CSV_DEFAULTS,
                                   WRITER_EXCEL_DEFAULTS, WHOLE_CSV_READ) for k in d}
                     | {"path", "sep", "encoding", "sheetName", "maxRowsPerFile",
                        "maxRecordsPerFile", "quoteAll", "headerLine"})


def canonical(options: Mapping[str, object] | None) -> dict[str, str]:
    """Options with their usual camel-case keys (data source writers receive
    them lower-cased)."""
    names = {k.lower(): k for k in _KNOWN_KEYS}
    return overlay({names.get(k.lower(), k): v for k, v in (options or {}).items()})


def options_for(config: Mapping[str, object], prefix: str) -> dict[str, str]:
    """Keys under ``prefix.`` with the prefix stripped (``reader.csv`` ...)."""
    head = prefix.rstrip(".") + "."
    return overlay({k[len(head):]: v for k, v in config.items() if k.startswith(head)})


def parse_save_mode(text: str | None) -> str:
    """Save mode from text: trimmed, case-blind; missing -> overwrite.

    Unknown text raises rather than silently overwriting.
    """
    if text is None:
        return "overwrite"
    mode = text.strip().lower()
    if mode == "error":
        mode = "errorifexists"
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {text!r}; expected one of {SAVE_MODES}")
    return mode


def flag(options: Mapping[str, str], key: str, default: bool = False) -> bool:
    v = options.get(key)
    return default if v is None else str(v).strip().lower() == "true"
