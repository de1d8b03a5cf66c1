"""File access from inside tasks (any file system pyarrow knows: local, HDFS,
object stores), for sources and sinks that unpack archives or workbooks."""

from __future__ import annotations

import json
import re
from urllib.parse import quote, urlparse


# Hadoop scheme names and the pyarrow file system that serves them
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "abfss": "abfs"}


def _normalise(uri: str) -> str:
    if uri.startswith("file:") and not uri.startswith("file://"):
        return "file://" + uri[len("file:"):]
    if "://" not in uri:
        return "file://" + uri
    head, rest = uri.split("://", 1)
    return f"{_SCHEMES.get(head.lower(), head)}://{rest}"


def filesystem(uri: str):
    """``(pyarrow FileSystem, path inside it)`` for a URI or local path."""
    from pyarrow import fs
    uri = _normalise(uri)
    if uri.startswith("file://"):
        return fs.LocalFileSystem(), "/" + uri[len("file://"):].lstrip("/")
    # paths come as plain text: what a URI reserves (spaces, percent signs) is quoted
    return fs.FileSystem.from_uri(quote(uri, safe="/:@?&=+$,;~!*'()[]"))


def open_input(uri: str):
    """A seekable binary file for reading (archives need random access)."""
    f, p = filesystem(uri)
    return f.open_input_file(p)


class _Sink:
    """Write-only, non-seekable wrapper: ``zipfile`` then streams entries with
    data descriptors instead of seeking back."""

    def __init__(self, stream):
        self._s = stream
        self._n = 0

    def write(self, b):
        self._s.write(b)
        self._n += len(b)
        return len(b)

    def tell(self):
        return self._n

    def flush(self):
        self._s.flush()

    def seekable(self):
        return False

    def close(self):
        self._s.close()


def open_output(uri: str):
    """A streaming binary writer (parent folders are made)."""
    f, p = filesystem(uri)
    parent = p.rsplit("/", 1)[0]
    if parent:
        f.create_dir(parent, recursive=True)
    return _Sink(f.open_output_stream(p))


def exists(uri: str) -> bool:
    from pyarrow import fs
    f, p = filesystem(uri)
    return f.get_file_info(p).type != fs.FileType.NotFound


def scheme(uri: str) -> str:
    return urlparse(_normalise(uri)).scheme


MANIFEST = "_manifest-"  # and a number; the highest counts
COMMITTED = re.compile(r"part-\d{5}-\d{3}-[0-9a-f]{32}\.")  # names that commits give


def read_manifest(f, infos) -> tuple[int, list[str], list[str]]:
    """(number, files of the commits, files to be ignored) of a folder's listing.
    Without a manifest all files with names of commits count."""
    found = max((i for i in infos if i.base_name.startswith(MANIFEST)), key=lambda i: i.base_name, default=None)
    if found is None:
        return 0, [i.base_name for i in infos if COMMITTED.match(i.base_name)], []
    with f.open_input_file(found.path) as fh:
        held = json.loads(fh.read())
    return int(found.base_name[len(MANIFEST):]), held["files"], held["gone"]


def current_files(paths: list[str]) -> list[str]:
    """The given paths, with folders that hold a manifest replaced by the files
    that count in them: those of its commits and those that others put there."""
    from pyarrow import fs
    out = []
    for path in paths:
        try:
            f, root = filesystem(path)
            infos = f.get_file_info(fs.FileSelector(root))
        except (OSError, ValueError):  # a file, a pattern, a store that only Spark reads
            infos = []
        if not any(i.base_name.startswith(MANIFEST) for i in infos):
            out.append(path)
            continue
        _, files, gone = read_manifest(f, infos)
        wanted = {*files, *(i.base_name for i in infos if i.type == fs.FileType.File and not COMMITTED.match(i.base_name)
                            and not i.base_name.startswith(("_", ".")) and i.base_name not in gone)}
        out += [f"{path.rstrip('/')}/{i.base_name}" for i in infos if i.base_name in wanted]
    return out
