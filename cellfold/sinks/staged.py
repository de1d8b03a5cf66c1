"""Staged files for Python data source writers: tasks write under
``<path>/_temporary/<job>/``; the driver moves the files of successful tasks
into place on commit and drops the staging folder on abort, so a retried or
lost task leaves no partial or duplicate file behind.

What counts is the manifest, ``_manifest-<number>``, of the highest number: it
names the files of the commits so far, and the files of others that an overwrite is about to
delete. The readers (``sources.files.current_files``) obey it. Moving it into place is the one
step that publishes a write: a job that dies before it leaves the old
table, one that dies after it the new one, never parts of both. Files that others
put into the folder are read as well. Two writers of one folder at a time are not supported.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql.datasource import WriterCommitMessage

from cellfold.sources.files import COMMITTED, MANIFEST, filesystem, read_manifest


_RENAMES = 16  # renames in flight at commit


@dataclass
class StagedFiles(WriterCommitMessage):
    moves: list = field(default_factory=list)  # (temp uri, final uri)
    rows: int = 0


class Staging:
    def __init__(self, path: str, overwrite: bool):
        self.path = path.rstrip("/")
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def task_names(self, suffix: str, seq: int = 0) -> tuple[str, str]:
        """(temp, final) URIs for the ``seq``-th file of the running task."""
        from pyspark import TaskContext
        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        attempt = ctx.taskAttemptId() if ctx else 0
        name = f"part-{part:05d}-{seq:03d}-{self.job}{suffix}"
        return (f"{self.path}/_temporary/{self.job}/{attempt}-{name}",
                f"{self.path}/{name}")

    def commit(self, messages) -> None:
        """Move the new files into place, publish them in a manifest, then
        delete what an overwrite replaces."""
        from pyarrow import fs
        f, root = filesystem(self.path)
        f.create_dir(root, recursive=True)
        infos = [i for i in f.get_file_info(fs.FileSelector(root)) if i.base_name != "_temporary"]
        number, files, gone = read_manifest(f, infos)
        moves = [move for m in messages if m is not None for move in m.moves]

        def publish(move: tuple[str, str]) -> None:
            f.move(filesystem(move[0])[1], filesystem(move[1])[1])

        def drop(info: fs.FileInfo) -> None:
            (f.delete_dir if info.type == fs.FileType.Directory else f.delete_file)(info.path)

        with ThreadPoolExecutor(_RENAMES) as pool:  # list() raises what a call raised
            list(pool.map(publish, moves))
            new = [final.rsplit("/", 1)[-1] for _, final in moves]
            if self.overwrite:
                files, gone = [], [i.base_name for i in infos if not COMMITTED.match(i.base_name)]
            name = f"{MANIFEST}{number + 1:09d}"
            temp = f"{root}/_temporary/{self.job}/{name}"
            f.create_dir(temp.rsplit("/", 1)[0], recursive=True)
            with f.open_output_stream(temp) as out:
                out.write(json.dumps({"files": sorted(files + new), "gone": sorted(gone)}).encode())
            f.move(temp, f"{root}/{name}")
            old = infos if self.overwrite else [i for i in infos if i.base_name.startswith(MANIFEST)]
            list(pool.map(drop, old))
        self.abort(messages)

    def abort(self, messages) -> None:
        f, root = filesystem(self.path)
        try:
            f.delete_dir(f"{root}/_temporary/{self.job}")
        except OSError:
            pass
