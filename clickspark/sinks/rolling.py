"""K2 on streams: text files that roll by size, age and idle time.

A Python data source, ``rolling_text``.  Tasks write their rows as pieces into
``<path>/_pending`` (a new piece at ``max_bytes``), and the epoch's commit, on
the driver, enters them in a ledger: the names and sizes of the pieces that
make up the open file, never their rows.  The open file is published, its
pieces renamed beside each other as ``part-<number>-<piece>.txt``, once it
holds ``max_bytes``, is ``max_age_s`` old or got nothing for ``max_idle_s``.
Readers see published files only (names that begin with ``_`` are hidden).

A commit is one rename of the ledger, which also names the renames that are
due; those left by a crash are made first by the next commit.  A repeated
epoch is recognised by its number and its pieces are dropped; an aborted one
leaves nothing.  A stream without rows does not commit, so :func:`publish_due`
rolls an idle file from outside (a housekeeping job).
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

# data sources are also planned by a process that does not see added files
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEDGER, PENDING = "_ledger.json", "_pending"


@dataclass
class Limits:
    """The reference's: 1 GiB, 15 minutes, 5 minutes idle."""

    max_bytes: int = 1 << 30
    max_age_s: float = 900.0
    max_idle_s: float = 300.0


@dataclass
class Pieces(WriterCommitMessage):
    """What a task wrote: (name, bytes) of its pieces."""

    pieces: list[tuple[str, int]] = field(default_factory=list)


class Folder:
    """The target, local or on any file system that pyarrow reaches."""

    def __init__(self, path: str):
        from pyarrow import fs
        if "://" in path or path.startswith("file:"):
            self.fs, self.base = fs.FileSystem.from_uri(path)
        else:
            self.fs, self.base = fs.LocalFileSystem(), path
        self.missing = fs.FileType.NotFound

    def at(self, name: str) -> str:
        return f"{self.base}/{name}"

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(self.at(name)).type != self.missing

    def write(self, name: str, body: bytes) -> None:
        with self.fs.open_output_stream(self.at(name)) as out:
            out.write(body)

    def move(self, name: str, to: str) -> None:
        if self.exists(name):
            self.fs.move(self.at(name), self.at(to))

    def drop(self, name: str) -> None:
        if self.exists(name):
            self.fs.delete_file(self.at(name))


class Ledger:
    """The open file of a target."""

    def __init__(self, folder: Folder, limits: Limits):
        self.folder, self.limits = folder, limits
        self.now = {"batch": -1, "number": 0, "open": [], "bytes": 0, "since": 0.0, "last": 0.0, "due": []}
        if folder.exists(LEDGER):
            with folder.fs.open_input_stream(folder.at(LEDGER)) as f:
                self.now = json.loads(f.read())
        self._rename()

    def _rename(self) -> None:
        for name, to in self.now["due"]:
            self.folder.move(f"{PENDING}/{name}", to)

    def _close(self) -> None:
        n = self.now
        n["due"] += [[name, f"part-{n['number']:06d}-{i:04d}.txt"] for i, name in enumerate(n["open"])]
        n["number"] += bool(n["open"])
        n["open"], n["bytes"] = [], 0

    def roll(self, at: float) -> None:
        """Close the open file if it is old or idle."""
        n, limits = self.now, self.limits
        if n["open"] and (at - n["since"] >= limits.max_age_s or at - n["last"] >= limits.max_idle_s):
            self._close()

    def add(self, batch: int, pieces: Sequence[tuple[str, int]], at: float) -> bool:
        """Enter an epoch's pieces; False if the epoch was entered before."""
        n = self.now
        if batch <= n["batch"]:
            return False
        n["due"], n["batch"] = [], batch
        self.roll(at)
        for name, size in pieces:
            if not n["open"]:
                n["since"] = at
            n["open"].append(name)
            n["bytes"] += size
            n["last"] = at
            if n["bytes"] >= self.limits.max_bytes:
                self._close()
        return True

    def save(self) -> None:
        temp = f"_ledger-{uuid.uuid4().hex}"
        self.folder.write(temp, json.dumps(self.now).encode())
        self.folder.move(temp, LEDGER)
        self._rename()


def publish_due(path: str, limits: Limits, at: float | None = None) -> bool:
    """Publish the open file of ``path`` if it is old or idle; whether it was."""
    ledger = Ledger(Folder(path), limits)
    before = ledger.now["number"]
    ledger.now["due"] = []
    ledger.roll(time.time() if at is None else at)
    ledger.save()
    return ledger.now["number"] > before


class RollingTextWriter(DataSourceStreamWriter):
    def __init__(self, path: str, limits: Limits):
        self.path, self.limits = path, limits

    def write(self, iterator: Iterator) -> Pieces:
        folder = Folder(self.path)
        folder.fs.create_dir(folder.at(PENDING), recursive=True)
        done, out, size = Pieces(), None, 0
        try:
            for row in iterator:
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.txt", 0
                    out = folder.fs.open_output_stream(folder.at(f"{PENDING}/{name}"))
                    done.pieces.append((name, 0))
                line = (row[0] or "").encode() + b"\n"
                out.write(line)
                size += len(line)
                done.pieces[-1] = (name, size)
                if size >= self.limits.max_bytes:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list, batchId: int) -> None:
        folder = Folder(self.path)
        pieces = [p for m in messages if m for p in m.pieces]
        ledger = Ledger(folder, self.limits)
        if ledger.add(batchId, pieces, time.time()):
            ledger.save()
        else:
            self._forget(folder, pieces)

    def abort(self, messages: list, batchId: int) -> None:
        self._forget(Folder(self.path), [p for m in messages if m for p in m.pieces])

    @staticmethod
    def _forget(folder: Folder, pieces: Sequence[tuple[str, int]]) -> None:
        for name, _ in pieces:
            folder.drop(f"{PENDING}/{name}")


class RollingText(DataSource):
    """``writeStream.format('rolling_text')`` with options ``path``,
    ``max_bytes``, ``max_age_s``, ``max_idle_s``; rows of one text column."""

    @classmethod
    def name(cls) -> str:
        return "rolling_text"

    def streamWriter(self, schema, overwrite: bool) -> RollingTextWriter:
        o, plain = self.options, Limits()
        if len(schema.fields) != 1:
            raise ValueError("rolling_text writes one text column")
        return RollingTextWriter(o["path"], Limits(
            int(o.get("max_bytes", plain.max_bytes)), float(o.get("max_age_s", plain.max_age_s)),
            float(o.get("max_idle_s", plain.max_idle_s))))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RollingText)
