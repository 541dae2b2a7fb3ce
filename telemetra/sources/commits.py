"""Crash-safe publication of files on a shared file system.

A *transaction* writes its files into a folder of its own beside the table, then records
where they go and which older files they replace, and only then renames them into place and
deletes what they replace. Until the record exists nothing outside the folder has changed,
and the next attempt starts anew; once it exists, ``recover`` (or the same transaction,
tried again) finishes the rest. Renames skip what has moved already, so every file arrives
once however often the driver is lost. Old files go after the new ones are there: a reader
may meet both for a moment, never neither.

These are metadata operations on a Hadoop file system, driven by the files of one batch.
The table's rows are read and written by Spark jobs. On a store without a cheap rename
(object stores) a move is a copy.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from itertools import islice

from pyspark.sql import SparkSession

PLAN, DONE = "_plan", "_done"
#: Lists the tasks' folders of named files that were written under their names.
FOLDERS = "_folders"
#: Renames at once (each is a call to the file system that mostly waits).
MOVERS = 16
#: Files of a transaction whose names are held at once.
MOVES = 10_000


def _unread(name: str) -> bool:
    """Whether Spark's readers leave out a file or folder of this name."""
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


class Files:
    """The file system of ``root``: the few operations that commits need."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._unescape = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        self._fs = self._path(root).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(folder)))

    def below(self, folder: str, hidden: bool = False) -> list[str]:
        """Data files under a folder, relative to it, hidden ones left out unless asked for."""
        if not self.exists(folder):
            return []
        mounted = self.posix(folder)
        if mounted:  # Hadoop's local file system starts a process for each file that it lists in this way
            found = [os.path.relpath(os.path.join(top, f), mounted) for top, _, files in os.walk(mounted) for f in files]
            return self._shown(found, hidden)
        return self._shown(self._walked(folder), hidden)

    @staticmethod
    def _shown(found: list[str], hidden: bool) -> list[str]:
        return sorted(f for f in found if hidden or not any(part.startswith(("_", ".")) for part in f.split("/")))

    def posix(self, path: str) -> str | None:
        """``path`` as programs open it where the file system is a mounted folder, else None."""
        uri = self._fs.makeQualified(self._path(path)).toUri()
        return uri.getPath() if uri.getScheme() == "file" else None

    def _walked(self, folder: str) -> Iterator[str]:
        """Files below a folder, relative to it, one by one, so that no whole listing is held."""
        top = len(self._fs.makeQualified(self._path(folder)).toUri().getPath().rstrip("/")) + 1
        it = self._fs.listFiles(self._path(folder), True)
        while it.hasNext():
            yield it.next().getPath().toUri().getPath()[top:]

    def parts(self, folder: str) -> Iterator[str]:
        """The ``part-`` files in the sub-folders of a folder, relative to it."""
        return (f for f in self._walked(folder) if f.count("/") == 1 and f.partition("/")[2].startswith("part-"))

    def listed(self, root: str, glob: str) -> Iterator[str]:
        """Paths of the files that Spark's readers find below ``root`` and whose names match
        ``glob``, one by one, in no order."""
        mounted = self.posix(root)
        if mounted is None:
            shown = (f for f in self._walked(root) if not any(map(_unread, f.split("/"))))
            yield from (f"{root.rstrip('/')}/{f}" for f in shown if fnmatchcase(f.rpartition("/")[2], glob))
            return
        folders = [mounted]
        while folders:
            with os.scandir(folders.pop()) as found:
                for entry in found:
                    if _unread(entry.name):
                        continue
                    if entry.is_dir():
                        folders.append(entry.path)
                    elif fnmatchcase(entry.name, glob):
                        yield entry.path

    def folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def create(self, path: str) -> bool:
        """Create an empty file that must not exist yet; whether it did."""
        return self._fs.createNewFile(self._path(path))

    def move(self, source: str, target: str) -> bool:
        return self._fs.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write_text(self, path: str, text: str) -> None:
        """The file appears whole, by a rename."""
        part = f"{path}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not self.move(part, path):
            raise OSError(f"could not publish {path}")

    def join(self, header: str, folder: str, target: str) -> None:
        """The files below ``folder``, in order of their names and after ``header``, as the one
        file ``target``. Bytes pass through in blocks; the file appears whole, by a rename."""
        part = f"{target.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(part), True)
        try:
            out.write(bytearray(header.encode()))
            for name in self.below(folder):
                source = self._fs.open(self._path(f"{folder}/{name}"))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, self._conf, False)
                finally:
                    source.close()
        finally:
            out.close()
        self.delete(target)
        if not self.move(part, target):
            raise OSError(f"could not publish {target}")

    def plain(self, hive_folder: str) -> str:
        """The value in the name of a partition's folder: ``place=2024-01%2Fx.csv`` → ``2024-01/x.csv``."""
        return self._unescape(hive_folder.partition("=")[2])

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def claim(spark: SparkSession, folder: str) -> int:
    """The next number of a folder of numbers, given to one caller only: the number is a
    file that must not exist yet, so two callers at once get two numbers."""
    fs = Files(spark, folder)
    fs.folder(folder)
    n = max([int(x) for x in fs.names(folder) if x.isdigit()], default=0) + 1
    while not fs.create(f"{folder}/{n:012d}"):
        n += 1
    return n


def _moves(fs: Files, stage: str, tx: str, plan: dict) -> Iterator[list[tuple[str, str]]]:
    """(from, to) of a transaction's files, for named files a task's folder or ``MOVES`` at a time."""
    listed = fs.read_text(f"{stage}/{FOLDERS}").split() if plan["named"] and fs.exists(f"{stage}/{FOLDERS}") else None
    for name, target in plan["moves"].items():
        if name == plan["named"] and listed is not None:
            for own in (f"{stage}/{name}/{x}" for x in listed):
                yield [(f"{own}/{rel}", f"{target}/{rel}") for rel in fs.below(own, hidden=True)]
        elif name == plan["named"]:
            found = fs.parts(f"{stage}/{name}") if fs.exists(f"{stage}/{name}") else iter(())
            while some := list(islice(found, MOVES)):
                yield [(f"{stage}/{name}/{rel}", f"{target}/{fs.plain(rel.rpartition('/')[0])}") for rel in some]
        else:
            found = ((rel, *rel.rpartition("/")[::2]) for rel in fs.below(f"{stage}/{name}"))
            yield [(f"{stage}/{name}/{rel}", f"{target}/{folder}/{tx}-{base}" if folder else f"{target}/{tx}-{base}") for rel, folder, base in found]


def _finish(fs: Files, home: str, tx: str) -> None:
    stage = f"{home}/{tx}"
    plan = json.loads(fs.read_text(f"{stage}/{PLAN}"))

    def move(pair: tuple[str, str]) -> None:
        if not fs.move(*pair) and fs.exists(pair[0]):
            raise OSError(f"could not move {pair[0]} to {pair[1]}")
    made: set[str] = set()
    for moves in _moves(fs, stage, tx, plan):
        for folder in sorted({place.rpartition("/")[0] for _, place in moves} - made):
            fs.folder(folder)
            made.add(folder)
        if len(moves) <= MOVERS:
            for pair in moves:
                move(pair)
        else:
            with ThreadPoolExecutor(MOVERS) as pool:
                list(pool.map(move, moves))
    for path in plan["replaces"]:
        fs.delete(path)
    if plan["again"]:
        fs.folder(f"{home}/{DONE}/{tx}")
    fs.delete(stage)


def transact(spark: SparkSession, home: str, tx: str, write: Callable[[str], Iterable[str] | None], moves: dict[str, str],
             again: bool = False, named: str | None = None) -> bool:
    """Run a transaction once and for all; False when it was done before.

    ``write(stage)`` writes sub-folders of ``stage`` and may return older files that the new
    ones replace; ``moves`` names the folder each sub-folder's files go to, sub-paths kept.
    The same ``tx`` tried again after a failure starts over or finishes, whichever is right.
    ``again``: the caller may try it again after it was done (a retried epoch of a stream),
    so that it was done is kept on record until ``forget``.
    """
    fs, stage = Files(spark, home), f"{home}/{tx}"
    if fs.exists(f"{home}/{DONE}/{tx}"):
        return False
    if not fs.exists(f"{stage}/{PLAN}"):
        fs.delete(stage)
        replaces = list(write(stage) or ())
        fs.folder(stage)
        fs.write_text(f"{stage}/{PLAN}", json.dumps({"moves": moves, "replaces": replaces, "again": again, "named": named}))
    _finish(fs, home, tx)
    return True


def recover(spark: SparkSession, home: str) -> list[str]:
    """Finish the transactions that a lost driver had recorded. What had no record yet is
    left alone (it may be another driver's work in progress)."""
    fs, finished = Files(spark, home), []
    for tx in fs.names(home):
        if tx != DONE and fs.exists(f"{home}/{tx}/{PLAN}"):
            _finish(fs, home, tx)
            finished.append(tx)
    return finished


def forget(spark: SparkSession, home: str, keep: Callable[[str], bool]) -> None:
    """Drop the marks of done transactions that can not be tried again."""
    fs = Files(spark, home)
    for tx in fs.names(f"{home}/{DONE}"):
        if not keep(tx):
            fs.delete(f"{home}/{DONE}/{tx}")
