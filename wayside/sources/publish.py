"""Tables that replace older ones only once all of them are written.

A publication writes each table once, to a staging folder below its root, where it can be
read and checked. At the end a journal lists where the staged tables belong, and renames
put them there. An error before that leaves the old tables as they were. A driver lost
between the renames leaves the journal, and the next publication below the same root (or
``finish``) carries the renames out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, SparkSession

STAGING = "_staged-"
JOURNAL = "journal.json"


class Files:
    """The few calls to Hadoop's file systems that a publication needs."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.conf), path

    def exists(self, name: str) -> bool:
        fs, path = self._at(name)
        return fs.exists(path)

    def children(self, name: str) -> list[str]:
        fs, path = self._at(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def delete(self, name: str) -> None:
        fs, path = self._at(name)
        fs.delete(path, True)

    def rename(self, old: str, new: str) -> None:
        fs, path = self._at(old)
        target = self.jvm.org.apache.hadoop.fs.Path(new)
        fs.mkdirs(target.getParent())
        if not fs.rename(path, target):
            raise OSError(f"cannot rename {old} to {new}")

    def write(self, name: str, text: str) -> None:
        """A file that is there with all its text or not at all."""
        fs, path = self._at(f"{name}.part")
        out = fs.create(path, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.rename(f"{name}.part", name)

    def read(self, name: str) -> str:
        fs, path = self._at(name)
        stream = fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def parent(path: str) -> str:
    head, _, _ = path.rstrip("/").rpartition("/")
    return head or ("/" if path.startswith("/") else ".")


def write_once(df: DataFrame, path: str, fmt: str, options: dict, partition_by: Sequence[str] = ()) -> None:
    """Write a table to a path that nothing is at."""
    writer = df.write.format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def _put_in_place(files: Files, folder: str) -> None:
    """Carry out the journal of a staging folder, whatever of it is done already."""
    moves = json.loads(files.read(f"{folder}/{JOURNAL}"))
    for path, staged, old in moves:
        if not files.exists(staged):
            continue
        if files.exists(path):
            if files.exists(old):
                # a rename by copying that did not get to its end
                files.delete(path)
            else:
                files.rename(path, old)
        files.rename(staged, path)
    files.delete(folder)


def finish(spark: SparkSession, root: str) -> None:
    """Carry out publications below ``root`` that were lost after their last table was staged."""
    files = Files(spark)
    for name in files.children(root):
        if name.startswith(STAGING) and files.exists(f"{root}/{name}/{JOURNAL}"):
            _put_in_place(files, f"{root}/{name}")


def remove_unfinished(spark: SparkSession, root: str) -> None:
    """Delete what lost runs have staged below ``root``; no run may be at work there."""
    finish(spark, root)
    files = Files(spark)
    for name in files.children(root):
        if name.startswith(STAGING):
            files.delete(f"{root}/{name}")


class Publication:
    """Used in a ``with`` block, whose end puts the tables in place; an error drops them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/") or "/"
        self.files = Files(spark)
        self.folder = f"{self.root.rstrip('/')}/{STAGING}{uuid.uuid4().hex}"
        self.staged: dict[str, str] = {}
        self.numbers = count()
        finish(spark, self.root)

    def write(
        self, df: DataFrame, path: str, fmt: str = "parquet", options: dict | None = None, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Stage the table that belongs at ``path``; the staged table, valid inside the block."""
        path = path.rstrip("/")
        place = f"{self.folder}/{next(self.numbers)}-{path.rpartition('/')[2]}"
        self.staged[path] = place
        write_once(df, place, fmt, options or {}, partition_by)
        return self.spark.read.format(fmt).options(**(options or {})).load(place)

    def publish(self) -> None:
        moves = [(path, staged, f"{staged}-old") for path, staged in self.staged.items()]
        self.files.write(f"{self.folder}/{JOURNAL}", json.dumps(moves))
        _put_in_place(self.files, self.folder)

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.publish()
        else:
            self.files.delete(self.folder)
