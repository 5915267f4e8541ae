"""All-or-nothing output folders: written beside the target, marked, swapped in; schema and marker are checked at reading.

A table is first written whole to ``<path>.new-<id>`` with its schema and, last, a marker. Only a marked
folder takes the place of the old one. If a job fails before that, the old output stays and is what readers get. If it dies between
the two renames, the next reader or writer finds the old folder beside the target and puts it back.
A rename is one step on HDFS and on local disks; where it copies (object stores), readers must wait for the marker, as
``read_published`` does. Two writers of one path at a time are not supported.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Names with a leading underscore are no data to Spark's readers.
SCHEMA, MARKER = "_schema.json", "_complete.json"
#: Attempts at a swap that a reader has undone.
SWAPS = 3


class NotPublished(RuntimeError):
    """No complete output at a path."""


class Folder:
    """The few file operations needed, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._context = spark.sparkContext
        self._at = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._at.getFileSystem(self._context._jsc.hadoopConfiguration())

    @property
    def _jvm(self):
        return self._context._jvm

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._inside(name))

    def _inside(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._at, name) if name else self._at

    def write(self, name: str, text: str) -> None:
        out = self._files.create(self._inside(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        source = self._files.open(self._inside(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def rename(self, target: str) -> None:
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        if self._files.exists(to) or not self._files.rename(self._at, to):
            raise NotPublished(f"{self.path} could not take the place of {target}")

    def delete(self) -> None:
        self._files.delete(self._at, True)

    def siblings(self, kind: str) -> list[str]:
        """Paths ``<path>.<kind>-<id>``, oldest first."""
        parent, start = self._at.getParent(), f"{self._at.getName()}.{kind}-"
        if parent is None or not self._files.exists(parent):
            return []
        found = [s for s in self._files.listStatus(parent) if s.getPath().getName().startswith(start)]
        return [s.getPath().toString() for s in sorted(found, key=lambda s: s.getModificationTime())]


def recover(spark: SparkSession, path: str) -> None:
    """Finish a swap that was cut off: without a target, the last complete old folder is the target again."""
    target = Folder(spark, path)
    if target.exists():
        return
    for old in reversed(target.siblings("old")):
        folder = Folder(spark, old)
        if folder.exists(MARKER):
            folder.rename(target.path)
            return


def publish(spark: SparkSession, path: str, write: Callable[[str], None], facts: dict | None = None) -> None:
    """Let ``write`` fill a new folder, mark it and swap it in; what ``write`` raises leaves the old output as it was."""
    recover(spark, path)
    target, name = Folder(spark, path), uuid.uuid4().hex
    new = Folder(spark, f"{target.path}.new-{name}")
    try:
        write(new.path)
        for file, text in (facts or {}).items():
            new.write(file, text)
        new.write(MARKER, json.dumps({"id": name}))
    except BaseException:
        new.delete()
        raise
    moved = []
    for turn in range(SWAPS):
        if target.exists():
            old = f"{target.path}.old-{name}-{turn}"
            # A folder from elsewhere has no marker; it gets one, so that it can be put back as well.
            if not target.exists(MARKER):
                target.write(MARKER, json.dumps({"id": None}))
            target.rename(old)
            moved.append(old)
        try:
            new.rename(target.path)
            break
        except NotPublished:
            # A reader took the gap for a swap that was cut off and put the old folder back.
            if turn + 1 == SWAPS:
                raise
    for old in moved:
        Folder(spark, old).delete()


def publish_table(df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Publish ``df`` as parquet or headed CSV together with its schema."""
    if kind not in ("parquet", "csv"):
        raise ValueError(f"unknown kind {kind!r}")

    def write(folder: str) -> None:
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(folder) if kind == "parquet" else writer.option("header", True).csv(folder)

    facts = {SCHEMA: json.dumps({"kind": kind, "schema": df.schema.jsonValue()})}
    publish(df.sparkSession, path, write, facts)


def _kinds(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def read_published(spark: SparkSession, path: str, expected: T.StructType | None = None) -> DataFrame:
    """Read a published table by the schema it was written with.

    An unfinished folder is an error, and so is a schema other than ``expected`` (names, order and types; whether nulls
    are allowed is not compared).
    """
    recover(spark, path)
    folder = Folder(spark, path)
    if not folder.exists(MARKER) or not folder.exists(SCHEMA):
        raise NotPublished(f"{path} holds no complete table")
    stated = json.loads(folder.read(SCHEMA))
    schema = T.StructType.fromJson(stated["schema"])
    if expected is not None and _kinds(schema) != _kinds(expected):
        differing = sorted(set(_kinds(schema)) ^ set(_kinds(expected))) or "order of columns"
        raise NotPublished(f"{path} has another schema than expected: {differing}")
    reader = spark.read.schema(schema)
    if stated["kind"] == "parquet":
        return reader.parquet(folder.path)
    return reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(folder.path)
