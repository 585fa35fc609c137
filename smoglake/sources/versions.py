"""Versions of a group of tables that become visible together.

A version's data goes to folders of its own. It is published by one small file,
``<root>/_commits/<number>``, which names for every table the folders it is made
of; folders of earlier versions can be named again, so a version that adds rows
writes only those. Commit files are only ever added: a reader takes the highest
whole one and sees all tables of that version or, until the file is closed, all
of the one before. The number is taken by creating the file without overwriting,
so of two writers that start from the same version one fails. What a writer that
died left behind is never named by a commit.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"


@dataclass(frozen=True)
class Version:
    """A published version: ``tables`` maps a name to folders relative to the root, ``about`` holds anything else."""

    root: str
    number: int
    tables: dict[str, list[str]] = field(default_factory=dict)
    about: dict = field(default_factory=dict)

    def paths(self, table: str) -> list[str]:
        return [f"{self.root}/{p}" for p in self.tables.get(table, [])]

    def read(self, spark: SparkSession, table: str, schema=None, fmt: str = "parquet") -> DataFrame:
        """Scan of one table's folders. Without ``schema`` the columns of all folders are taken together."""
        paths = self.paths(table)
        if not paths:
            if schema is None:
                raise KeyError(f"version {self.number} has no table {table}")
            return spark.createDataFrame([], schema)
        reader = spark.read.format(fmt)
        reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", len(paths) > 1)
        return reader.load(paths)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all commit files, highest first."""
    files, target = _files(spark, f"{root}/{COMMITS}")
    if not files.exists(target):
        return []
    names = [e.getPath().getName() for e in files.listStatus(target)]
    return sorted((int(n) for n in names if n.isdigit()), reverse=True)


def _load(spark: SparkSession, root: str, number: int) -> Version | None:
    """The commit, or None while it is being written (or was left unfinished by a writer that died)."""
    files, target = _files(spark, f"{root}/{COMMITS}/{number:012d}")
    stream = files.open(target)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    if not text.endswith("\n"):
        return None
    made = json.loads(text)
    return Version(root, number, made["tables"], made["about"])


def latest(spark: SparkSession, root: str) -> Version | None:
    """The last published version, or None."""
    root = root.rstrip("/")
    for number in _numbers(spark, root):
        if (found := _load(spark, root, number)) is not None:
            return found
    return None


def history(spark: SparkSession, root: str) -> list[Version]:
    """All published versions that are still there, the first one first."""
    root = root.rstrip("/")
    return [v for n in reversed(_numbers(spark, root)) if (v := _load(spark, root, n)) is not None]


def fresh_folder(label: str = "data") -> str:
    """A folder name, relative to the root, that no other attempt uses."""
    return f"{label}-{uuid.uuid4().hex[:16]}"


def publish(spark: SparkSession, root: str, tables: dict[str, list[str]], about: dict | None = None,
            after: Version | None = None, number: int | None = None) -> Version:
    """Make a version visible. ``after`` is the version it was made from (None: the first).

    Its number is ``number``, or the next one that no writer has begun. If the last
    published version is no longer ``after``, or the number is taken, this raises and nothing changes.
    """
    root = root.rstrip("/")
    begun = _numbers(spark, root)
    now = latest(spark, root)
    if (now.number if now else None) != (after.number if after else None):
        raise RuntimeError(f"{root}: another version was published meanwhile")
    if number is None:
        number = begun[0] + 1 if begun else 0
    if now and number <= now.number:
        raise RuntimeError(f"{root}: version {number} is published already")
    files, target = _files(spark, f"{root}/{COMMITS}/{number:012d}")
    out = files.create(target, number in begun and _load(spark, root, number) is None)
    out.write(bytearray((json.dumps({"tables": tables, "about": about or {}}) + "\n").encode()))
    out.close()
    return Version(root, number, tables, about or {})


def vacuum(spark: SparkSession, root: str, label: str, older_than_s: float = 3600.0) -> int:
    """Delete folders named ``label-*`` that the last version does not use, and the commits before it, if they are
    older than any reader may need. Readers only ever open the last commit, so they never miss one."""
    root = root.rstrip("/")
    now = latest(spark, root)
    used = {p.split("/")[0] for paths in (now.tables if now else {}).values() for p in paths}
    before, gone = time.time() - older_than_s, 0

    def sweep(path: str, obsolete) -> int:
        files, target = _files(spark, path)
        found = [e for e in (files.listStatus(target) if files.exists(target) else [])
                 if obsolete(e.getPath().getName()) and e.getModificationTime() / 1000 < before]
        for entry in found:
            files.delete(entry.getPath(), True)
        return len(found)

    gone += sweep(root, lambda name: name.startswith(f"{label}-") and name not in used)
    if now:
        sweep(f"{root}/{COMMITS}", lambda name: name.isdigit() and int(name) < now.number)
    return gone
