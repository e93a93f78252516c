"""Where tables live, and which of their directories are complete.

A table that is rewritten keeps each write in a directory of its own, ``v00000000``,
``v00000001``, ...; Spark's ``_SUCCESS`` marker tells that the write was committed. Readers take
the highest committed one, so a failed or running write is never seen.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_VERSION = re.compile(r"^v(\d{8,})$")


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file given as a path or URI; 0 if it is gone."""
    p = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path) if "%" in path else path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getLen() if fs.exists(p) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write a small file; an existing one is an error unless it may be replaced."""
    fs, p = _file_system(spark, path)
    stream = fs.create(p, replace)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all; an existing one is replaced."""
    fs, p = _file_system(spark, path)
    draft = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    if not rename(spark, draft, path):
        fs.delete(p, False)
        if not rename(spark, draft, path):
            raise OSError(f"cannot write {path}")


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder to a name that is free; tells whether that was done."""
    fs, p = _file_system(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(goal):
        return False
    fs.mkdirs(goal.getParent())
    return fs.rename(p, goal)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def version_path(path: str, version: int) -> str:
    return f"{path}/v{version:08d}"


def is_committed(spark: SparkSession, path: str, version: int) -> bool:
    return exists(spark, f"{version_path(path, version)}/_SUCCESS")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all version directories, complete or not."""
    return sorted(int(m.group(1)) for m in map(_VERSION.match, children(spark, path)) if m)


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    return [n for n in versions(spark, path) if is_committed(spark, path, n)]


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Highest committed version; checks from the newest down."""
    return next((n for n in reversed(versions(spark, path)) if is_committed(spark, path, n)), None)


def drop_versions_before(spark: SparkSession, path: str, version: int) -> None:
    """Remove directories older than ``version``; call it when no reader uses them."""
    for found in versions(spark, path):
        if found < version:
            delete(spark, version_path(path, found))


class Tables:
    """Names to paths under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def event_log(self) -> str:
        return f"{self.root}/event_log"
