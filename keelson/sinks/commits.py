"""Numbered commit files: an optimistic log that several writers can share.

A log is a folder of files ``0000000001.json``, ``0000000002.json``, ...; a writer
prepares its data elsewhere and then puts the next number, which succeeds for one writer
only. The others see the number taken, read the log again and retry. A commit file
appears whole or not at all: it is written under another name first and then linked
(local files) or renamed where renaming refuses an existing target (HDFS-like stores).
A store whose rename replaces its target is not safe for concurrent writers.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

DIGITS = 10


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; an existing target or a refusal is an error."""
    fs, at = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(to) or not fs.rename(at, to):
        raise OSError(f"cannot rename {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, at = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with ``text``; False if it is there already."""
    fs, at = _fs(spark, path)
    fs.mkdirs(at.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            paths = spark._jvm.java.nio.file.Paths
            none = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
            old, new = (paths.get(p.toUri().getPath(), none) for p in (draft, at))
            try:
                spark._jvm.java.nio.file.Files.createLink(new, old)
                return True
            except Exception as e:
                if "FileAlreadyExistsException" not in str(e):
                    raise
                return False
        return not fs.exists(at) and fs.rename(draft, at)
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


def read_log(spark: SparkSession, folder: str) -> list[dict]:
    """All commits in order."""
    found = []
    for name in children(spark, folder):
        if name.startswith(".") or not name.endswith(".json"):
            continue
        fs, at = _fs(spark, f"{folder}/{name}")
        stream = fs.open(at)
        try:
            found.append(json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()))
        finally:
            stream.close()
    return found


def commit(spark: SparkSession, folder: str, number: int, entry: dict) -> bool:
    """Put commit ``number`` (from 1); False if another writer has it."""
    return put_if_absent(spark, f"{folder}/{number:0{DIGITS}d}.json", json.dumps(entry))
