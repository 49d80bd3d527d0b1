"""Small file-system helpers on whatever storage the path names."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty if it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether any file below ``path`` has the suffix."""
    if not exists(spark, path):
        return False
    found = _fs(spark, path).listFiles(_path(spark, path), True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def listed(spark: SparkSession, path: str, suffix: str, most: int) -> Iterator[list[str]]:
    """Files below ``path`` with the suffix, by their path from there, ``most`` at a time.

    Hidden files and folders are left out, as Spark does. The listing is taken up as the store
    hands it out; one folder's children are sorted.
    """
    fs, found, waiting = _fs(spark, path), [], [""]
    while waiting:
        here = waiting.pop()
        inner = fs.listStatusIterator(_path(spark, f"{path}/{here}" if here else path))
        folders = []
        while inner.hasNext():
            status = inner.next()
            name = status.getPath().getName()
            if name.startswith(("_", ".")) and "=" not in name:
                continue
            name = f"{here}/{name}" if here else name
            if status.isDirectory():
                folders.append(name)
            elif name.endswith(suffix):
                found.append(name)
                if len(found) == most:
                    yield sorted(found)
                    found = []
        waiting += sorted(folders, reverse=True)
    if found:
        yield sorted(found)


def read_json(spark: SparkSession, path: str) -> dict:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Write the file in place of an older one."""
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()


def finished(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` that a Spark write has finished."""
    found = _fs(spark, path).globStatus(_path(spark, f"{path}/*/_SUCCESS"))
    return sorted(s.getPath().getParent().getName() for s in found or ())


def set_modified(spark: SparkSession, path: str, time: dt.datetime) -> None:
    """Give every file below ``path`` a modification time, as copies that keep times do."""
    fs, millis = _fs(spark, path), int(time.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    found = fs.listFiles(_path(spark, path), True)
    while found.hasNext():
        fs.setTimes(found.next().getPath(), millis, millis)


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
