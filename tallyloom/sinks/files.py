"""Small driver-side file operations on any Hadoop file system."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    return spark._jvm.org.apache.hadoop.fs.Path(location)


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, location: str) -> str | None:
    """Content of a small file, or None if there is none."""
    path = _path(spark, location)
    fs = _fs(spark, path)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a small file beside its place, then rename it over the old one."""
    target = _path(spark, location)
    draft = _path(spark, f"{location}.{uuid.uuid4().hex}")
    stream = _fs(spark, draft).create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(draft, target, options)


def claim(spark: SparkSession, location: str) -> bool:
    """Create an empty file; False if it is there already. Atomic where the storage is."""
    path = _path(spark, location)
    fs = _fs(spark, path)
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        local = path.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    return fs.createNewFile(path)


def exists(spark: SparkSession, location: str) -> bool:
    path = _path(spark, location)
    return _fs(spark, path).exists(path)


def children(spark: SparkSession, location: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the entries of a folder."""
    path = _path(spark, location)
    fs = _fs(spark, path)
    if not fs.exists(path):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(path)]


def remove(spark: SparkSession, location: str) -> None:
    path = _path(spark, location)
    _fs(spark, path).delete(path, True)
