"""Small files and folders next to tables, through the file system that holds them."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None where there is none."""
    if not _system(spark, path).exists(_path(spark, path)):
        return None
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside and rename it over the old one, which file systems do in one step."""
    fs = spark._jvm.org.apache.hadoop.fs
    folder, name = os.path.split(path)
    system, aside = _system(spark, path), _path(spark, os.path.join(folder, f"_{name}-{uuid.uuid4().hex}"))
    out = system.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(system.makeQualified(aside).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, _path(spark, path), overwrite)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    return [found.getPath().toString() for found in _system(spark, pattern).globStatus(_path(spark, pattern)) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder; nothing happens where there is none."""
    _system(spark, path).delete(_path(spark, path), True)


def remove_if_empty(spark: SparkSession, folder: str) -> None:
    system = _system(spark, folder)
    if system.exists(_path(spark, folder)) and not system.listStatus(_path(spark, folder)):
        system.delete(_path(spark, folder), False)
