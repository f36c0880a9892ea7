"""Folder operations on whatever file system the path names."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.exists(jpath)


def remove(spark: SparkSession, path: str) -> bool:
    fs, jpath = _path(spark, path)
    return fs.delete(jpath, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    fs, jpath = _path(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything right below ``path``."""
    fs, jpath = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder has partition folders or files of a finished write."""
    fs, jpath = _path(spark, path)
    if not fs.exists(jpath):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(jpath))


def write_note(spark: SparkSession, path: str, content: dict) -> None:
    """Put a new small JSON file in place, complete or not at all."""
    fs, jpath = _path(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path + ".draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if fs.exists(jpath) or not fs.rename(draft, jpath):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> dict | None:
    if not exists(spark, path):
        return None
    fs, jpath = _path(spark, path)
    stream = fs.open(jpath)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
