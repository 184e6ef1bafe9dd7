"""Small files beside tables, through Hadoop's file system, so that any store that Spark writes to will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _at(spark, path)
    return store.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; nothing if it is not there."""
    at, store = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(at)) if store.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    at, store = _at(spark, path)
    store.delete(at, True)


def replace(spark: SparkSession, draft: str, path: str) -> None:
    """draft becomes path, whatever stood there."""
    (old, store), new = _at(spark, path), spark._jvm.org.apache.hadoop.fs.Path(draft)
    store.delete(old, True)
    if not store.rename(new, old):
        raise OSError(f"{draft} could not be renamed to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    at, store = _at(spark, path)
    stream = store.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file whole or not at all, by a rename; False if it is there already."""
    at, store = _at(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    stream = store.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if store.exists(at) or not store.rename(draft, at):
        store.delete(draft, False)
        return False
    return True
