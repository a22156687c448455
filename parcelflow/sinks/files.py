"""Small files and folders of any Hadoop store, handled from the driver."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """A path with its scheme, and the store it lies in."""
    jvm = spark.sparkContext._jvm
    given = jvm.org.apache.hadoop.fs.Path(path)
    store = given.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store, store.makeQualified(given)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _at(spark, path)
    return store.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    store, target = _at(spark, path)
    store.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    store, target = _at(spark, path)
    if not store.exists(target):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    store, target = _at(spark, path)
    stream = store.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file, or replace it."""
    store, target = _at(spark, path)
    stream = store.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; false if there is one already."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    _, source = _at(spark, draft)
    _, target = _at(spark, path)
    context = spark.sparkContext
    fs = context._jvm.org.apache.hadoop.fs
    keep = fs.Options.Rename.NONE
    options = context._gateway.new_array(fs.Options.Rename, 1)
    options[0] = keep
    try:
        fs.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration()).rename(
            source, target, options
        )
    except Py4JJavaError as failed:
        delete(spark, draft)
        if "FileAlreadyExistsException" in failed.java_exception.getClass().getName():
            return False
        raise
    return True
