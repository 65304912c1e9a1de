"""Small files and folders of any file system Spark can reach, through Hadoop's interface."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Taken(Exception):
    """A file of that name was there already."""


def _open(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return context._jvm, target.getFileSystem(context._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    _, fs, target = _open(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, in order; nothing for a folder that is not there."""
    _, fs, target = _open(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    jvm, fs, target = _open(spark, path)
    out = jvm.java.io.ByteArrayOutputStream()
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(target), out, 65536, True)
    return out.toString("UTF-8")


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a file with this text; ``Taken`` if there is one of that name.

    It is written under another name and renamed, so no reader sees a part of it, and of two
    writers one gets the name where the file system renames atomically, as HDFS does.
    """
    jvm, fs, target = _open(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(temporary, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    keep = spark.sparkContext._gateway.new_array(rename, 1)
    keep[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(target), keep)
    except Py4JJavaError as error:
        fs.delete(temporary, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise Taken(path) from None
        raise


def join_parts(spark: SparkSession, folder: str, path: str) -> None:
    """The part files of a folder, in order of their names, as one file in place of ``path``.

    Bytes are copied by blocks, whatever the size; the new file appears when it is complete.
    """
    jvm, fs, target = _open(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    try:
        for name in names(spark, folder):
            if name.startswith("part-"):
                part = fs.open(jvm.org.apache.hadoop.fs.Path(folder, name))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                part.close()
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, True)
    fs.rename(temporary, target)


def remove(spark: SparkSession, path: str) -> None:
    _, fs, target = _open(spark, path)
    fs.delete(target, True)
