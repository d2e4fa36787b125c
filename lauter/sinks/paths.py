"""The few file-system calls the sinks need, on whatever store the path names."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _open(spark, path)
    return fs.exists(location)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, none if it does not exist."""
    fs, location = _open(spark, path)
    if not fs.exists(location):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(location))


def delete(spark: SparkSession, path: str) -> None:
    fs, location = _open(spark, path)
    fs.delete(location, True)


def make(spark: SparkSession, path: str) -> None:
    """Create a folder and its parents if they do not exist."""
    fs, location = _open(spark, path)
    fs.mkdirs(location)


def read(spark: SparkSession, path: str) -> str | None:
    """The text of a file, None if it does not exist."""
    fs, location = _open(spark, path)
    try:
        stream = fs.open(location)
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return None
        raise
    try:
        # one call for the whole file: bytes cross to Python as one value
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first bytes of a file."""
    fs, location = _open(spark, path)
    stream = fs.open(location)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, location = _open(spark, path)
    return fs.getContentSummary(location).getLength()


def write(spark: SparkSession, path: str, text: str) -> None:
    """A file with this text, in place of another one of its name."""
    fs, location = _open(spark, path)
    stream = fs.create(location, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with its whole content at once; False if the name is taken.

    The text is written under a name of its own first. On a local file system it is then
    linked to its name, elsewhere renamed without overwriting: of two writers of the same
    name exactly one gets True. That needs a store whose rename does not overwrite and is
    atomic, such as HDFS; plain object stores need a committer that gives them one.
    """
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write(spark, draft, text)
    fs, source = _open(spark, draft)
    if fs.getScheme() == "file":
        here = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
        try:
            os.link(source.toUri().getPath(), here)
        except FileExistsError:
            return False
        finally:
            fs.delete(source, False)
        return True
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(source, hadoop.Path(path), options)
    except Py4JJavaError as error:
        fs.delete(source, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True
