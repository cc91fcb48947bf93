"""Folders of a table, through the file system that Spark itself uses for their path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _at(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, none if it is not there. Nothing further down is listed."""
    files, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def create(spark: SparkSession, path: str) -> bool:
    """Make an empty file that is not there yet; False where it is. Of several callers one gets True."""
    files, target = _at(spark, path)
    try:
        files.create(target, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file."""
    files, target = _at(spark, path)
    out = files.create(target, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _at(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    files, target = _at(spark, path)
    if not files.rename(target, _at(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)
