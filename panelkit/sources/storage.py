"""Small files and folders in whatever file system an address names, through Hadoop."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of an address."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    files, where = file_system(spark, path)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds."""
    files, where = file_system(spark, path)
    return files.getFileStatus(where).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    files, where = file_system(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file unless there is one of that name, and tell whether this call made it.

    The text is written aside and renamed without overwriting, so nobody sees a part of it and of several
    callers one wins. That is as strict as the file system's rename is: on HDFS and the like it is atomic. Stores of
    objects that copy to rename need a connector with conditional writes.
    """
    files, where = file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid4().hex}")
    stream = files.create(aside, False)
    stream.write(text.encode())
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    # Without options nothing is overwritten.
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(where), options)
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def arrow_address(address: str) -> str:
    """An address as Arrow names it, for Python code in tasks: Hadoop's schemes for S3 are its ``s3``."""
    scheme, colon, rest = address.partition("://")
    return f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else address
