"""Small files of the lake, through the Hadoop file system that Spark has for their path.

For what a job must do exactly once and by itself: a file that is there or not, a
folder's names. Data goes through DataFrames.
"""

from __future__ import annotations

from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getName().endswith(name)


def create_file(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Write a small file; False if it is there already and is not to be replaced.

    Of several writers of one path, one creates it, on stores whose create
    fails for a name that is taken (HDFS, Azure; S3 with conditional writes on).
    Hadoop's local file system looks first and creates then, so a local file is
    opened by the driver itself, for exclusive creation.
    """
    files, place = _opened(spark, path)
    if not overwrite and files.getUri().getScheme() == "file":
        local = Path(place.toUri().getPath())
        local.parent.mkdir(parents=True, exist_ok=True)
        try:
            with local.open("xb") as own:
                own.write(text.encode())
        except FileExistsError:
            return False
        return True
    try:
        out = files.create(place, overwrite)
    except Py4JJavaError as error:
        if not overwrite and (_is(error, "FileAlreadyExistsException") or files.exists(place)):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def file_names(spark: SparkSession, path: str) -> list[str] | None:
    """The names in a folder, none for one that is not there, and None for a file."""
    files, place = _opened(spark, path)
    try:
        found = files.listStatus(place)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return []
        raise
    if len(found) == 1 and found[0].isFile() and found[0].getPath().equals(files.makeQualified(place)):
        return None
    return [status.getPath().getName() for status in found]


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    files, place = _opened(spark, path)
    try:
        opened = files.open(place)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def remove_file(spark: SparkSession, path: str) -> None:
    """Take away one file, or an empty folder."""
    files, place = _opened(spark, path)
    files.delete(place, False)
