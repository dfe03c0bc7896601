"""The few file system calls the library makes, on whatever file system a path names."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    fs, folder = _file_system(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(folder)]


def remove_path(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder to a name that is free; false if the file system refuses."""
    fs, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    fs.mkdirs(new.getParent())
    return not fs.exists(new) and fs.rename(old, new)


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of its name. Of several writers one succeeds, and nobody sees half a file.

    The text goes to a hidden file, which then takes the name: by a rename, which the file systems of a cluster refuse when the name is taken, or
    on a local disk, where a rename would replace the file, by a link.
    """
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    _, hidden = _file_system(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(target) and fs.rename(hidden, target)
        nio = spark.sparkContext._jvm.java.nio.file
        empty = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)
        place = lambda p: nio.Paths.get(p.toUri().getPath(), empty)
        nio.Files.createLink(place(target), place(hidden))
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    finally:
        fs.delete(hidden, False)
