"""Folders and small files of a shared file system, by name."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _failed_with(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def local_place(spark: SparkSession, folder: str) -> tuple[str, str] | None:
    """URI, as Spark has it in file paths, and path of a folder on a local disk; None on other file systems."""
    path, files = _at(spark, folder)
    if files.getUri().getScheme() != "file":
        return None
    uri = _at(spark, files.makeQualified(path).toString())[0].toUri()
    return uri.toString(), uri.getPath()


def hadoop_setting(spark: SparkSession, name: str) -> str | None:
    return spark._jsc.hadoopConfiguration().get(name)


def umask(spark: SparkSession) -> int:
    """The permissions that Hadoop's file systems withhold from new files and folders."""
    return spark._jvm.org.apache.hadoop.fs.permission.FsPermission.getUMask(spark._jsc.hadoopConfiguration()).toShort()


def make_folder(spark: SparkSession, folder: str) -> None:
    path, files = _at(spark, folder)
    files.mkdirs(path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a glob pattern; none if nothing does."""
    path, files = _at(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(path) or []]


def remove_folder(spark: SparkSession, folder: str) -> None:
    path, files = _at(spark, folder)
    files.delete(path, True)


def children(spark: SparkSession, folder: str) -> list[tuple[str, bool, int]]:
    """Name, whether it is a folder, and size of what lies directly in a folder; nothing if there is none."""
    path, files = _at(spark, folder)
    try:
        found = files.listStatus(path)
    except Py4JJavaError as error:
        if _failed_with(error, "FileNotFoundException"):
            return []
        raise
    return [(status.getPath().getName(), status.isDirectory(), status.getLen()) for status in found]


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder, hidden ones left out."""
    return sorted(name for name, _, _ in children(spark, folder) if not name.startswith("."))


def modified_at(spark: SparkSession, path: str) -> int:
    """Milliseconds since 1970."""
    at, files = _at(spark, path)
    return files.getFileStatus(at).getModificationTime()


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that does not exist yet; false if it does. As atomic as the file system's exclusive create."""
    at, files = _at(spark, path)
    try:
        out = files.create(at, False)
    except Py4JJavaError as error:
        if _failed_with(error, "FileAlreadyExistsException"):
            return False
        raise
    out.write(bytearray(f"{text}\n".encode()))
    out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str | None:
    """What :func:`create_small` wrote; None if there is no such file, or it is not whole yet."""
    at, files = _at(spark, path)
    try:
        stream = files.open(at)
    except Py4JJavaError as error:
        if _failed_with(error, "FileNotFoundException"):
            return None
        raise
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None
