"""Folders on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Entry names of a folder; empty if absent."""
    fs, folder = _at(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    fs, target = _at(spark, path)
    fs.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, in place at once."""
    fs, target = _at(spark, path)
    fs.create(target, True).close()


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder within one file system; the folder above the target is made if needed."""
    fs, old = _at(spark, path)
    _, new = _at(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {path} to {target}")
