"""Folders of the tables this package keeps, through Hadoop's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root`` (none when it is missing)."""
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def files(spark: SparkSession, root: str) -> list[str]:
    """Names of the files directly below ``root`` (none when it is missing)."""
    p, fs = _path(spark, root)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def move_only_file(spark: SparkSession, folder: str, path: str) -> None:
    """Move the one data file that a job wrote into ``folder`` to ``path``, replacing that file."""
    p, fs = _path(spark, folder)
    (file,) = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-")]
    target, _ = _path(spark, path)
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    if not fs.rename(file, target):
        raise OSError(f"could not move {file} to {path}")
    fs.delete(p, True)
