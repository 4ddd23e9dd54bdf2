"""Folder checks and moves on the file system of a path."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _open(spark, path)
    return system.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    target, system = _open(spark, path)
    return [status.getPath().getName() for status in system.listStatus(target)]


def make_dir(spark: SparkSession, path: str) -> None:
    target, system = _open(spark, path)
    system.mkdirs(target)


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Move a finished folder to its final name, in one step where the file system can."""
    source, system = _open(spark, staged)
    target, _ = _open(spark, final)
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot move {staged} to {final}")


def remove(spark: SparkSession, path: str) -> None:
    target, system = _open(spark, path)
    system.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    target, system = _open(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Put a small file in place in one step; False if there is one already and it is not to be replaced."""
    target, system = _open(spark, path)
    system.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    source = hadoop.Path(target.getParent(), f".{target.getName()}.{os.urandom(6).hex()}")
    stream = system.create(source, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    kinds = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE if replace else kinds.NONE
    files = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, how)
    except Exception:
        system.delete(source, False)
        if not replace and system.exists(target):
            return False
        raise
    return True
