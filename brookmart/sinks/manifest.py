"""Small files that commit something by appearing under their name.

A manifest is written under a hidden name and renamed, which happens at once or not
at all on HDFS and local disks, and it is never written again: whoever repeats the
work finds it and leaves it as it is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = folder(spark, path)
    return fs.exists(at)


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Commit ``text`` as ``path``; False if somebody has done so before."""
    fs, at = folder(spark, path)
    if fs.exists(at):
        return False
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.rename(draft, at):
        return True
    fs.delete(draft, False)
    return False


def get(spark: SparkSession, path: str) -> str:
    fs, at = folder(spark, path)
    size, given = fs.getFileStatus(at).getLen(), fs.open(at)
    try:
        return bytes(given.readNBytes(size)).decode()
    finally:
        given.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none if there is no folder."""
    fs, at = folder(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for n in found if n[0] not in "._")


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files anywhere below a folder."""
    fs, at = folder(spark, path)
    out = []
    if fs.exists(at):
        found = fs.listFiles(at, True)
        while found.hasNext():
            status = found.next()
            if status.getPath().getName()[0] not in "._":
                out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


def move(spark: SparkSession, path: str, to: str, prefix: str) -> None:
    """Move the files of a folder to another one, under names with a prefix."""
    fs, target = folder(spark, to)
    for name in names(spark, path):
        new = spark._jvm.org.apache.hadoop.fs.Path(target, prefix + name)
        if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), new):
            raise OSError(f"{path}/{name} could not be moved to {to}")


def delete(spark: SparkSession, path: str) -> None:
    fs, at = folder(spark, path)
    fs.delete(at, True)
