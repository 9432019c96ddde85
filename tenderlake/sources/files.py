"""Existence, listing, small texts and removal of paths on whatever storage the cluster uses."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tenderlake.session import hadoop_path


def matches(spark: SparkSession, pattern: str) -> list[str]:
    fs, jpath = hadoop_path(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(jpath) or []]


def any_match(spark: SparkSession, pattern: str) -> bool:
    return bool(matches(spark, pattern))


def sizes(spark: SparkSession, pattern: str) -> dict[str, int]:
    """Bytes of each file."""
    fs, jpath = hadoop_path(spark, pattern)
    return {s.getPath().toString(): s.getLen() for s in fs.globStatus(jpath) or [] if s.isFile()}


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_path(spark, path)
    fs.delete(jpath, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, source = hadoop_path(spark, path)
    _, target = hadoop_path(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise FileExistsError(to)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    fs, jpath = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file aside and renames it, so that it is there as a whole or not at all; never over another one."""
    fs, jpath = hadoop_path(spark, path)
    _, aside = hadoop_path(spark, path + ".part")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(jpath) or not fs.rename(aside, jpath):
        fs.delete(aside, False)
        raise FileExistsError(path)
