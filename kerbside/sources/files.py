"""Folder listings through Spark's own file systems, so that every store Spark reads is reached."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, place = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; one that is gone already is no error."""
    system, place = _at(spark, path)
    system.delete(place, True)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    system, place = _at(spark, path)
    if system.exists(place):
        raise FileExistsError(f"[PATH_ALREADY_EXISTS] {path}")
    out = system.create(place, False)  # fails as well if another writer came first
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, place = _at(spark, path)
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
