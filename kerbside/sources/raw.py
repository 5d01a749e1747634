"""Readers of the five raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.schemas import RAW_COLUMNS, raw_schema


def read_csv(spark: SparkSession, path: str, table: str, mode: str = "FAILFAST") -> DataFrame:
    """One raw table from CSV with a header. Empty fields are null; a malformed number fails the read.

    The declared schema saves the extra pass that inference would make over the files.
    """
    return spark.read.schema(raw_schema(table)).csv(path, header=True, mode=mode, enforceSchema=False)


def read_raw(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """All raw tables of a folder: ``raw_<table>.csv`` files, or ``raw_<table>`` parquet folders."""
    if fmt == "csv":
        return {t: read_csv(spark, f"{folder}/raw_{t}.csv", t) for t in RAW_COLUMNS}
    return {t: spark.read.parquet(f"{folder}/raw_{t}") for t in RAW_COLUMNS}


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Written model tables by name, for analysis jobs that only read."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
