"""Quality checks judged load by load: a run reads the new rows only, and the suite adds the loads up."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.plans.quality import SUITE, Check, counted_values, evaluated

_STATE = "id int, value string, n bigint, known boolean"


class CheckStates:
    """What each load contributes to the checks, as a table of counted values under ``path``, one folder a load.

    Counts of values add up and marks of known parents are joined by OR, so the sum over the loads equals one run over all
    rows: keys repeated in two loads are found, and a child may come before its parent. A load is one set of rows, such as
    a folder of a fact table; judging it again, after a replay or when its rows have changed, replaces its state. While a
    load is judged anew its old state is gone, and after a failure it is missing from ``loads`` until it is judged again.
    Other checks have states of their own, so a changed suite starts anew.
    """

    def __init__(self, spark: SparkSession, path: str, checks: Iterable[Check] = SUITE) -> None:
        self._spark, self.checks = spark, tuple(checks)
        self._path = f"{path.rstrip('/')}/{hashlib.sha256(repr(self.checks).encode()).hexdigest()[:16]}"

    def judge(self, load: str, models: Mapping[str, DataFrame]) -> None:
        """Judge the rows of one load: the tables it holds rows of; tables without new rows may be left out."""
        checks = self.checks
        if any(c.model in models or c.parent in models for c in checks):
            counted_values(models, checks, partly=True).write.mode("overwrite").parquet(f"{self._path}/load={quote(load, safe='')}")

    def _folders(self) -> list[str]:
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        system = folder.getFileSystem(self._spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        done = [s.getPath() for s in system.listStatus(folder)]
        success = self._spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in done if system.exists(success(p, "_SUCCESS")))

    def loads(self) -> list[str]:
        """The judged loads, as named in their folders."""
        return [name.removeprefix("load=") for name in self._folders()]

    def results(self) -> DataFrame:
        """One row per check, as ``run_checks`` gives for all rows of all loads."""
        folders = [f"{self._path}/{name}" for name in self._folders()]
        if folders:
            states = self._spark.read.schema(_STATE).parquet(*folders)
        else:
            states = self._spark.createDataFrame([], _STATE)
        return evaluated(states.groupBy("id", "value").agg(F.sum("n").alias("n"), F.max("known").alias("known")), self.checks)
