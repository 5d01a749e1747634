"""Incremental fact table on plain parquet: delete by key, insert, high-water mark, atomic switch."""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.bloom import FILTER_SCHEMA, KEYS_PER_ROW, buckets_for, groups_holding, key_filters
from kerbside.session import materialise
from kerbside.sources.files import delete_folder, names_in, read_small, write_new

_NO_PERIOD = "none"
_PLACE = ("period", "load", "loaded_at", "low", "high", "buckets")


class FactTable:
    """A fact table of unique keys, split by the period (day or month) of its event time.

    Data files are written once, under ``data/load=.../period=...``, and never changed. A commit is one small file that
    lists the (period, load) folders the table consists of, with the least and greatest key of each; readers take the
    newest commit. Beside each load lie the Bloom filters of its folders' keys, under ``keys/load=...``. A job that dies before its commit leaves the table as it was, and may simply run again. Only
    folders whose key range and Bloom filter meet an arriving key are searched, and only periods that lose a superseded row, or
    have gathered more than ``most_folders`` folders, are rewritten; all others are carried over by name. One job at
    a time may load a table: the commit of a second one fails, since its number is taken. The newest
    ``keep_commits`` commits stay and can be compared by ``changes``; older ones go, with the folders only they list. ``clock`` tells the
    time that a load notes for the freshness check.

    ``lookback`` (an interval such as ``"3 days"``) lets batch loads also admit rows that arrive late.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        ts: str,
        grain: str = "day",
        lookback: str | None = None,
        most_folders: int = 8,
        keep_commits: int = 20,
        clock: Callable[[], datetime] = datetime.now,
    ):
        self.spark, self.root, self.key, self.ts = spark, root.rstrip("/"), key, ts
        self.lookback, self.most_folders, self.keep_commits = lookback, most_folders, max(1, keep_commits)
        self.clock = clock
        self.label_format = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}[grain]

    # -- reading ------------------------------------------------------------------------------------------------
    def exists(self) -> bool:
        return self._newest() is not None

    def read(self, since: str | None = None, months: set[str] | None = None) -> DataFrame:
        """The current rows; ``since`` (a period label) leaves older periods unread, ``months`` (as yyyy-MM) all others."""
        state = self._newest()
        if state is None:
            raise FileNotFoundError(f"no committed fact table at {self.root}")
        folders = [f for f in state["folders"] if since is None or f["period"] >= since]
        if months is not None:
            folders = [f for f in folders if f["period"][:7] in months]
        return self._rows(folders, _schema(state))

    def high_water_mark(self) -> datetime | None:
        """Latest event time, read from the newest period only."""
        state = self._newest()
        return None if state is None else self._mark(state)

    def loads(self) -> DataFrame:
        """The folders of the table with the time each was loaded; the freshness check reads ``loaded_at``."""
        state = self._newest()
        folders = [] if state is None else [(f["period"], f["load"], f["loaded_at"]) for f in state["folders"]]
        return self.spark.createDataFrame(folders, "period string, load string, loaded_at timestamp")

    def version(self) -> int:
        """The number of the newest commit; 0 before the first."""
        return max(self._commits(), default=0)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """What the commits after ``since``, up to ``until`` (the newest), did to the table.

        One row for each key that came, went or got another row: the columns of the table as they are afterwards (as they
        were, for a removed key), ``change`` (inserted, updated or removed) and ``was``, the event time before. Folders
        that both commits list hold the same rows and are not read; rows that were only moved by a rewrite are no change.
        """
        after = self._state(self.version() if until is None else until)
        before = self._state(since)["folders"] if since else []
        schema = _schema(after)
        listed, had = ({(f["period"], f["load"]) for f in folders} for folders in (after["folders"], before))
        now = self._rows([f for f in after["folders"] if (f["period"], f["load"]) not in had], schema)
        old = self._rows([f for f in before if (f["period"], f["load"]) not in listed], schema)
        new = now.select(F.col(self.key).alias("_key"), F.struct(*schema.names).alias("_now"))
        gone = old.select(F.col(self.key).alias("_old_key"), F.struct(*schema.names).alias("_was"))
        both = new.join(gone, F.col("_key").eqNullSafe(F.col("_old_key")), "full").filter(~F.col("_now").eqNullSafe(F.col("_was")))
        kind = F.when(F.col("_was").isNull(), "inserted").when(F.col("_now").isNull(), "removed").otherwise("updated")
        row = F.coalesce("_now", "_was")
        return both.select(*[row[c].alias(c) for c in schema.names], kind.alias("change"), F.col("_was")[self.ts].alias("was"))

    def pending(self, staged: DataFrame) -> DataFrame:
        """Rows of ``staged`` that the next load could admit, to be cut before any dedup.

        The latest version of a key lies above the floor exactly if some version does, so deduplicating only these
        rows gives the same batch, and the time limit reaches the scan instead of stopping at the dedup window.
        """
        mark = self.high_water_mark()
        return staged if mark is None else self._admitted(staged, mark, "load")

    # -- loading ------------------------------------------------------------------------------------------------
    def load(self, source: DataFrame, full_refresh: bool = False, empty_target: str = "load") -> DataFrame:
        """Bring ``source`` (unique keys) into the table and return the table.

        The first run and ``full_refresh`` take everything. Later runs take rows strictly after the high-water mark,
        replace the rows of the same key and keep all others. With ``lookback`` the floor lies that much lower, and a
        row replaces its stored version only if it is not older. A table that exists but is empty has no mark and
        takes everything; ``empty_target="block"`` makes it take nothing.
        """
        state = self._newest()
        if state is None or full_refresh:
            run = self._run(state)
            return self._commit(state, self._write(source, f"{run}-all"), source.schema)
        admitted = self._admitted(source, self._mark(state), empty_target)
        return self._bring(state, admitted, may_be_older=self.lookback is not None)

    def merge(self, source: DataFrame, stream: str, batch: int, timeless_is_oldest: bool = False) -> DataFrame:
        """Bring all rows of a micro-batch (unique keys) into the table, whatever their times.

        A row replaces its stored version unless that is newer; with ``timeless_is_oldest`` a row without a time replaces
        only such a row. The commit notes the batch of each stream, so that a replayed batch changes nothing.
        """
        state = self._newest()
        done = {} if state is None else dict(state["batches"] or {})
        if done.get(stream, -1) >= batch:
            return self.read()
        return self._bring(state, source, may_be_older=True, batches={**done, stream: batch}, timeless_is_oldest=timeless_is_oldest)

    def _run(self, state: Row | None) -> str:
        return f"{1 if state is None else state['commit'] + 1:06d}-{uuid.uuid4().hex[:8]}"

    def _bring(
        self, state: Row | None, source: DataFrame, may_be_older: bool, batches: dict[str, int] | None = None, timeless_is_oldest: bool = False
    ) -> DataFrame:
        run, folders = self._run(state), [] if state is None else list(state["folders"])
        if may_be_older and folders:
            source = self._not_older(materialise(source, "arrivals"), folders, timeless_is_oldest)
        inserted = self._write(source, f"{run}-new")
        if not inserted and (state is None or batches is None):
            return self._rows(folders, source.schema if state is None else _schema(state))
        keys = self._rows(inserted, source.schema).select(self.key)
        touched = self._periods_with(self._maybe_holding(self._meeting(folders, inserted), keys), keys, source.schema)
        losing = [f for f in folders if f["period"] in touched]
        kept = []
        if losing:
            survivors = self._rows(losing, source.schema).join(keys, self.key, "left_anti")
            kept = self._write(survivors, f"{run}-old")
        carried = [f for f in folders if f["period"] not in touched]
        listed = self._compacted(carried + kept + inserted, f"{run}-compact", source.schema)
        return self._commit(state, listed, source.schema, batches)

    def _admitted(self, source: DataFrame, mark: datetime | None, empty_target: str) -> DataFrame:
        if mark is None:
            return source if empty_target == "load" else source.limit(0)
        floor = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
        if self.lookback:
            floor = floor - F.expr(f"interval {self.lookback}")
        return source.filter(F.col(self.ts) > floor)

    def _not_older(self, arrivals: DataFrame, folders: list[Row], timeless_is_oldest: bool) -> DataFrame:
        """The arriving rows whose stored version, if any, is not newer."""
        ends = arrivals.agg(F.min(F.col(self.key).cast("string")).alias("low"), F.max(F.col(self.key).cast("string")).alias("high"))
        stored = self._rows(self._meeting(folders, ends.collect()), arrivals.schema)
        stored = stored.select(F.col(self.key).alias("_key"), F.col(self.ts).alias("_stored_at"))
        newer = arrivals.select(self.key, self.ts).join(stored, F.col(self.key) == F.col("_key"))
        above = F.col("_stored_at") > F.col(self.ts)
        newer = newer.filter(above | (F.col(self.ts).isNull() & F.col("_stored_at").isNotNull()) if timeless_is_oldest else above).select(self.key)
        return arrivals.join(newer, self.key, "left_anti")

    def _compacted(self, folders: list[Row], load: str, schema: T.StructType) -> list[Row]:
        """One folder in place of the small folders of every period that has too many.

        A folder with more keys than all smaller ones together stays as it is, so that a row is rewritten a number of times
        that grows with the logarithm of the loads, not with their number.
        """
        many = {p for p, n in Counter(f["period"] for f in folders).items() if n > self.most_folders}
        small = [f for p in many for f in self._small([f for f in folders if f["period"] == p])]
        if not small:
            return folders
        gone = {(f["load"], f["period"]) for f in small}
        return [f for f in folders if (f["load"], f["period"]) not in gone] + self._write(self._rows(small, schema), load)

    def _small(self, folders: list[Row]) -> list[Row]:
        """The folders of a period to be merged: at least as many as are too many, and two."""
        folders = sorted(folders, key=lambda f: f["buckets"], reverse=True)
        kept = 0
        while kept < self.most_folders - 1 and folders[kept]["buckets"] > sum(f["buckets"] for f in folders[kept + 1 :]):
            kept += 1
        return folders[kept:]

    @staticmethod
    def _meeting(folders: list[Row], arriving: list[Row]) -> list[Row]:
        """The folders whose key range meets that of an arriving one; folders without keys meet none."""
        ranges = [(a["low"], a["high"]) for a in arriving if a["low"] is not None]
        return [f for f in folders if f["low"] is not None and any(f["low"] <= high and low <= f["high"] for low, high in ranges)]

    def _maybe_holding(self, folders: list[Row], keys: DataFrame) -> list[Row]:
        """The folders whose Bloom filter lets one of ``keys`` through. The filters are about a byte a key.

        Every key asks every folder's filter; where that is more than the keys the folders hold, they are all named, and
        the search of their key columns is the cheaper way."""
        if not folders or keys.count() * len(folders) > sum(f["buckets"] for f in folders) * KEYS_PER_ROW:
            return folders
        paths = sorted({f"{self.root}/keys/load={f['load']}" for f in folders})
        filters = self.spark.read.schema(f"period string, {FILTER_SCHEMA}, load string").option("basePath", f"{self.root}/keys").parquet(*paths)
        filters = filters.filter(F.concat_ws("/", "load", "period").isin([f"{f['load']}/{f['period']}" for f in folders]))
        found = groups_holding(filters, ["load", "period"], [f["buckets"] for f in folders], keys, self.key)
        held = {(r["load"], r["period"]) for r in found.collect()}
        return [f for f in folders if (f["load"], f["period"]) in held]

    def _mark(self, state: Row) -> datetime | None:
        dated = [f for f in state["folders"] if f["period"] != _NO_PERIOD]
        if not dated:
            return None
        newest = max(f["period"] for f in dated)
        rows = self._rows([f for f in dated if f["period"] == newest], _schema(state))
        return rows.agg(F.max(self.ts)).first()[0]

    def _periods_with(self, folders: list[Row], keys: DataFrame, schema: T.StructType) -> set[str]:
        """Periods that hold one of ``keys`` in the given folders. Reads their key column only; periods come back."""
        if not folders:
            return set()
        rows = self._rows(folders, schema, "period").select(self.key, "period")
        return {r["period"] for r in rows.join(keys, self.key, "left_semi").select("period").distinct().collect()}

    # -- files --------------------------------------------------------------------------------------------------
    def _write(self, df: DataFrame, load: str) -> list[Row]:
        """Write one load, split by period, and list its folders. Rebalancing splits large periods into files."""
        path = f"{self.root}/data/load={load}"
        label = F.coalesce(F.date_format(self.ts, self.label_format), F.lit(_NO_PERIOD))
        df.withColumn("period", label).hint("rebalance", "period").write.partitionBy("period").parquet(path)
        written = self.spark.read.schema(T.StructType([df.schema[self.key], T.StructField("period", T.StringType())])).parquet(path)
        text = F.col(self.key).cast("string")
        ends = written.groupBy("period").agg(F.min(text).alias("low"), F.max(text).alias("high"), F.count(self.key).alias("n"))
        periods, now = ends.orderBy("period").collect(), self.clock()
        if periods:
            filters = key_filters(written, self.key, "period", {r["period"]: r["n"] for r in periods})
            filters.write.parquet(f"{self.root}/keys/load={load}")
        return [Row(period=r["period"], load=load, loaded_at=now, low=r["low"], high=r["high"], buckets=buckets_for(r["n"])) for r in periods]

    def _rows(self, folders: list[Row], schema: T.StructType, *extra: str) -> DataFrame:
        full = T.StructType([*schema, T.StructField("period", T.StringType())])
        names = [*schema.names, *extra]
        if not folders:
            return self.spark.createDataFrame([], full).select(*names)
        paths = [f"{self.root}/data/load={f['load']}/period={f['period']}" for f in folders]
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*names)

    def _commit(
        self, state: Row | None, folders: list[Row], schema: T.StructType, batches: dict[str, int] | None = None
    ) -> DataFrame:
        number = 1 if state is None else state["commit"] + 1
        if batches is None and state is not None:
            batches = state["batches"]
        listed = [{**{c: f[c] for c in _PLACE}, "loaded_at": f["loaded_at"].isoformat()} for f in folders]
        text = json.dumps({"folders": listed, "table_schema": schema.json(), "batches": batches})
        write_new(self.spark, f"{self.root}/commits/{number:09d}.json", text)
        self._prune(number)
        return self._rows(folders, schema)

    def _prune(self, newest: int) -> None:
        """Drop commits that are no longer kept, and the folders that no kept one lists."""
        numbers = self._commits()
        dropped = [n for n in numbers if n <= newest - self.keep_commits]
        if not dropped:
            return
        listed, gone = ({(f["load"], f["period"]) for n in kept for f in self._state(n)["folders"]} for kept in ([n for n in numbers if n not in dropped], dropped))
        for load, period in gone - listed:
            delete_folder(self.spark, f"{self.root}/data/load={load}/period={period}")
        for n in dropped:
            delete_folder(self.spark, f"{self.root}/commits/{n:09d}.json")

    def _commits(self) -> list[int]:
        """Numbers of the commits, by a listing."""
        return sorted(int(n.removesuffix(".json")) for n in names_in(self.spark, f"{self.root}/commits") if n.endswith(".json"))

    def _state(self, number: int) -> Row:
        state = json.loads(read_small(self.spark, f"{self.root}/commits/{number:09d}.json"))
        folders = [Row(**{**f, "loaded_at": datetime.fromisoformat(f["loaded_at"])}) for f in state["folders"]]
        return Row(folders=folders, table_schema=state["table_schema"], batches=state["batches"], commit=number)

    def _newest(self) -> Row | None:
        number = self.version()
        return self._state(number) if number else None


def _schema(state: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(state["table_schema"]))
