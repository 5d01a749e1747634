"""Quality classifier by co-training: a view of the text and a view of the page's metadata teach each other.

The text view sees counts and ratios of the text, the metadata view the given columns and nothing of the text. Both are
logistic regressions on binned values. In each round either view scores all unlabelled documents in the cluster and labels
those it is surest of, one of each text, in the proportion of the classes; these join the other view's training rows. Each view is then calibrated on
labelled rows that it has not seen, and the calibrated views are added up (as log-odds, the prior counted once).

The models are fitted on bounded samples: per class the ``sample`` labelled rows whose ids hash lowest, and the surest labels,
at most a quarter of ``pool`` from either view, out of all unlabelled documents. Every document is scored whole. Defined results: null and empty texts have zero counts; null metadata is a
value of its own; ids labelled twice count as good only if all labels say so; null labels and ids are left out; without
both classes in the labels every score is 0; repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import logistic_regression
from kerbside.llm.quality_rules import STOP_WORDS
from kerbside.session import materialise

BINS = 16
META_BUCKETS = 1 << 12
_STOP = frozenset(w for listed in STOP_WORDS.values() for w in listed.split())
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKS = re.compile(r"[#*$%&|<>]")
_STATISTICS = 14


def text_statistics(text: str | None) -> list[float]:
    """Size, and shares of words, letters and lines that tell prose from junk."""
    text = text or ""
    own, letters = _WORD.findall(text), max(1, len(text))
    n, lines = max(1, len(own)), [x for x in text.split("\n") if not x.isspace() and x]
    kinds = Counter(own)
    capitals = sum(1 for w in own if len(w) > 1 and w[:-1].isupper())
    most = kinds.most_common(1)[0][1] if kinds else 0
    return [
        float(np.log1p(len(own))),
        sum(map(len, own)) / n,
        len(_MARKS.findall(text)) / n,
        sum(1 for w in own if w in _STOP) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        len(kinds) / n,
        most / n,
        capitals / n,
        text.count("!") / n,
        text.count("|") / n,
        (text.count(".") + text.count(",")) / n,
        sum(map(text.count, "0123456789")) / letters,
        len(lines) / n,
        max(map(len, own), default=0) / n,
    ]


def _meta(values: list) -> list[str]:
    """Features of the metadata: each value, numbers by their magnitude, and pairs of values."""
    single = []
    for i, v in enumerate(values):
        if isinstance(v, int | float) and not isinstance(v, bool):
            v = round(2 * float(np.log2(1 + abs(v))))
        single.append(f"{i}={v}")
    return single + [f"{a}&{b}" for i, a in enumerate(single) for b in single[:i]]


def _meta_columns(values: list) -> np.ndarray:
    return np.unique([zlib.crc32(x.encode("utf-8", "surrogatepass")) % META_BUCKETS for x in _meta(values)]).astype(np.int64)


class View:
    """A logistic regression on sets of columns, calibrated to probabilities."""

    def __init__(self, size: int, penalty: float = 1e-3) -> None:
        self.w, self.b, self.scale, self.shift = np.zeros(size), 0.0, 1.0, 0.0
        self._size, self._penalty = size, penalty

    def margin(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.asarray([self.w[r].sum() for r in rows]) + self.b

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        columns = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.w, self.b = logistic_regression(starts, columns, np.ones(len(columns)), labels, np.ones(len(rows)), self._size, self._penalty, steps=120)

    def calibrate(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        m = self.margin(rows)
        spread = float(m.std())
        if spread < 1e-6 or len(set(labels.tolist())) < 2:
            return
        n = len(rows)
        w, b = logistic_regression(np.arange(n + 1), np.zeros(n, np.int64), (m - m.mean()) / spread, labels, np.ones(n), 1, 1e-4, steps=300)
        self.scale = max(0.0, float(w[0])) / spread
        self.shift = b - self.scale * float(m.mean())

    def log_odds(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.clip(self.scale * self.margin(rows) + self.shift, -12, 12)


def _rounded(values: np.ndarray) -> np.ndarray:
    """Values to ten binary digits, so that their number does not grow with the rows."""
    return (np.asarray(values, "<f4").view("<u4") & np.uint32(0xFFFFE000)).view("<f4").astype(np.float64)


def _counts(statistics: np.ndarray) -> dict[tuple[int, float], int]:
    """How often each statistic has each rounded value."""
    out: dict[tuple[int, float], int] = {}
    for i in range(_STATISTICS):
        values, times = np.unique(_rounded(statistics[:, i]), return_counts=True)
        out.update(((i, float(v)), int(n)) for v, n in zip(values, times, strict=True))
    return out


def _cuts(counts: dict[tuple[int, float], int]) -> list[np.ndarray]:
    """Cuts between bins of like counts, for each statistic."""
    out = []
    for i in range(_STATISTICS):
        own = sorted((v, n) for (j, v), n in counts.items() if j == i)
        upto = np.cumsum([n for _, n in own])
        at = np.searchsorted(upto, np.linspace(0, 1, BINS + 1)[1:-1] * upto[-1])
        out.append(np.unique([own[k][0] for k in at]))
    return out


def _statistics(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, _STATISTICS)


class CoTrained:
    """Two calibrated views and the cuts of the text view's bins."""

    def __init__(self, statistics: np.ndarray, meta: list[list], labels: np.ndarray, cuts: list[np.ndarray], rounds: int, surest: Callable) -> None:
        """``labels``: 1 good, 0 bad. ``surest(model, view, taken)`` gives new rows (key, label, statistics, meta)."""
        self.cuts, self.views = cuts, [View(_STATISTICS * BINS), View(META_BUCKETS)]
        tests, train = np.arange(len(labels))[::5], np.setdiff1d(np.arange(len(labels)), np.arange(len(labels))[::5])
        self.prior = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
        sides = [self.text_columns(statistics), [_meta_columns(m) for m in meta]]
        taught = [([side[i] for i in train], list(labels[train])) for side in sides]
        taken: set[int] = set()
        for turn in range(rounds + 1):
            for view, side, (rows, given) in zip(self.views, sides, taught, strict=True):
                view.fit(rows, np.asarray(given, float))
                view.calibrate([side[i] for i in tests], labels[tests].astype(float))
            if turn == rounds:
                break
            for me in range(2):
                new = surest(self, me, taken)
                if new:
                    keys, given, values, metas = zip(*new, strict=True)
                    taken.update(keys)
                    taught[1 - me][0].extend([_meta_columns(m) for m in metas] if me == 0 else self.text_columns(np.asarray(values)))
                    taught[1 - me][1].extend(given)

    def log_odds(self, view: int, statistics: np.ndarray, meta: list[list]) -> np.ndarray:
        return self.views[view].log_odds([_meta_columns(m) for m in meta] if view else self.text_columns(statistics))

    def text_columns(self, statistics: np.ndarray) -> list[np.ndarray]:
        bins = np.stack([np.searchsorted(c, statistics[:, i], side="right") + i * BINS for i, c in enumerate(self.cuts)], axis=1)
        return list(bins)

    def scores(self, statistics: np.ndarray, meta: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability that a text is good, by both views together and by each."""
        text, page = (self.log_odds(view, statistics, meta) for view in range(2))
        both = text + page - np.log(self.prior / (1 - self.prior))
        return tuple(1 / (1 + np.exp(-x)) for x in (both, text, page))


def _meta_rows(batch: pa.RecordBatch, metas: list[str]) -> list[list]:
    return [list(m) for m in zip(*(batch.column(m).to_pylist() for m in metas), strict=True)] if metas else [[]] * batch.num_rows


def _pool_counts(pool: DataFrame) -> dict[tuple[int, float], int]:
    """``_counts`` over all rows of ``pool``; values are rounded, so their number is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, float]] = Counter()
        for batch in batches:
            if batch.num_rows:
                counts.update(_counts(_statistics(batch.column("statistics"))))
        which, values = [i for i, _ in counts], [v for _, v in counts]
        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(values, pa.float64()), pa.array(list(counts.values()), pa.int64())], ["i", "v", "n"])

    rows = pool.select("statistics").mapInArrow(run, "i int, v double, n bigint").groupBy("i", "v").agg(F.sum("n").alias("n"))
    return {(r["i"], r["v"]): r["n"] for r in rows.collect()}


def _surest(pool: DataFrame, metas: list[str], model: CoTrained, view: int, taken: set[int], most: tuple[int, int], limit: float) -> list[tuple]:
    """The rows of ``pool`` that a view is surest of, for each class at most ``most``, one of each text; all rows are scored.

    A task hands on its own surest texts only, as many as are wanted: the surest of all are among them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[int, tuple]] = [{}, {}]
        floor = [limit, limit]

        def prune(label: int) -> None:
            best = sorted(held[label].items(), key=lambda x: (-x[1][0], x[1][1]))[: most[label]]
            held[label] = dict(best)
            if len(best) == most[label]:
                floor[label] = best[-1][1][0]

        for batch in batches:
            if not batch.num_rows:
                continue
            odds = model.log_odds(view, _statistics(batch.column("statistics")), _meta_rows(batch, metas))
            keys, texts = batch.column("key").to_pylist(), batch.column("text_hash").to_pylist()
            for label, sure in ((0, -odds), (1, odds)):
                for i in np.flatnonzero(sure >= floor[label]).tolist():
                    if keys[i] not in taken:
                        was, new = held[label].get(texts[i]), (float(sure[i]), keys[i])
                        if was is None or (-new[0], new[1]) < (-was[0], was[1]):
                            held[label][texts[i]] = new
                if len(held[label]) > 2 * most[label] + 1000:
                    prune(label)
        for label in range(2):
            prune(label)
        out = [(label, text, sure, key) for label in range(2) for text, (sure, key) in held[label].items()]
        kinds = (pa.int32(), pa.int64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], k) for j, k in enumerate(kinds)], ["label", "text_hash", "sure", "key"])

    found = materialise(pool.mapInArrow(run, "label int, text_hash bigint, sure double, key bigint"), "surest")
    # One row of each text: the surest, of like ones that with the least key.
    found = found.groupBy("label", "text_hash").agg(F.min(F.struct((-F.col("sure")).alias("unsure"), "key")).alias("s")).select("label", "s.*")
    top = [r for label in range(2) for r in found.filter(F.col("label") == label).orderBy("unsure", "key").limit(most[label]).collect()]
    labels = {r["key"]: r["label"] for r in top}
    if not labels:
        return []
    rows = pool.filter(F.col("key").isin(list(labels))).dropDuplicates(["key"]).orderBy("key").collect()  # at most ``most`` of each class
    return [(r["key"], labels[r["key"]], np.frombuffer(bytes(r["statistics"]), "<f8"), [r[m] for m in metas]) for r in rows]


def quality_classifier(
    df: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    meta_cols: tuple[str, ...] = ("lang", "source", "n_chars"),
    sample: int = 8000,
    pool: int = 16000,
    rounds: int = 6,
    sure: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """Per row of ``df``: doc_id, score, text_score, meta_score, predicted; labels are learnt where ``train`` holds."""
    number = [F.col(c).cast("double") if dict(df.dtypes)[c] in ("bigint", "int", "smallint", "tinyint", "float", "double") else F.col(c).cast("string") for c in meta_cols]
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[c.alias(f"m{i}") for i, c in enumerate(number)])
    metas = [f"m{i}" for i in range(len(meta_cols))]
    rows = labels.filter(train) if train is not None else labels
    rows = rows.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.min("label").alias("label"))
    lowest = lambda x, n: x.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = materialise(lowest(known.filter("label = 0"), sample).unionByName(lowest(known.filter("label = 1"), sample)), "quality-sample")

    id_type = docs.schema["doc_id"].dataType.simpleString()
    types = "".join(f", {m} {docs.schema[m].dataType.simpleString()}" for m in metas)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([np.asarray(text_statistics(t.as_py()), "<f8").tobytes() for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), values, *[batch.column(m) for m in metas]], ["doc_id", "text_hash", "statistics", *metas])

    described = docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(describe, f"doc_id {id_type}, text_hash bigint, statistics binary{types}")
    described = materialise(described, "text-statistics")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text_hash", "statistics", *metas))
    sampled = described.join(chosen, "doc_id").withColumn("nth", first).filter("nth = 1")  # one row of each id, whatever repeats
    sampled = sampled.select("label", "statistics", *metas).toPandas()  # at most 2 * sample short rows
    label = sampled["label"].to_numpy()
    model = None
    if (label == 0).sum() > 4 and (label == 1).sum() > 4:
        order = np.lexsort([*(sampled[m].astype(str).to_numpy() for m in metas), [zlib.crc32(bytes(s)) for s in sampled["statistics"]]])
        sampled, label = sampled.iloc[order], label[order]  # the same model whatever the order of rows
        statistics = np.stack([np.frombuffer(bytes(s), "<f8") for s in sampled["statistics"]])
        # All unlabelled documents; rows equal in text and metadata teach the same and count once.
        marked = labels.select(F.col(label_id_col).alias("doc_id")).distinct()
        unlabelled = described.filter("doc_id is not null").distinct().join(marked, "doc_id", "left_anti").drop("doc_id").distinct()
        unlabelled = materialise(unlabelled.withColumn("key", F.xxhash64("text_hash", *[F.coalesce(F.col(m).cast("string"), F.lit("\0")) for m in metas])), "unlabelled")
        step = max(1, min(pool, unlabelled.count()) // (4 * max(1, rounds)))
        prior = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
        most = tuple(max(1, round(step * x)) for x in (1 - prior, prior))
        surest = lambda model, view, taken: _surest(unlabelled, metas, model, view, taken, most, float(np.log(sure / (1 - sure))))
        cuts = _cuts(Counter(_pool_counts(unlabelled)) + Counter(_counts(statistics)))
        meta = sampled[metas].astype(object).where(sampled[metas].notna(), None).values.tolist()
        model = CoTrained(statistics, meta, label, cuts, rounds, surest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = (np.zeros(batch.num_rows),) * 3
            if model is not None:
                out = model.scores(_statistics(batch.column("statistics")), _meta_rows(batch, metas))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, out), pa.array((out[0] >= 0.5).astype(np.int32))],
                ["doc_id", "score", "text_score", "meta_score", "predicted"],
            )

    return described.mapInArrow(score, f"doc_id {id_type}, score double, text_score double, meta_score double, predicted int")
