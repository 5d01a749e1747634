"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams it holds, hashed to a fixed number of buckets. Buckets whose document counts
differ clearly between the classes are kept, each has the value log(share in toxic / share in other texts), and a
logistic regression learns their weights. Only the text is an input of a score.

The model is fitted on a bounded sample of labelled rows: per class the ``sample`` ids that hash lowest, each with one of
its texts. All texts are scored whole, very long ones too. Defined results: null and empty texts have no features and get the prior; ids labelled twice count as
toxic if one label says so; null labels and ids are left out; without both classes in the labels every score is 0;
repeated rows are scored each; other columns are never read;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import documents, logistic_regression, sliced, summed_vector, vector_rows
from kerbside.session import materialise

ORDERS = (3, 4, 5, 6)
BITS = 21


def ngrams(text: str | None, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> np.ndarray:
    """Buckets of all character n-grams of the lower-cased text, white space as one blank, in any order."""
    if not text:
        return np.empty(0, np.int64)
    letters = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    hashed, out = letters + np.uint64(1), []
    for n in range(2, max(orders) + 1):
        if len(letters) < n:
            break
        hashed = hashed[:-1] * np.uint64(0x100000001B3) + letters[n - 1 :] + np.uint64(n)
        if n in orders:
            out.append(((hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


@dataclass
class Model:
    """Kept buckets and their weights, with the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self, bits: int = BITS) -> np.ndarray:
        out = np.zeros(1 << bits, np.float32)
        out[self.buckets] = self.weights
        return out


def _sample(labels: DataFrame, rows: int) -> DataFrame:
    """Per class the rows whose ids hash lowest."""
    parts = [labels.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8000, least_z: float = 4.0, least_ratio: float = 0.5, penalty: float = 1e-6) -> Model | None:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1); None without both classes."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = materialise(_sample(known, sample), "toxicity-sample")
    # One text of each chosen id, that of the least hash, so that at most 2 * sample rows are learnt from whatever repeats.
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    one = docs.join(chosen, "doc_id").withColumn("nth", first).filter("nth = 1")
    texts = materialise(one.select(F.col("label").cast("int").alias("label"), "text"), "toxicity-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last two slots count the texts of each class.
        counts = np.zeros(2 * (1 << BITS) + (1 << 14), np.int64)
        for batch in sliced(batches):
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts[np.unique(ngrams(text)) + label * (1 << BITS)] += 1
                counts[2 * (1 << BITS) + label] += 1
        rows = vector_rows(counts)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "payload"])

    counted = summed_vector(texts.mapInArrow(count, "chunk int, payload binary"), 2 * (1 << BITS) + (1 << 14))
    n = counted[2 << BITS : (2 << BITS) + 2].astype(float)
    if not n.all():
        return None
    without, having = counted[: 1 << BITS], counted[1 << BITS : 2 << BITS]
    share, pooled = having / n[1] - without / n[0], (having + without) / n.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        z = share / np.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]))
    ratio = np.log((having + 1) / (n[1] + 2)) - np.log((without + 1) / (n[0] + 2))
    kept = np.flatnonzero((np.abs(np.nan_to_num(z)) >= least_z) & (np.abs(ratio) >= least_ratio) & (having + without >= 5))
    ratio = ratio[kept]
    position = np.full(1 << BITS, -1, np.int32)
    position[kept] = np.arange(len(kept))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [position[np.unique(ngrams(text))] for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([f[f >= 0].astype("<i4").tobytes() for f in found], pa.binary())], ["label", "features"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, features = [], []
        for batch in sliced(batches):
            labels += batch.column("label").to_pylist()
            features += [np.frombuffer(f, "<i4") for f in batch.column("features").to_pylist()]
        if not labels:
            return
        y = np.asarray(labels, float)
        starts = np.concatenate(([0], np.cumsum([len(f) for f in features])))
        columns = np.concatenate([*features, np.empty(0, np.int32)]).astype(np.int64)
        # Rows weigh as much as the labelled rows of their class that they stand for.
        weights = np.where(y == 1, sizes.get(1, 0) / n[1], sizes.get(0, 0) / n[0])
        w, b = logistic_regression(starts, columns, ratio[columns], y, weights, len(ratio), penalty)
        yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f8").tobytes()], pa.binary()), pa.array([float(b)])], ["w", "b"])

    selected = texts.mapInArrow(select, "label int, features binary")
    learned = selected.repartition(1).mapInArrow(learn, "w binary, b double").collect()  # at most 2 * sample short rows
    return Model(kept, np.frombuffer(bytes(learned[0]["w"]), "<f8") * ratio, learned[0]["b"])


def _scores(texts: pa.Array, model: Model | None, table: np.ndarray | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    margins = np.full(len(texts), model.bias)
    for i, text in enumerate(texts):
        buckets = ngrams(text.as_py())
        hit = np.unique(buckets[table[buckets] != 0])
        margins[i] += table[hit].sum(dtype=np.float64)
    return 1 / (1 + np.exp(-np.clip(margins, -700, 700)))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table() if model else None
        for batch in sliced(batches):
            scores = _scores(batch.column("text"), model, table)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return docs.mapInArrow(apply, f"doc_id {id_type}, score double, predicted int")


def without_toxic(df: DataFrame, labels: DataFrame, sample: int = 8000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted to be toxic, with all their columns; learns from all ``labels``."""
    rows = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("label"))
    model, at = fit(documents(df, id_col, text_col), rows, sample), df.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table() if model else None
        for batch in sliced(batches):
            yield batch.filter(pa.array(_scores(batch.column(at), model, table) < 0.5))

    return df.mapInArrow(keep, df.schema)


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    sample: int = 8000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "toxic",
) -> DataFrame:
    """Score every row of ``df``; labels are learnt from rows of ``labels`` for which ``train`` holds."""
    docs = documents(df, id_col, text_col)
    rows = labels.filter(train) if train is not None else labels
    rows = rows.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    return score(docs, fit(docs, rows, sample))
