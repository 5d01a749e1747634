"""LM scoring: documents get the log-probability of a recurrent language model trained on the corpus itself.

Token counts cover all training documents. The most frequent words are the model's vocabulary; all others are one unknown
token, whose probability is shared among them by their counts, so that the model is a distribution over all texts. Training
is data-parallel: the training documents are dealt into parts by hashed id, and each part is one round, in which every task
trains a copy of the weights on its documents and the copies are averaged by their tokens; the rounds cover all parts. Words
outside the bounded ``dictionary`` that tasks hold in memory get their counts by a join, so no count is left out. Texts are encoded once and written by part, so that a round reads its part alone.

Defined results: null and empty texts are the end token alone; without training documents the score is the base score;
repeated rows are scored each; a null id counts as the empty text for the folds; a row whose ``train`` is null is not learnt
from; other columns are never read; a very long text is scored whole, a window at a time; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm import language_model as lm
from kerbside.llm.common import documents, lower_words, sliced
from kerbside.session import materialise, scratch_path

END = b"\n"  # not a word: words hold no white space
LN10 = float(np.log(10))
_CHUNK = 1 << 14


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all tokens of ``docs`` (text), each task counting its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column("text"):
                counts.update(lower_words(text.as_py()))
                counts[END] += 1
                if len(counts) > 400_000:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Dictionary:
    """Ids of the most frequent words by falling frequency, the end token first; the first ``vocabulary`` are the model's."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, vocabulary: int) -> None:
        self.ids = {w: i for i, w in enumerate(words)}
        self.counts = np.asarray([*counts, 0], np.float64)  # the last id is that of all other words
        self.total, self.distinct, self.unknown = total, distinct, min(vocabulary, len(words) + 1) - 1
        inside = float(self.counts[: self.unknown].sum())
        self.outside, self.outside_words = total - inside, distinct - self.unknown
        self.base = np.log10((self.counts + 0.5) / (total + 0.5 * (distinct + 1)))
        # log10 of a word's share of the unknown token
        self.share = np.log10((self.counts + 0.5) / (self.outside + 0.5 * (self.outside_words + 1)))
        self.share[: self.unknown] = 0

    @property
    def frequency(self) -> np.ndarray:
        """Counts of the model's tokens, the unknown one last."""
        return np.concatenate([self.counts[: self.unknown], [self.outside]]) + 0.5

    def encode(self, words: list[bytes]) -> np.ndarray:
        """Ids of the words and the end token; words outside have the last id."""
        ids, other = self.ids, len(self.ids)
        out = np.fromiter((ids.get(w, other) for w in words), np.int64, len(words))
        return np.append(out, ids.get(END, other))


def _mean_rows(frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in frame["payload"])
    return pd.DataFrame({"chunk": [int(frame["chunk"].iloc[0])], "payload": [total.astype("<f4").tobytes()]})


def _encode(docs: DataFrame, words: Dictionary) -> DataFrame:
    """(row, doc_id, part, ids, rare) of ``docs`` (doc_id, text, part): ids of the words and the end token, and how often
    words outside the dictionary occur. Written once, one folder for each part."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {id_type}, part int, ids array<int>, rare array<struct<word: string, times: bigint>>"
    kind = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, other = TaskContext.get().partitionId() << 40, len(words.ids)
        for batch in sliced(batches):
            tokens = [lower_words(t) for t in batch.column("text").to_pylist()]
            encoded = [words.encode(t) for t in tokens]
            rare = [[{"word": w.decode(), "times": n} for w, n in Counter(w for w in t if w not in words.ids).items()] if (e == other).any() else [] for t, e in zip(tokens, encoded, strict=True)]
            rows = np.arange(number, number + len(tokens))
            number += len(tokens)
            ids = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, encoded)]).astype(np.int32)),
                pa.array(np.concatenate([np.empty(0, np.int64), *encoded]).astype(np.int32)),
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), batch.column("doc_id"), batch.column("part"), ids, pa.array(rare, kind)], ["row", "doc_id", "part", "ids", "rare"]
            )

    path = scratch_path(docs.sparkSession, "lm-encoded")
    docs.mapInArrow(run, schema).write.partitionBy("part").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _id_arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The arrays of column ``ids``."""
    ids = batch.column("ids")
    values, at = ids.values.to_numpy(), ids.offsets.to_numpy()
    return [values[a:b].astype(np.int64) for a, b in zip(at[:-1], at[1:], strict=True)]


def _train_round(encoded: DataFrame, words: Dictionary, p: lm.Parameters) -> lm.Parameters:
    """Every task trains ``p`` on its documents; the copies are averaged by tokens, in two steps of a shuffle by chunk."""
    names, unknown = sorted(p), words.unknown

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, held, size = lm.Trainer(p), [], 0
        for batch in sliced(batches):
            for ids in _id_arrays(batch):
                held.append(np.minimum(ids, unknown))
                size += len(ids)
                if size > 200_000:
                    trainer.learn(held, 0)
                    held, size = [], 0
        if held:
            trainer.learn(held, 0)
        if trainer.tokens:
            flat = np.concatenate([*(trainer.p[k].reshape(-1) for k in names), np.ones(1, np.float32)]).astype(np.float64) * trainer.tokens
            parts = [flat[i : i + _CHUNK].astype("<f4").tobytes() for i in range(0, len(flat), _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "payload"])

    rows = encoded.select("ids").mapInArrow(run, "chunk int, payload binary").withColumn("group", F.spark_partition_id() % 32)
    rows = rows.groupBy("chunk", "group").applyInPandas(_mean_rows, "chunk int, payload binary")
    rows = rows.groupBy("chunk").applyInPandas(_mean_rows, "chunk int, payload binary").orderBy("chunk").collect()  # the weights
    if not rows:
        return p
    flat = np.concatenate([np.frombuffer(bytes(r["payload"]), "<f4") for r in rows])
    flat, at, out = flat[:-1] / flat[-1], 0, {}
    for k in names:
        out[k] = flat[at : at + p[k].size].reshape(p[k].shape).astype(np.float32)
        at += p[k].size
    return out


def lm_scores(
    df: DataFrame,
    train: Column | None = None,
    vocabulary: int = 4096,
    dictionary: int = 200_000,
    hidden: int = 32,
    share: int = 8,
    rounds: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10); learns from rows for which ``train`` holds.

    Counts cover all training rows. So do the weights: they are averaged after each of ``share`` parts of the rows, dealt by
    hashed id, and every row is learnt from ``rounds`` times.
    """
    learns = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    part = F.when(learns, F.pmod(F.xxhash64(F.col(id_col), F.lit("training")), F.lit(share))).otherwise(-1).cast("int")
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), part.alias("part"))
    learned = documents(df.filter(learns), id_col, text_col)
    counts = materialise(token_counts(learned), "token-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Chosen in the cluster and written; the driver gets the dictionary alone, not the candidates of every task.
    frequent = counts.filter((F.col("word") != END.decode()) & (F.col("n") > 1)).orderBy(F.desc("n"), "word")
    top = materialise(frequent.limit(dictionary - 1), "dictionary").orderBy(F.desc("n"), "word").collect()
    ends = counts.filter(F.col("word") == END.decode()).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = Dictionary([END, *(r["word"].encode() for r in top)], [ends, *(r["n"] for r in top)], total, distinct, vocabulary)

    encoded = _encode(docs, words)

    weights = None
    if total:
        weights = lm.initial(words.frequency, hidden, max(2, round(len(words.frequency) ** 0.5)))
        for i in range(rounds * share):
            weights = _train_round(encoded.filter(F.col("part") == i % share), words, weights)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    # What the scores need of the dictionary: three numbers for each of its words. Words outside are added by the join below.
    model, known, unknown = weights, words.counts > 0, words.unknown
    known[-1] = False
    base_of, share_of = words.base.copy(), words.share.copy()
    base_of[-1] = share_of[-1] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_tokens", "n_known", "base_score", "score"]
        for batch in sliced(batches):
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                ids = _id_arrays(some)
                if model is None:
                    scores = np.zeros(len(ids))
                else:
                    scores = lm.score(model, [np.minimum(e, unknown) for e in ids], 0) / LN10 + [share_of[e].sum() for e in ids]
                numbers = [[len(e) for e in ids], [int(known[e].sum()) for e in ids]]
                sums = [np.asarray([base_of[e].sum() for e in ids], np.float64), np.asarray(scores, np.float64)]
                columns = [some.column("row"), some.column("doc_id"), *(pa.array(x, pa.int64()) for x in numbers), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"row bigint, doc_id {id_type}, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = materialise(encoded.select("row", "doc_id", "ids").mapInArrow(run, schema), "lm-scores")
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times").join(counts, "word", "left")
    n = F.coalesce(F.col("n"), F.lit(0)) + 0.5
    base = F.log10(n / F.lit(float(total + 0.5 * (distinct + 1))))
    own = F.log10(n / F.lit(float(words.outside + 0.5 * (words.outside_words + 1))))
    rare = rare.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * base).alias("rare_base"),
        F.sum(F.col("times") * own).alias("rare_score"),
    )
    out = scored.join(rare, F.col("row") == F.col("of"), "left")
    plus = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    base_score = plus("base_score", "rare_base")
    return out.select(
        "doc_id",
        "n_tokens",
        plus("n_known", "rare_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base_score.alias("base_score"),
        (plus("score", "rare_score") if weights is not None else base_score).alias("score"),
    )
