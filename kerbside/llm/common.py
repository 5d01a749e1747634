"""Helpers the operators share: words, text columns, hashing of word sequences, small sketches."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[\x20\x09-\x0D]+"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """``words`` after A-Z is lower-cased; other letters stay."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all other characters unchanged; ASCII texts take the faster function."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


@cache
def _heap_trim() -> Callable[[int], int] | None:
    """glibc's ``malloc_trim``; None where the C library has none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system. A worker lives on after its task, and what its allocators keep would stay with it
    while other tasks and the JVM need it."""
    pa.default_memory_pool().release_unused()
    if trim := _heap_trim():
        trim(0)


def sliced(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``size`` bytes, one row at least, so that a task holds few texts at a time.
    After the last one the task's freed memory is given back."""
    for batch in batches:
        yield from _cut(batch, size)
    give_back()


def _cut(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    step = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        if part.num_rows > 1 and part.nbytes > 2 * size:  # a few long texts among short ones
            yield from _cut(part, size)
        else:
            yield part
    if not batch.num_rows:
        yield batch


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Within it, a batch that Spark hands to Python has about ``size`` bytes, so that neither side of a task holds the 10,000
    texts of a usual batch. For actions only: a query is bound to its batches when it runs."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def word_array(text: Column, blanks: str = BLANKS) -> Column:
    """The words of a text as an array; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), blanks), "")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text alone, under fixed names, so that no other column of the table can clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds ``row_key``: equal for rows equal in id and text, which have equal results."""
    return docs.withColumn("row_key", F.xxhash64("doc_id", "text"))


def crc32_mod(id_col: str, by: int = 5) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % by


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_VALUES = np.random.default_rng(0x5EED).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
_SLICE = 1 << 20


def _hash_bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie behind each other, and the number of words before each bound."""
    inside = ~_SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begin[inner] = inside[inner]
    end[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    # The words' bytes alone, each with its place in its word; a hash is the sum of byte values weighted by place.
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _VALUES[data[inside]] * _POWERS[place & 4095]
    if lengths.max() > 4096:
        values = values * (2 * (place >> 12) + 1).astype(np.uint64)
    hashes = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix(hashes + lengths.astype(np.uint64)), np.searchsorted(starts, bounds)


def word_hashes(texts: pa.Array, lower: bool = False) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words (``words``, or ``lower_words``), in order; null has none.

    Computed on the bytes of the column, about a megabyte at a time, without making strings.
    """
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, side="right")) - 1)
        block = data[offsets[at] : offsets[upto]]
        block = _FOLD[block] if lower else block
        if len(block) <= _SLICE:
            hashes, before = _hash_bytes(block, offsets[at : upto + 1] - offsets[at])
            for i in range(upto - at):
                yield hashes[before[i] : before[i + 1]]
        else:  # one long text, cut at white space
            parts, low = [], 0
            while low < len(block):
                high = low + _SLICE
                while high < len(block) and not _SPACE[block[high]]:
                    high += 1
                parts.append(_hash_bytes(block[low:high], np.zeros(1, np.int64))[0])
                low = high
            yield np.concatenate(parts)
        at = upto


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on every bit of its input."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive words, in order; empty when there are fewer words."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = (out + hashes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle, one without words has none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes, min(size, len(hashes))))


_CHUNK = 1 << 14


def vector_rows(vector: np.ndarray) -> list[tuple[int, bytes]]:
    """A vector of 32-bit counts as (chunk, compressed bytes) rows, chunks without counts left out."""
    chunks = vector.astype("<i4").reshape(-1, _CHUNK)
    return [(int(i), zlib.compress(chunks[i].tobytes(), 1)) for i in np.flatnonzero(chunks.any(axis=1))]


def _add_chunks(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_CHUNK, np.int64)
    for payload in frame["payload"]:
        total += np.frombuffer(zlib.decompress(payload), "<i4")
    payload = zlib.compress(np.minimum(total, 2**31 - 1).astype("<i4").tobytes(), 1)
    return pd.DataFrame({"chunk": [int(frame["chunk"].iloc[0])], "payload": [payload]})


def summed_vector(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the vectors in ``rows`` (chunk, payload); ``size`` is fixed, so is what the driver receives.

    Chunks are added in two steps, first those of 16 groups of tasks each, so that no task gets a chunk from every task.
    """
    parts = rows.withColumn("_group", F.spark_partition_id() % 16)
    parts = parts.groupBy("chunk", "_group").applyInPandas(_add_chunks, "chunk int, payload binary")
    out = np.zeros(size, np.int64)
    for chunk, payload in parts.groupBy("chunk").applyInPandas(_add_chunks, "chunk int, payload binary").collect():
        out[chunk * _CHUNK : (chunk + 1) * _CHUNK] = np.frombuffer(zlib.decompress(bytes(payload)), "<i4")
    return out


def logistic_regression(
    starts: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, weights: np.ndarray, size: int, penalty: float, steps: int = 200, rate: float = 0.1
) -> tuple[np.ndarray, float]:
    """Weights and bias of a sparse, row-compressed logistic regression with ridge penalty, by Adam on all rows."""
    row = np.repeat(np.arange(len(labels)), np.diff(starts))
    w, b = np.zeros(size), float(np.log((weights * labels).sum() + 1) - np.log((weights * (1 - labels)).sum() + 1))
    m, v, mb, vb, total = np.zeros(size), np.zeros(size), 0.0, 0.0, weights.sum()
    for t in range(1, steps + 1):
        margin = np.bincount(row, values * w[columns], len(labels)) + b
        error = weights * (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels) / total
        g, gb = np.bincount(columns, values * error[row], size) + penalty * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = rate * (1 - 0.9 * t / steps)
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b
