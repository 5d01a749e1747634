"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Rows are written in ascending document order, one range of ids per file, so that stripes are read in parallel and a
search for an id skips files and stripes by their statistics and the Bloom filter. A row holds its place in its file; the
place in the whole corpus is that plus the sizes of the files before, one number per file.

Defined results: a null or empty text gives the end id alone; null ids come first; rows with equal ids follow each other
in text order; repeated rows are kept; other columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import documents, sliced
from kerbside.llm.tokens import encoder
from kerbside.session import materialise

OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
_BATCH = 256


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write (doc_id, part, part_start, n_tokens, ids) to ``path``."""
    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_column, part, place = encoder(tokenizer).column, TaskContext.get().partitionId(), 0
        for batch in sliced(batches):
            values, bounds = encode_column(batch.column("text"), end_id)
            starts = bounds[:-1]
            for at in range(0, batch.num_rows, _BATCH):
                low, high = bounds[at], bounds[min(at + _BATCH, batch.num_rows)]
                some = slice(at, at + _BATCH)
                inner = np.append(starts[some], high) - low
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, _BATCH),
                        pa.array(np.full(len(inner) - 1, part, np.int32)),
                        pa.array(place + starts[some]),
                        pa.array(np.diff(inner)),
                        pa.ListArray.from_arrays(pa.array(inner.astype(np.int32)), pa.array(values[low:high].astype(np.int32))),
                    ],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
            place += int(bounds[-1])

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = ordered.mapInArrow(encode, f"doc_id {id_type}, part int, part_start bigint, n_tokens bigint, ids array<int>")
    encoded.write.options(**OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before. Filters on doc_id reach the files."""
    stored = spark.read.orc(path)
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per file, written so that its size is known and the ids are not shuffled for it.
    parts = materialise(sizes.select("part", F.coalesce(before, F.lit(0)).alias("before")), "token-parts")
    return stored.join(parts, "part").select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, the checksum of the ids as little-endian unsigned 32-bit integers."""
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, offsets = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(crc, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
