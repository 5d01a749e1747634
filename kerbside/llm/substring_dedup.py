"""Substring dedup: words inside long passages that also stand in an earlier document are removed.

Reference text that may matter is found first: of every window of ``size`` words the least of its short word runs, rare
ones before frequent ones (a sketch of fixed size over all documents), is its anchor. Equal windows have equal anchors,
so text whose anchors stand in one document only is out. The windows around one anchor form a segment of fewer than two
windows' length; distinct segments are the reference text, each with the first document that holds it.

The reference is cut into shards by anchor. A shard becomes a suffix automaton whose states know the first document of
their text, and the segments of documents that have the shard's anchors are streamed through it: where the matching
statistic reaches ``size`` words, the state of the last ``size`` words tells the first document with this window. Shards
are sent by key to the segments that need them, not to all tasks, since all shards together grow with the corpus; the
shards of an anchor with very many segments are split and each gets all segments of that anchor.

Documents are judged on the input, not on what is left. Defined results: null and empty texts have no words; documents
with equal ids do not remove from each other; rows without an id are kept whole and remove nothing; repeated rows are
returned each; other columns are never read; an empty table gives no rows. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import documents, mix, summed_vector, vector_rows, window_hashes, with_row_key, word_hashes, words
from kerbside.session import materialise

SKETCH = 1 << 20
RUN = 8  # words of an anchor
SHARD_WORDS = 150_000
SEGMENTS = 1000  # segments of one anchor in a shard
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class SuffixAutomaton:
    """All substrings of the added sequences, with the first document of each."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [2**63 - 1]

    def _state(self, length: int, moves: dict[int, int], first: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.first.append(first)
        self.link.append(0)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), 2**63 - 1)
        self.link[clone], self.link[q] = self.link[q], clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], document: int) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
            else:
                now, p = self._state(self.length[last] + 1, {}, 2**63 - 1), last
                while p != -1 and c not in self.next[p]:
                    self.next[p][c] = now
                    p = self.link[p]
                if p != -1:
                    q = self.next[p][c]
                    self.link[now] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
                last = now
            if document < self.first[last]:
                self.first[last] = document

    def finish(self) -> None:
        """Hand the first documents down the suffix links, longest texts first."""
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.first[v] < self.first[self.link[v]]:
                self.first[self.link[v]] = self.first[v]

    def firsts(self, sequence: list[int], size: int) -> list[int]:
        """For every window of the sequence the first document that holds it, or the largest integer."""
        out, v, matched = [], 0, 0
        for i, c in enumerate(sequence):
            while v and c not in self.next[v]:
                v = self.link[v]
                matched = self.length[v]
            if c in self.next[v]:
                v, matched = self.next[v][c], matched + 1
            if i >= size - 1:
                if matched >= size:
                    u = v
                    while self.length[self.link[u]] >= size:
                        u = self.link[u]
                    out.append(self.first[u])
                else:
                    out.append(2**63 - 1)
        return out


def segments(runs: np.ndarray, counts: np.ndarray, background: float, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor place, first window, last window) of the segments of a text, from the hashes of its word runs."""
    width = size - RUN + 1
    if len(runs) < width:
        return (np.empty(0, np.int64),) * 3
    load = np.maximum(counts[(runs >> np.uint64(44)).astype(np.int64)] - background, 1)
    keys = (np.log2(load).astype(np.uint64) << np.uint64(58)) | (mix(runs) >> np.uint64(6))
    least, span = np.arange(len(runs)), 1
    while span < width:  # place of the leftmost least key among ``span`` runs, doubled
        step = min(span, width - span)
        a, b = least[: len(least) - step], least[step:]
        least = np.where(keys[b] < keys[a], b, a)
        span += step
    starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[starts], starts, np.concatenate((starts[1:], [len(least)])) - 1


def _sketch(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for hashes in word_hashes(batch.column("text")):
                slots = (window_hashes(hashes, RUN) >> np.uint64(44)).astype(np.int64)
                np.add.at(sketch, slots, 1)
        rows = vector_rows(sketch)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "payload"])

    return docs.mapInArrow(run, "chunk int, payload binary")


def _anchors(docs: DataFrame, counts: np.ndarray, background: float, size: int) -> DataFrame:
    """(anchor, doc_id, row_key, start, length, segment): every segment of every document, by place and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = [], []
            for i, own in enumerate(word_hashes(batch.column("text"))):
                runs = window_hashes(own, RUN)
                at, first, last = segments(runs, counts, background, size)
                if not len(at):
                    continue
                length = last - first + size
                # The hash of a segment: its words' hashes weighted by powers of their place, from sums over the text.
                weights = np.cumprod(np.full(len(own), _BASE, np.uint64))
                back = np.cumprod(np.full(len(own) + 1, _INVERSE, np.uint64))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(own) * weights, dtype=np.uint64)))
                segment = mix((sums[first + length] - sums[first]) * back[first] ^ length.astype(np.uint64))
                rows.append(np.full(len(at), i))
                parts.append((runs[at].view(np.int64), first, length, segment.view(np.int64)))
            if rows:
                take = pa.array(np.concatenate(rows))
                anchor, first, length, segment = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [anchor, batch.column("doc_id").take(take), batch.column("row_key").take(take), first.cast(pa.int32()), length.cast(pa.int32()), segment],
                    ["anchor", "doc_id", "row_key", "start", "length", "segment"],
                )

    return docs.mapInArrow(run, "anchor bigint, doc_id bigint, row_key bigint, start int, length int, segment bigint")


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, segment, doc_id, words): the text of wanted segments, read from the first document that holds each."""
    lists = wanted.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("anchor", "segment", "start", "length")).alias("cuts"))
    rows = docs.join(lists, ["doc_id", "row_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, cuts in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("cuts").to_pylist(), strict=True):
                own = words(text.as_py())
                out += [(c["anchor"], c["segment"], doc, b" ".join(own[c["start"] : c["start"] + c["length"]]).decode()) for c in cuts]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], ["anchor", "segment", "doc_id", "words"])

    return rows.select("doc_id", "text", "cuts").mapInArrow(run, "anchor bigint, segment bigint, doc_id bigint, words string")


def _matches(cuts: DataFrame, size: int) -> DataFrame:
    """(anchor, segment, low, high, first): windows low..high of a segment stand first in document ``first``."""
    total = cuts.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    many = cuts.groupBy("anchor").agg(F.ceil(F.count("*") / SEGMENTS).cast("int").alias("pieces"))
    held = cuts.join(many, "anchor").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    # An anchor of very many segments: each piece of its reference is a shard of its own and is streamed by all segments.
    piece = F.pmod(F.xxhash64("segment"), F.col("pieces"))
    held = held.withColumn("own", F.when(F.col("pieces") > 1, piece).otherwise(F.lit(0)))
    held = held.withColumn("alone", F.when(F.col("pieces") > 1, F.col("anchor")).otherwise(F.lit(0)))
    held = held.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces").cast("bigint") - 1)))
    held = held.select("shard", "alone", "piece", (F.col("piece") == F.col("own")).alias("reference"), "anchor", "segment", "doc_id", "words")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        symbols: dict[str, int] = {}
        texts = [[symbols.setdefault(w, len(symbols)) for w in t.split(" ")] for t in frame["words"]]
        automaton = SuffixAutomaton()
        for text, doc, reference in zip(texts, frame["doc_id"], frame["reference"], strict=True):
            if reference:
                automaton.add(text, doc)
        automaton.finish()
        out = []
        for anchor, segment, text in zip(frame["anchor"], frame["segment"], texts, strict=True):
            firsts = np.asarray(automaton.firsts(text, size))
            cut = np.flatnonzero(np.concatenate(([True], firsts[1:] != firsts[:-1], [True])))
            out += [(anchor, segment, a, b - 1, firsts[a]) for a, b in zip(cut[:-1], cut[1:], strict=True) if firsts[a] < 2**63 - 1]
        return pd.DataFrame(out, columns=["anchor", "segment", "low", "high", "first"])

    return held.groupBy("shard", "alone", "piece").applyInPandas(run, "anchor bigint, segment bigint, low int, high int, first bigint")


def remove_repeats(df: DataFrame, size: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and with ``with_text`` the kept words."""
    docs = with_row_key(documents(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint")))
    counts = summed_vector(_sketch(docs.select("text")), SKETCH).astype(np.int32)
    background = float(np.median(counts)) + 6 * float(np.sqrt(np.median(counts))) + 2
    anchors = materialise(_anchors(docs.filter("doc_id is not null"), counts, background, size), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    # Written first, so that the join is a stage of its own and Spark can split an anchor with very many rows.
    shared = materialise(shared.select("anchor"), "anchors-shared")
    anchors = materialise(anchors.join(shared, "anchor", "left_semi"), "shared-anchors")
    wanted = anchors.groupBy("anchor", "segment").agg(F.min(F.struct("doc_id", "row_key", "start", "length")).alias("at"))
    cuts = materialise(_cut(docs, wanted.select("anchor", "segment", "at.*")), "segments")
    matches = materialise(_matches(cuts, size), "matches")

    covered = anchors.join(matches, ["anchor", "segment"]).filter(F.col("first") < F.col("doc_id"))
    span = F.struct((F.col("start") + F.col("low")).alias("a"), (F.col("start") + F.col("high") + size).alias("b"))
    spans = covered.groupBy(F.col("doc_id").alias("of"), F.col("row_key").alias("of_key")).agg(F.collect_set(span).alias("spans"))
    spans = materialise(spans, "spans")
    rows = docs.join(spans, (F.col("row_key") == F.col("of_key")) & (F.col("doc_id") == F.col("of")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, digests, texts = [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                own = words(text.as_py())
                sizes.append(len(own))
                if found:
                    change = np.zeros(len(own) + 1, np.int64)
                    for s in found:
                        change[s["a"]] += 1
                        change[s["b"]] -= 1
                    keep = np.cumsum(change)[:-1] == 0
                    own = [w for w, k in zip(own, keep.tolist(), strict=True) if k]
                removed.append(sizes[-1] - len(own))
                kept = b" ".join(own)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else "")
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else "")
    return rows.mapInArrow(run, schema)
