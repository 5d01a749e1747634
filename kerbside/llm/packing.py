"""Best-fit packing of token sequences by bin completion.

Only the lengths of pieces decide a packing, and there are at most ``capacity`` of them: Spark counts the pieces of each
length, the search works on that histogram (its size is bounded by the capacity, not by the corpus), and the resulting
patterns, each used a number of times, are dealt out to the pieces by their rank among those of equal length. Ranks come
from counts per write task, so that a length which holds a third of all pieces is never gathered in one place.

The search follows bin completion: take the largest length left, enumerate fillings of the rest of its sequence, leave
out dominated ones (two pieces where one unused piece of their sum would do), start from the best-fit filling as
incumbent and stop at a filling without waste. Using each filling as often as the counts allow gives the first packing.
Unless it meets the lower bound, branch and bound over whole packings follows at every size: a branch is a filling and the
times it is used, and it is cut off where the lower bound of the pieces left reaches the incumbent. The search takes the
branches with the fewest departures from the first choice first and ends after ``_NODES`` nodes, which is a bound by number
of nodes alone, not of pieces.

Defined results: a null or empty text is one piece, the end id; repeated rows are packed each; other columns are never
read; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import documents, sliced, small_batches
from kerbside.llm.tokens import encoder
from kerbside.session import materialise

Pattern = tuple[tuple[int, ...], int]
_NODES = 4000
_KNOWN = 300_000  # pieces of text that a worker remembers: a pipeline's executor has little memory left for them


def _completions(counts: np.ndarray, room: int, largest: int, nodes: int, most: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` by lengths up to ``largest``, least waste first; ends at ``most`` without waste."""
    sizes = [int(s) for s in np.flatnonzero(counts[: min(room, largest) + 1])[::-1]]
    best_fit, left = [], room
    for s in sizes:  # best-fit decreasing: the incumbent
        take = min(left // s, int(counts[s]))
        best_fit += [s] * take
        left -= s * take
    found: dict[tuple[int, ...], int] = {tuple(best_fit): left}
    if not sizes or (left == 0 and most == 1):
        return list(found)
    waste, budget = left, nodes
    used: dict[int, int] = {}
    perfect = int(left == 0)
    # What the lengths from each place on can fill at most: a branch that must waste more than is listed is cut off.
    fill = np.cumsum([s * int(counts[s]) for s in sizes[::-1]])[::-1].tolist()

    def free(s: int) -> bool:
        return s < len(counts) and counts[s] > used.get(s, 0)

    def listed(kinds: list[int]) -> tuple[int, ...]:
        return tuple(s for s in kinds for _ in range(used[s]))

    def search(at: int, left: int, kinds: list[int]) -> bool:
        # ``kinds`` are the lengths chosen, each ``used`` times. One level for each, so some 60 levels at most.
        nonlocal waste, budget, perfect
        if left <= largest and left and free(left) and (not kinds or left <= kinds[-1]) and not any(free(c + left) and c + left <= largest for c in kinds):
            filling = (*listed(kinds), left)
            perfect += found.get(filling) != 0
            found[filling] = 0
            waste = 0
            if perfect >= most:
                return True
        if (left < sizes[-1] or at == len(sizes)) and kinds:
            if left < waste:
                waste = left
            if left <= waste + 8:
                filling = listed(kinds)
                perfect += left == 0 and found.get(filling) != 0
                found[filling] = left
            return False
        for i in range(at, len(sizes)):
            s = sizes[i]
            if left - fill[i] > waste + 8:
                return False
            if s > left or not free(s):
                continue
            budget -= 1
            if budget < 0:
                return False
            if any(c + s <= largest and free(c + s) for c in kinds):
                continue  # dominated by the longer piece
            most_times = 1 if 2 * s <= largest and free(2 * s) else min(left // s, int(counts[s]))
            kinds.append(s)
            for times in range(most_times, 0, -1):
                budget -= times < most_times
                used[s] = times
                if budget < 0 or search(i + 1, left - s * times, kinds):
                    break
            used[s] = 0
            kinds.pop()
            if budget < 0 or perfect >= most:
                return perfect >= most
        return False

    search(0, room, [])
    return [f for f, _ in sorted(found.items(), key=lambda x: (x[1], len(x[0])))[:most]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces that cannot share with each other."""
    pieces = np.concatenate(([0], np.cumsum(counts)))  # up to each length, without it
    tokens = np.concatenate(([0], np.cumsum(counts * np.arange(len(counts)))))
    k = np.arange(0, capacity // 2 + 1, max(1, capacity // 64))
    middle, end = min(capacity // 2 + 1, len(counts)), len(counts)
    high, low = np.minimum(capacity - k + 1, end), np.minimum(k, end)
    spare = capacity * (pieces[high] - pieces[middle]) - (tokens[high] - tokens[middle])
    more = np.maximum(0, -(-(tokens[middle] - np.minimum(tokens[low], tokens[middle]) - spare) // capacity))
    return max(-(-int(tokens[-1]) // capacity), int((pieces[-1] - pieces[middle] + more).max()))


def _greedy(counts: np.ndarray, capacity: int, nodes: int) -> list[Pattern]:
    left, out = counts.copy(), []
    top = len(left) - 1
    while True:
        while top > 0 and left[top] == 0:
            top -= 1
        if top == 0:
            return out
        left[top] -= 1
        filling = (top, *_completions(left, capacity - top, top, nodes, 1)[0])
        left[top] += 1
        kinds, uses = np.unique(filling, return_counts=True)
        times = int((left[kinds] // uses).min())
        left[kinds] -= uses * times
        out.append((filling, times))


def _times_used(left: np.ndarray, filling: tuple[int, ...]) -> int:
    kinds, uses = np.unique(filling, return_counts=True)
    return int((left[kinds] // uses).min())


def _branches(left: np.ndarray, capacity: int) -> list[Pattern]:
    """Fillings of the sequence of the largest length left, each with the times it is used: all it can be, half, or once."""
    s = int(np.flatnonzero(left)[-1])
    left[s] -= 1
    fillings = [(s, *f) for f in _completions(left, capacity - s, s, 500, 4)]
    left[s] += 1
    most = [_times_used(left, f) for f in fillings]
    out = list(zip(fillings, most, strict=True))
    out += [(f, n // 2) for f, n in zip(fillings, most, strict=True) if n > 3]
    return out + [(f, 1) for f, n in zip(fillings, most, strict=True) if n > 1]


def _branch_and_bound(counts: np.ndarray, capacity: int, best: list[Pattern], bound: int, nodes: int) -> list[Pattern]:
    """Branch and bound over whole packings; ``best`` is the incumbent.

    An open branch holds the path to it as links to the branch before: (link, filling, times).
    """
    fewest = sum(n for _, n in best)
    opened: list[tuple] = [(0, 0, 0, None)]  # departures from the first choice, depth, order of coming, path
    number = 0
    while opened and nodes > 0 and fewest > bound:
        departures, depth, _, path = heapq.heappop(opened)
        left, used, link = counts.copy(), 0, path
        while link is not None:
            link, filling, times = link
            np.subtract.at(left, list(filling), times)
            used += times
        while nodes > 0:  # down along the first choices
            if used + lower_bound(left, capacity) >= fewest:
                break
            if not left.any():
                best, fewest, link = [], used, path
                while link is not None:
                    link, filling, times = link
                    best.append((filling, times))
                break
            nodes -= 1
            first, *others = _branches(left, capacity)
            for i, (filling, times) in enumerate(others, 1):
                number += 1
                heapq.heappush(opened, (departures + i, depth + 1, number, (path, filling, times)))
            path, depth, used = (path, *first), depth + 1, used + first[1]
            np.subtract.at(left, list(first[0]), first[1])
    return best


def best_packing(counts: np.ndarray, capacity: int, nodes: int = 2000) -> list[Pattern]:
    """Patterns (lengths, times used) that hold ``counts[n]`` pieces of each length n in few sequences."""
    counts = np.asarray(counts, np.int64)
    bound = lower_bound(counts, capacity)
    best = min((_greedy(counts, capacity, n) for n in (nodes, 0)), key=lambda p: sum(n for _, n in p))
    return _branch_and_bound(counts, capacity, best, bound, _NODES)


def _places(patterns: list[Pattern], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces by (length, rank): the first key of each run of equal slots, its first sequence and the offset there."""
    keys, sequences, offsets = [], [], []
    ranks, sequence = np.zeros(capacity + 1, np.int64), 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            keys.append((n << 44) + int(ranks[n]))
            sequences.append(sequence)
            offsets.append(offset)
            ranks[n] += times
            offset += n
        sequence += times
    order = np.argsort(np.asarray(keys, np.int64), kind="stable")
    return tuple(np.asarray(x, np.int64)[order] for x in (keys, sequences, offsets))


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: (doc_id, piece, start, length, ids_crc32), and (block, nth): the nth of its length in its task."""
    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_column, block = encoder(tokenizer, _KNOWN).column, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in sliced(batches):
            rows, out = [], []
            values, bounds = encode_column(batch.column("text"), end_id)
            values, bounds = memoryview(values.tobytes()), bounds.tolist()
            for i in range(batch.num_rows):
                ids = values[4 * bounds[i] : 4 * bounds[i + 1]]
                total = len(ids) // 4
                first = total % capacity or capacity
                start, piece = 0, 0
                while start < total:
                    length = first if piece == 0 else capacity
                    rows.append(i)
                    out.append((piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), seen[length]))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            if out:
                piece, start, length, crc, nth = (np.asarray(x, np.int64) for x in zip(*out, strict=True))
                arrays = [piece.astype(np.int32), start, length, crc, np.full(len(out), block, np.int32), nth]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)), *map(pa.array, arrays)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "block", "nth"],
                )

    return rows.mapInArrow(
        cut, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, block int, nth bigint"
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    with small_batches(docs.sparkSession):
        pieces = materialise(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    per_block = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    per_block = materialise(per_block.withColumn("before", F.coalesce(before, F.lit(0))), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_block.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row["length"]] = row["n"]
    keys, sequences, offsets = _places(best_packing(counts, capacity), capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    id_type = pieces.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            key = (batch.column("length").to_numpy() << 44) + batch.column("rank").to_numpy()
            run = np.searchsorted(keys, key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(sequences[run] + key - keys[run]), pa.array(offsets[run])],
                [*columns, "sequence_id", "offset"],
            )

    ranked = pieces.join(per_block.select("length", "block", "before"), ["length", "block"])
    ranked = ranked.select(*columns, (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(
        place,
        f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
