"""Repair of conversations: the cheapest edits that turn their roles into an optional system turn and user/assistant pairs.

A row is blank, a duplicate (role and text seen earlier in its conversation), truncated (its text does not end a sentence)
or fine; its first fault counts. Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3 (blank and duplicate rows
allow nothing else), Insert of an empty user or assistant turn 2; truncated rows that stay add 1. Of equally cheap edit
lists the one whose initials are least in ASCII order is taken.

Run-length DP: what a row does to the costs of the four states of the pattern ``(s?(ua)+)?`` is a min-plus matrix that
depends on its symbol (role initial and fault) alone. Equal consecutive symbols are one run, and costs cross a run of n
rows by the binary powers of its matrix, which are cached. Walking forward with the costs still to come, the least initial
that stays cheapest gives the audit; state and initial determine the edit.

Rows are sorted by range over all tasks and cut into pieces of at most ``piece_rows`` rows, so that no task gathers a
conversation. Most conversations are one piece and are repaired where they stand. Pieces of longer ones carry a matrix
each: a pass backward over the matrices gives the costs behind each piece, a pass forward the state in which each is
entered, and then all pieces are unrolled at once. Only the digest of a long conversation's repaired text is made by one
task, as a stream, because it is one hash over one text.

Defined results: null roles and texts count as one blank; null turns come first; rows of one turn are ordered by role and
then by the digest of their text; a null id is a conversation like any other; repeated rows are duplicates; roles other
than system, user and assistant have the initial they have; other columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import materialise

_BYTES = 1 << 20  # text of a piece, beyond which it ends
_FAR = 1 << 50
# States: nothing yet, after the system turn, after a user turn, after a pair.
_START, _SYSTEM, _USER, _PAIR = range(4)
_WANTS = ("user", "user", "assistant", "user")
_AFTER = (_USER, _USER, _PAIR, _USER)
_NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\Z")
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
LEGAL = ("su", "ua", "au")

Costs = tuple[int, int, int, int]
Matrix = tuple[Costs, Costs, Costs, Costs]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def _inserts() -> Matrix:
    one = tuple(tuple(0 if i == j else 2 if _AFTER[i] == j else _FAR for j in range(4)) for i in range(4))
    return _times(one, _times(one, one))


_INSERTS = _inserts()
END: Costs = tuple(min(row[_START], row[_PAIR]) for row in _INSERTS)


def keep_state(state: int, initial: str) -> int | None:
    """The state after keeping a row of this role initial, if the pattern allows it."""
    if initial == "s":
        return _SYSTEM if state == _START else None
    return _AFTER[state] if initial == _WANTS[state][0] else None


def symbol(role: str, fault: int) -> str:
    """What decides a row's edits: its role initial, with its fault; rows that must go are all alike."""
    return "x" if fault in (BLANK, DUPLICATE) else (role[:1] if role[:1] in ("s", "u", "a") else "o") + "t" * (fault == TRUNCATED)


@lru_cache
def transition(sym: str) -> Matrix:
    """Least costs from state to state over inserts and one row."""
    extra, row = int(sym.endswith("t")), []
    for state in range(4):
        costs = [_FAR] * 4
        costs[state] = 3
        if sym != "x":
            after = _AFTER[state]
            costs[after] = min(costs[after], 2 + extra)
            kept = keep_state(state, sym[0])
            if kept is not None:
                costs[kept] = min(costs[kept], extra)
        row.append(tuple(costs))
    return _times(_INSERTS, tuple(row))


@lru_cache
def power(sym: str, exponent: int) -> Matrix:
    """The transition over 2**exponent rows of one symbol."""
    return transition(sym) if exponent == 0 else _times(power(sym, exponent - 1), power(sym, exponent - 1))


@lru_cache(100_000)
def before_run(sym: str, n: int, after: Costs) -> Costs:
    """Costs to the end ahead of a run of ``n`` equal symbols, from those behind it."""
    exponent = 0
    while n:
        if n & 1:
            step = power(sym, exponent)
            after = tuple(min(step[i][j] + after[j] for j in range(4)) for i in range(4))
        n, exponent = n >> 1, exponent + 1
    return after


def runs_of(symbols: list[str]) -> list[tuple[str, int]]:
    return [(s, len(list(same))) for s, same in groupby(symbols)]


def matrix_of(runs: list[tuple[str, int]]) -> list[int]:
    """The transition over all runs, row by row."""
    columns = []
    for j in range(4):
        costs: Costs = tuple(0 if i == j else _FAR for i in range(4))
        for sym, n in reversed(runs):
            costs = before_run(sym, n, costs)
        columns.append(costs)
    return [min(columns[j][i], _FAR) for i in range(4) for j in range(4)]


def walk(runs: list[tuple[str, int]], state: int, after: Costs, last: bool) -> tuple[str, int, int]:
    """(audit, state behind, cost) of the least of the cheapest edit lists from ``state``, when ``after`` are the costs behind.

    With ``last`` the inserts behind the last row are made as well."""
    behind = [after]
    for sym, n in reversed(runs):
        behind.append(before_run(sym, n, behind[-1]))
    behind.reverse()
    audit, cost = [], 0
    for at, (sym, n) in enumerate(runs):
        inner = [behind[at + 1]]
        for _ in range(n):
            inner.append(before_run(sym, 1, inner[-1]))
        for left in range(n, 0, -1):
            now, then = inner[left], inner[left - 1]
            extra = int(sym.endswith("t"))
            while True:
                goal = now[state]
                kept = keep_state(state, sym[0])
                if 3 + then[state] == goal:
                    audit.append("D")
                    cost += 3
                elif 2 + now[_AFTER[state]] == goal:
                    audit.append("I")
                    cost, state = cost + 2, _AFTER[state]
                    continue
                elif sym != "x" and kept is not None and extra + then[kept] == goal:
                    audit.append("K")
                    cost, state = cost + extra, kept
                else:
                    audit.append("R")
                    cost, state = cost + 2 + extra, _AFTER[state]
                break
    while last and after[state]:
        audit.append("I")
        cost, state = cost + 2, _AFTER[state]
    return "".join(audit), state, cost


def apply_edits(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """The repaired rows as role:text."""
    lines, row = [], 0
    for edit in audit:
        if edit == "I":
            lines.append(f"{_WANTS[state]}:")
            state = _AFTER[state]
            continue
        if edit == "K":
            lines.append(f"{roles[row]}:{texts[row]}")
            state = keep_state(state, roles[row][:1])
        elif edit == "R":
            lines.append(f"{_WANTS[state]}:{texts[row]}")
            state = _AFTER[state]
        row += 1
    return lines


def fault_of(text: str, seen: bool) -> int:
    """The first fault of a row."""
    last = _LAST.search(text) if _NOT_BLANK.search(text) else None
    if last is None:
        return BLANK
    return DUPLICATE if seen else FINE if last[1] in ".!?" else TRUNCATED


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _join(lines: list[str]) -> bytes:
    return "\n".join(lines).encode("utf-8", "surrogatepass")


_STATS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_TURNS = "least_turn bigint, most_turn bigint, turns bigint, first_initial string, last_initial string"


def _counts(faults: list[int]) -> dict[str, int]:
    return {"blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED)}


def _batches(rows: Iterator[tuple[dict, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most 1000 rows or about 4 MB; ``rows`` gives each row with its size."""
    held, weight = [], 0
    for row, size in rows:
        held.append(row)
        weight += size
        if len(held) >= 1000 or weight > 4 * _BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _map(df: DataFrame, schema: str, step: Callable[[Iterator[dict]], Iterator[tuple[dict, int]]]) -> DataFrame:
    """``step`` over the rows of each task, as dictionaries, one after the other."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256))
        yield from _batches(step(row for s in slices for row in s.to_pylist()), arrow)

    return df.mapInArrow(run, schema)


def _sorted_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, dropped_col: str | None) -> DataFrame:
    blank = F.lit(" ")
    dropped = F.coalesce(F.col(dropped_col).cast("boolean"), F.lit(False)) if dropped_col else F.lit(False)
    rows = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), blank).alias("text"),
        dropped.alias("dropped"),
    )
    # Rows equal in everything are told apart by where they were read, so that many of them can be split.
    rows = rows.withColumns({"digest": F.md5("text"), "nth": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "role", "digest", "nth"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest", "nth")


def _pieces(rows: DataFrame, most_rows: int) -> DataFrame:
    """Pieces of sorted rows; ``whole`` ones are surely all of their conversation."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, block int, piece int, whole boolean, {_TURNS}, roles array<string>, texts array<string>"

    def cut(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        block, piece = TaskContext.get().partitionId(), 0
        waiting, first = None, True  # the last piece of a conversation waits until its end is known
        for conv, same in groupby(rows, key=lambda r: (r["conv_id"] is None, r["conv_id"])):
            if waiting:
                yield waiting
                first = False
            waiting, parts = None, 0
            roles, texts, turns, weight = [], [], [], 0

            def made(whole: bool) -> tuple[dict, int]:
                known = [t for t in turns if t is not None]
                return {
                    "conv_id": conv[1], "block": block, "piece": piece, "whole": whole,
                    "least_turn": known[0] if known else None, "most_turn": known[-1] if known else None, "turns": len(set(known)),
                    "first_initial": roles[0][:1] if roles else None, "last_initial": roles[-1][:1] if roles else None, "roles": roles, "texts": texts,
                }, weight + 64 * len(roles)

            for row in same:
                if row["dropped"]:
                    continue
                if len(roles) >= most_rows or weight > _BYTES:
                    yield made(False)
                    piece, parts = piece + 1, parts + 1
                    roles, texts, turns, weight = [], [], [], 0
                roles.append(row["role"])
                texts.append(row["text"])
                turns.append(row["turn"])
                weight += len(row["text"])
            waiting = made(not first and not parts)
            piece += 1
        if waiting:  # the next task may hold more of it
            yield waiting[0] | {"whole": False}, waiting[1]

    return _map(rows, schema, cut)


_RESULT = f"least_turn bigint, most_turn bigint, turns bigint, {_STATS}, repaired_sha256 string"


def _whole(pieces: DataFrame) -> DataFrame:
    """Results of conversations of one piece."""
    id_type = pieces.schema["conv_id"].dataType.simpleString()

    def repair(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for row in rows:
            seen, faults = set(), []
            for role, text in zip(row["roles"], row["texts"], strict=True):
                key = (role, text)
                faults.append(fault_of(text, key in seen))
                seen.add(key)
            audit, _, cost = walk(runs_of(list(map(symbol, row["roles"], faults))), _START, END, True)
            yield {
                **{c: row[c] for c in ("conv_id", "least_turn", "most_turn", "turns")},
                **_counts(faults),
                "illegal": _illegal([r[:1] for r in row["roles"]]),
                "cost": cost,
                "audit": audit,
                "repaired_sha256": hashlib.sha256(_join(apply_edits(audit, _START, row["roles"], row["texts"]))).hexdigest(),
            }, 512 + len(audit)

    return _map(pieces, f"conv_id {id_type}, {_RESULT}", repair)


_PLACE = "block int, piece int"


def _seen_before(pieces: DataFrame) -> DataFrame:
    """(block, piece, seen): digests of rows of a piece that stand in an earlier piece of the same conversation."""
    id_type = pieces.schema["conv_id"].dataType.simpleString()

    def digests(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for row in rows:
            for key in {_digest(r, t) for r, t in zip(row["roles"], row["texts"], strict=True) if _NOT_BLANK.search(t)}:
                yield {"conv_id": row["conv_id"], "block": row["block"], "piece": row["piece"], "digest": key}, 64

    found = _map(pieces.select("conv_id", "block", "piece", "roles", "texts"), f"conv_id {id_type}, {_PLACE}, digest binary", digests)
    found = materialise(found, "row-digests")
    place = F.struct("block", "piece")
    first = found.groupBy("conv_id", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("of"), F.col("digest").alias("own"), "first")
    later = found.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("own"))).filter(place != F.col("first"))
    return later.groupBy("block", "piece").agg(F.collect_list("digest").alias("seen"))


def _judged(pieces: DataFrame) -> DataFrame:
    """Pieces with the faults of their rows and the matrix of the whole piece."""
    seen = _seen_before(pieces)
    joined = pieces.join(seen, ["block", "piece"], "left")
    id_type = pieces.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, {_PLACE}, {_TURNS}, roles array<string>, texts array<string>, faults binary, matrix array<bigint>"

    def judge(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for row in rows:
            seen, faults, weight = set(row.pop("seen") or ()), bytearray(), 256
            for role, text in zip(row["roles"], row["texts"], strict=True):
                key = _digest(role, text)
                faults.append(fault_of(text, key in seen))
                seen.add(key)
                weight += 64 + len(text)
            row.pop("whole")
            yield row | {"faults": bytes(faults), "matrix": matrix_of(runs_of(list(map(symbol, row["roles"], faults))))}, weight

    return _map(joined, schema, judge)


def _in_order(df: DataFrame, backward: bool = False) -> DataFrame:
    """All rows of a conversation in one task, sorted, to be streamed."""
    order = [F.desc("block"), F.desc("piece")] if backward else ["block", "piece"]
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _by_conversation(rows: Iterator[dict]) -> Iterator[tuple[object, Iterator[dict]]]:
    for key, same in groupby(rows, key=lambda r: (r["conv_id"] is None, r["conv_id"])):
        yield key[1], same


def _long(pieces: DataFrame) -> DataFrame:
    """Results of conversations that may have several pieces."""
    id_type = pieces.schema["conv_id"].dataType.simpleString()
    judged = materialise(_judged(pieces), "judged-pieces")

    def backward(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for _, same in _by_conversation(rows):
            costs, last = END, True
            for row in same:
                yield {"block": row["block"], "piece": row["piece"], "behind": list(costs), "last": last}, 64
                m = row["matrix"]
                costs, last = tuple(min(m[4 * i + j] + costs[j] for j in range(4)) for i in range(4)), False

    def leave(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for row in rows:
            runs = runs_of(list(map(symbol, row["roles"], row["faults"])))
            ends = [walk(runs, s, tuple(row["behind"]), row["last"])[1] for s in range(4)]
            yield {c: row[c] for c in ("conv_id", "block", "piece", "behind", "last")} | {"ends": ends}, 96

    def forward(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for _, same in _by_conversation(rows):
            state = _START
            for row in same:
                yield {c: row[c] for c in ("block", "piece", "behind", "last")} | {"state": state}, 64
                state = row["ends"][state]

    def unroll(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for row in rows:
            faults = list(row["faults"])
            audit, _, cost = walk(runs_of(list(map(symbol, row["roles"], faults))), row["state"], tuple(row["behind"]), row["last"])
            lines = _join(apply_edits(audit, row["state"], row["roles"], row["texts"]))
            kept = {c: row[c] for c in ("conv_id", "block", "piece", "least_turn", "most_turn", "turns", "first_initial", "last_initial")}
            yield kept | _counts(faults) | {"illegal": _illegal([r[:1] for r in row["roles"]]), "cost": cost, "audit": audit, "lines": lines}, 512 + len(lines)

    def gather(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for conv, same in _by_conversation(rows):
            digest, begun, audit = hashlib.sha256(), False, array("B")
            out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
            least = most = initial = None
            for row in same:
                for c in out:
                    out[c] += row[c]
                if row["least_turn"] is not None:
                    out["turns"] -= row["least_turn"] == most
                    least, most = (row["least_turn"] if least is None else least), row["most_turn"]
                if row["first_initial"] is not None:
                    out["illegal"] += initial is not None and initial + row["first_initial"] not in LEGAL
                    initial = row["last_initial"]
                audit.frombytes(row["audit"].encode())
                if row["lines"]:
                    digest.update((b"\n" if begun else b"") + row["lines"])
                    begun = True
            yield out | {"conv_id": conv, "least_turn": least, "most_turn": most, "audit": audit.tobytes().decode(), "repaired_sha256": digest.hexdigest()}, 512 + len(audit)

    matrices = _in_order(judged.select("conv_id", "block", "piece", "matrix"), backward=True)
    behind = _map(matrices, f"{_PLACE}, behind array<bigint>, last boolean", backward)
    known = judged.select("conv_id", "block", "piece", "roles", "faults").join(behind, ["block", "piece"])
    ends = _map(known, f"conv_id {id_type}, {_PLACE}, behind array<bigint>, last boolean, ends array<int>", leave)
    entered = _map(_in_order(ends), f"{_PLACE}, behind array<bigint>, last boolean, state int", forward)
    unrolled = _map(judged.drop("matrix").join(entered, ["block", "piece"]), f"conv_id {id_type}, {_PLACE}, {_TURNS}, {_STATS}, lines binary", unroll)
    return _map(_in_order(unrolled), f"conv_id {id_type}, {_RESULT}", gather)


def repair(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", dropped_col: str | None = None, piece_rows: int = 4096
) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows for which ``dropped_col`` holds only tell that their conversation exists."""
    pieces = materialise(_pieces(_sorted_rows(df, conv_col, turn_col, role_col, text_col, dropped_col), piece_rows), "conversation-pieces")
    results = _whole(pieces.filter("whole")).unionByName(_long(pieces.filter("not whole")))
    gaps = F.col("most_turn").cast("decimal(20,0)") - F.col("least_turn") + 1 - F.col("turns")
    gaps = F.least(F.coalesce(gaps, F.lit(0)), F.lit(2**63 - 1)).cast("long")
    return results.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(df: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with faults by crc32 of ``conv_id:turn``: of 20 rows about one each is
    dropped (kept as a mark), emptied, robbed of its sentence ends, repeated, and given the role user."""
    blank = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    kind = F.crc32(named) % 20
    damaged = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = df.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), damaged.alias("text"), (kind == 0).alias("dropped"), kind.alias("kind"))
    return rows.withColumn("copy", F.explode(F.expr("sequence(0, if(kind = 3, 1, 0))"))).drop("copy", "kind")
