"""Centroid clustering in whole numbers, with nearest centroids found by Orchard's search.

A vector's component x becomes floor(scale * x), so distances, sums and means are exact and do not depend on the order of
rows. Centroids start as the kept vectors with the least hashes. In each round every task assigns its own vectors and adds
them up per centroid; Spark sums these partial sums, and the driver gets ``k`` times ``size`` numbers, whatever the input.

Orchard's search: each centroid has the others listed by distance. A vector starts at the centroid nearest to all others
and walks its list; whenever a listed centroid is closer (or as close and of a smaller number) it jumps to the start of
that one's list, and centroids met before are marked and not measured again. It stops where a listed centroid lies
strictly beyond twice the current distance: by the triangle inequality neither it nor any after it can be as close. All
vectors of a batch walk at once, as columns.

Defined results: rows without exactly ``size`` components, or with a null or non-finite one, and null vectors are left
out; components beyond +-2^26 after scaling (for 64 of them) are held there, so that squared distances fit in a long;
repeated rows are vectors each, and are summed each; of equal hashes the lesser vector comes first; a null id hashes as the empty text; with fewer
than ``k`` kept rows each is a centroid; sums beyond a long are given as its greatest value; other columns are never read;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import materialise

_ROWS = 2048


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per centroid the others by distance (ties by number) and those squared distances; and the centroid to start from."""
    k = len(centroids)
    gaps = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    order = np.stack([np.lexsort((np.arange(k), row)) for row in gaps])
    order = np.stack([row[row != i] for i, row in enumerate(order)]).reshape(k, k - 1)
    start = int(np.sqrt(gaps.astype(float)).sum(axis=1).argmin())
    return order, np.take_along_axis(gaps, order, axis=1), start


def nearest(vectors: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each vector; of equally near ones the smaller number."""
    order, gaps, start = lists
    k, n = len(centroids), len(vectors)
    now = np.full(n, start)
    best = ((vectors - centroids[start]) ** 2).sum(axis=1)
    met = np.zeros((n, k), bool)
    met[:, start] = True
    place = np.zeros(n, np.int64)
    walking = np.arange(n) if k > 1 else np.empty(0, np.int64)
    while len(walking):
        at, step = now[walking], place[walking]
        # Distances d(c, c') > 2 d(v, c), squared.
        walking = walking[gaps[at, step] <= 4 * best[walking]]
        other = order[now[walking], place[walking]]
        place[walking] += 1
        new = ~met[walking, other]
        rows, other = walking[new], other[new]
        met[rows, other] = True
        found = ((vectors[rows] - centroids[other]) ** 2).sum(axis=1)
        closer = (found < best[rows]) | ((found == best[rows]) & (other < now[rows]))
        jump = rows[closer]
        now[jump], best[jump], place[jump] = other[closer], found[closer], 0
        walking = walking[place[walking] < k - 1]
    return now, best


def whole_vectors(df: DataFrame, size: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the kept rows; the components as bytes of little-endian 32-bit integers."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    most = min(1 << 30, math.isqrt((1 << 60) // size) // 2)  # 4 * size * (2 * most)^2 fits in a long
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter((F.size("vector") == size) & finite)
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(values * scale), -most, most).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([v.tobytes() for v in whole], pa.binary())], ["vec_id", "vector"])

    return rows.mapInArrow(run, f"vec_id {id_type}, vector binary")


def _blocks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The batch's vectors in blocks that keep the walk's columns small, with the place of the first."""
    column = batch.column("vector")
    for at in range(0, len(column), _ROWS):
        rows = column.slice(at, _ROWS)
        yield at, np.frombuffer(b"".join(rows.to_pylist()), "<i4").reshape(-1, size).astype(np.int64)


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[bytes]:
    """The vectors with the least hashes of salt and id, in order; at most ``k`` rows reach the driver."""
    named = F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [bytes(r["vector"]) for r in vectors.orderBy(F.sha2(named, 256), "vector").limit(k).select("vector").collect()]


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per centroid with vectors their number and the sums of their components."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, k = neighbour_lists(centroids), len(centroids)
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, block in _blocks(batch, size):
                cluster, _ = nearest(block, centroids, lists)
                order = np.argsort(cluster, kind="stable")
                present, first = np.unique(cluster[order], return_index=True)
                sums[present] += np.add.reduceat(block[order], first, axis=0)
                counts += np.bincount(cluster, minlength=k)
        held = np.flatnonzero(counts)
        columns = [np.repeat(held, size), np.tile(np.arange(size), len(held)), sums[held].ravel(), np.repeat(counts[held], size)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["cluster", "axis", "total", "n"])

    parts = vectors.mapInArrow(run, "cluster bigint, axis bigint, total bigint, n bigint")
    exact = parts.groupBy("cluster", "axis").agg(F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n"))
    out: dict[int, tuple[int, list[int]]] = {}
    for cluster, axis, total, n in exact.collect():  # k * size rows
        out.setdefault(cluster, (n, [0] * size))[1][axis] = int(total)
    return out


def clusters(
    df: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    vectors = materialise(whole_vectors(df, size, scale, id_col, vector_col), "vectors")
    chosen = first_centroids(vectors, k, salt)
    if not chosen:
        columns = "cast(null as int) cluster, 0L distance, 0L cluster_inertia, 0L inertia, '' centroid_sha256"
        return vectors.select("vec_id", *[F.expr(c) for c in columns.split(", ")]).limit(0)
    centroids = np.stack([np.frombuffer(c, "<i4") for c in chosen]).astype(np.int64)
    for _ in range(rounds):
        moved = centroids.copy()
        for cluster, (n, totals) in _sums(vectors, centroids).items():
            moved[cluster] = [t // n for t in totals]
        centroids = moved
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = neighbour_lists(centroids)
        for batch in batches:
            for at, block in _blocks(batch, size):
                cluster, distance = nearest(block, centroids, lists)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, len(block)), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    assigned = materialise(vectors.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance bigint"), "assigned")
    total = F.sum(F.col("distance").cast("decimal(28,0)"))
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(total.alias("total")).collect()}  # k rows
    most = 2**63 - 1
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of_cluster = F.create_map(*[x for c, v in inertia.items() for x in (F.lit(c), F.lit(min(v, most)))])
    digest_of = F.array(*map(F.lit, digests))
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster[F.col("cluster")].cast("long").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), most)).cast("long").alias("inertia"),
        digest_of[F.col("cluster")].alias("centroid_sha256"),
    )
