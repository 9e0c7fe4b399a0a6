"""k-means with Drake's adaptive bounds, exact in integers.

Each vector keeps its centroid with an upper bound of the distance, its next nearest centroids with a lower bound each, and
one lower bound for all the remaining ones. When centroids have moved, bounds follow by the distances moved. A round then

1. leaves a vector where its upper bound is below all lower bounds, if need be after its own distance is found anew;
2. else, where the remainder's bound still lies above, finds the distances of those listed centroids whose bounds don't
   certify their order, and orders the list anew;
3. else scans all centroids.

As many centroids are listed from one round to the next as the deepest decision asked for. Bounds are doubles, rounded
outwards, and only certify; all decisions rest on exact integer distances, ties on the smaller number. Sums of centroids
change by the vectors that moved, so that a round's sums read only these.

Spark writes vectors and bounds as a table each round and deletes the last one. What passes the driver are k sums and
counts a round.

A vector is kept if it has the right number of components, none null or non-finite, and none of 131072 or more in size
(scaled, beyond 2^27, where a long can't hold a squared distance). Vectors with a null id are clustered but start no centroid;
repeated rows count each. Fewer kept vectors than k give so many centroids, none an empty result. Equal hashes (repeated
ids) are ordered by components. Only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, releasing_shuffles, through_table

SIZE, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Listed centroids beside a vector's own, at first.
LISTED = 3
_LARGEST = 1 << 27
_SLACK = 1e-12
_STATE = "vec_id long, v array<int>, before int, cluster int, upper double, near array<int>, low array<double>, rest double, depth int, found long, distance long"
_LONG_MAX = (1 << 63) - 1


def kept(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and scaled integer components of the vectors that can be clustered."""
    x = F.col("embedding").cast("array<double>")
    whole = (F.size(x) == size) & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < _LARGEST)), F.lit(False))
    sound = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(whole, x).alias("x")).where("x is not null")
    return sound.select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float)) * (1 + _SLACK)


def _down(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float)) * (1 - _SLACK)


def _squares(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = x - centre
    return np.einsum("ij,ij->i", apart, apart)


class Bounds:
    """The vectors of a batch: their centroids and what is known of the distances to the others."""

    def __init__(self, x: np.ndarray, centres: np.ndarray, listed: int):
        self.x, self.centres, self.listed = x, centres, min(listed, len(centres) - 1)
        self.found = np.zeros(len(x), np.int64)
        self.depth = np.zeros(len(x), np.int32)
        self.at = np.zeros(len(x), np.int32)
        self.upper = np.zeros(len(x))
        self.near = np.zeros((len(x), self.listed), np.int32)
        self.low = np.zeros((len(x), self.listed))
        self.rest = np.zeros(len(x))

    def scan(self, rows: np.ndarray) -> None:
        """All distances of ``rows``."""
        x, b = self.x[rows], self.listed
        d = np.stack([_squares(x, c) for c in self.centres], axis=1)
        order = np.argsort(d, axis=1, kind="stable")  # equal ones by number
        d = np.take_along_axis(d, order, axis=1)
        self.at[rows], self.upper[rows] = order[:, 0], _up(d[:, 0])
        self.near[rows], self.low[rows] = order[:, 1 : b + 1], _down(d[:, 1 : b + 1])
        self.rest[rows] = _down(d[:, b + 1]) if d.shape[1] > b + 1 else np.inf
        self.found[rows] += d.shape[1]
        self.depth[rows] = d.shape[1]

    def follow(self, at: np.ndarray, upper: np.ndarray, near: np.ndarray, low: np.ndarray, rest: np.ndarray, moved: np.ndarray) -> None:
        """Take the bounds of the round before; ``moved``: how far each centroid went since, rounded up."""
        self.at, self.upper = at.copy(), upper + moved[at]
        low = low - moved[near]
        self.rest = rest - moved.max()
        if near.shape[1] > self.listed:
            self.rest = np.minimum(self.rest, low[:, self.listed :].min(axis=1))
        self.near, self.low = near[:, : self.listed].copy(), low[:, : self.listed]

    def decide(self) -> None:
        lowest = np.minimum(self.low.min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(self.upper >= lowest)
        d = np.zeros(len(self.x), np.int64)
        d[open_] = np.einsum("ij,ij->i", *[self.x[open_] - self.centres[self.at[open_]]] * 2)
        self.found[open_] += 1
        self.upper[open_] = _up(d[open_])
        open_ = open_[self.upper[open_] >= lowest[open_]]
        by_list = self.upper[open_] < self.rest[open_]
        self.scan(open_[~by_list])
        self.reorder(open_[by_list], d)

    def reorder(self, rows: np.ndarray, own: np.ndarray) -> None:
        """Order own and listed centroids of ``rows`` anew; only distances that bounds don't tell apart from the own are found."""
        if not len(rows):
            return
        b = self.listed
        number = np.concatenate([self.at[rows, None], self.near[rows]], axis=1)
        low = np.concatenate([_down(own[rows])[:, None], self.low[rows]], axis=1)
        d = np.full((len(rows), b + 1), np.iinfo(np.int64).max)
        d[:, 0] = own[rows]
        unsure = self.low[rows] <= self.upper[rows, None]
        for j in range(b):
            some = np.flatnonzero(unsure[:, j])
            d[some, j + 1] = np.einsum("ij,ij->i", *[self.x[rows[some]] - self.centres[number[some, j + 1]]] * 2)
            low[some, j + 1] = _down(d[some, j + 1])
        self.found[rows] += unsure.sum(axis=1)
        self.depth[rows] = np.where(unsure.any(axis=1), b - np.argmax(unsure[:, ::-1], axis=1), 0)
        best = np.lexsort((number, d), axis=1)[:, 0]
        each = np.arange(len(rows))
        self.at[rows], self.upper[rows] = number[each, best], _up(d[each, best])
        others = np.argsort(np.where(np.arange(b + 1) == best[:, None], -1.0, np.maximum(low, 0)), axis=1, kind="stable")[:, 1:]
        self.near[rows], self.low[rows] = np.take_along_axis(number, others, axis=1), np.take_along_axis(low, others, axis=1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    m, b = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (m + 1) * b, b) if b else np.zeros(m + 1, int), pa.int32()), pa.array(rows.reshape(-1), kind))


def _assign(centres: np.ndarray, moved: np.ndarray | None, listed: int, last: bool) -> Callable:
    """One round for vectors (vec_id, v), or for those with the state of the round before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            x = column["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(m, -1)
            state = Bounds(x, centres, listed)
            before = pa.nulls(m, pa.int32())
            if moved is None:
                state.scan(np.arange(m))
            else:
                before = column["cluster"]
                at = before.to_numpy(zero_copy_only=False)
                near, low = (column[k].flatten().to_numpy(zero_copy_only=False).reshape(m, -1) for k in ("near", "low"))
                state.follow(at, *(column[k].to_numpy(zero_copy_only=False) for k in ("upper",)), near, low, column["rest"].to_numpy(zero_copy_only=False), moved)
                state.found += column["found"].to_numpy(zero_copy_only=False)
                state.decide()
            distance = np.einsum("ij,ij->i", *[x - centres[state.at]] * 2) if last else np.zeros(m, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    column["vec_id"], column["v"], before, pa.array(state.at, pa.int32()), pa.array(state.upper), _lists(state.near, pa.int32()),
                    _lists(state.low, pa.float64()), pa.array(state.rest), pa.array(state.depth, pa.int32()), pa.array(state.found), pa.array(distance),
                ],
                ["vec_id", "v", "before", "cluster", "upper", "near", "low", "rest", "depth", "found", "distance"],
            )

    return run


def _first(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hashes, in their order."""
    hashed = points.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)).where("h is not null")
    return np.array([row.v for row in hashed.orderBy("h", "v").limit(k).collect()], np.int64)


def _changes(state: DataFrame) -> list:
    """By centroid and component: how many vectors came (less those that left), and the sum of their components. k * size rows."""
    came = F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign"))
    left = F.struct(F.col("before").alias("c"), F.lit(-1).alias("sign"))
    moved = state.where("before is null or cluster != before").select("v", F.explode(F.array(came, left)).alias("e")).where("e.c is not null")
    each = moved.select(F.col("e.c").alias("c"), F.col("e.sign").alias("sign"), F.posexplode("v").alias("i", "x"))
    with releasing_shuffles(state.sparkSession):
        return each.groupBy("c", "i").agg(F.sum("sign").alias("n"), F.sum(F.col("sign") * F.col("x").cast("long")).alias("s")).collect()


def drake(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED, listed: int = LISTED) -> tuple[DataFrame, np.ndarray]:
    """The state of every kept vector (vec_id, v, cluster, distance, found: how many distances were computed) and the final centroids."""
    points = kept(vectors, size, scale)
    centres = _first(points, k, seed)
    if not len(centres):
        return points.limit(0).selectExpr("vec_id", "v", "0 as cluster", "0L as distance", "0L as found"), centres
    sums, counts = [[0] * size for _ in centres], [0] * len(centres)
    state = through_table(points.mapInArrow(_assign(centres, None, listed, rounds == 0), _STATE), "centroids")
    for at in range(rounds):
        for row in _changes(state):
            counts[row.c] += row.n if row.i == 0 else 0
            sums[row.c][row.i] += row.s
        now = np.array([[s // n for s in each] if n else old for each, n, old in zip(sums, counts, centres.tolist())], np.int64)
        moved = _up(np.array([_squares(a[None], b)[0] for a, b in zip(now, centres)]))
        centres = now
        if at:
            listed = max(1, min(listed, state.agg(F.max("depth")).first()[0]))
        old, state = state, through_table(state.mapInArrow(_assign(centres, moved, listed, at == rounds - 1), _STATE), "centroids")
        discard(old)
    return state, centres


def centroid_clusters(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster and squared distance of every kept vector, sums of the distances, and a digest of its centroid."""
    state, centres = drake(vectors)
    spark = vectors.sparkSession
    with releasing_shuffles(spark):
        sums = {row.cluster: int(row.s) for row in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = min(_LONG_MAX, sum(sums.values()))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    rows = [(i, min(_LONG_MAX, sums.get(i, 0)), total, digest) for i, digest in enumerate(digests)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    found = state.select("vec_id", F.col("cluster").cast("int").alias("cluster"), F.col("distance").cast("long").alias("distance"))
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
