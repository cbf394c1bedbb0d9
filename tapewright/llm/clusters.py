"""Centroid clustering in exact integers, with bounds that geometry keeps tight while centroids move."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tapewright.llm.common import map_batches, replaced

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
# Components below this in size: squared distances and their parts fit 64 bits.
LARGEST = 1 << 27
# Vectors of a block, and so of a row of the working table.
BLOCK = 4096
# Bounds are doubles: what they may be off by, relative and absolute.
OFF = 1e-9

_STATE = "ids array<bigint>, vectors binary, cluster binary, upper binary, lower binary, sums binary, counts binary, radius binary, scanned bigint"


def integers(vectors: DataFrame, key: str, column: str, dimensions: int, scale: int) -> DataFrame:
    """``id, x`` of the vectors that take part: each component is floor(scale * component)."""
    scaled = F.transform(column, lambda c: F.floor(c.cast("double") * scale))
    usable = (F.size(column) == dimensions) & F.forall(
        column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * scale) < LARGEST - 1))
    rows = vectors.filter(F.coalesce(usable, F.lit(False)))
    return rows.select(F.col(key).cast("bigint").alias("id"), scaled.cast("array<int>").alias("x"))


def first_centroids(rows: DataFrame, k: int) -> list[list[int]]:
    """The vectors with the k smallest digests of their ids; those without an id come last, ties go by components."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    return [list(r["x"]) for r in rows.orderBy(digest.isNull(), digest, "x").limit(k).select("x").collect()]


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    return (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1) - 2 * (x @ centroids.T)


def _scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and the distances to it and to the next."""
    d = _distances(x, centroids)
    nearest = d.argmin(axis=1)
    at = np.arange(len(x))
    upper = np.sqrt(d[at, nearest].astype(float))
    d[at, nearest] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(float)) if len(centroids) > 1 else np.full(len(x), np.inf)
    return nearest.astype(np.int32), upper, lower


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """How much nearer any other centroid may have come to a vector of each cluster.

    A vector lies in the ball of its cluster: around the old centroid, as wide
    as the largest upper bound.  A centroid moves from p to q, by d, with the
    middle m.  For a vector y the distance shrinks by
    |yp| - |yq| = 2 d s / (|yp| + |yq|), where s is the part of y - m along
    the move, and |yp| + |yq| >= 2 |ym|: by no more than d cos(angle at m
    between y and q).  In the plane of m, q and the ball's centre the smallest
    such angle is the centre's less what half the ball covers, asin(r / D).
    Only a ball that holds m can lose the whole d.
    """
    loose = np.zeros(len(old))
    for j in range(len(old)):
        move = new[j] - old[j]
        d = np.sqrt((move * move).sum())
        if d == 0:
            continue
        centre = old - (old[j] + new[j]) / 2
        far = np.sqrt((centre * centre).sum(axis=1))
        inside = far <= radius * (1 + OFF) + OFF
        far = np.where(inside, 1, far)
        angle = np.arccos(np.clip((centre @ move) / (far * d), -1, 1)) - np.arcsin(np.clip(np.where(inside, 0, radius / far), 0, 1))
        nearer = np.where(inside, d, d * np.clip(np.cos(np.maximum(angle, 0)), 0, 1))
        nearer[j] = 0
        loose = np.maximum(loose, nearer)
    return loose * (1 + OFF) + OFF


def _block(ids: list, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, k: int, scanned: int) -> dict:
    """One row of the working table: a block of vectors, their bounds, and what the next centroids need of them."""
    sums = np.zeros((k, x.shape[1]), np.int64)
    np.add.at(sums, cluster, x)
    radius = np.zeros(k)
    np.maximum.at(radius, cluster, upper)
    counts = np.bincount(cluster, minlength=k).astype(np.int64)
    return {
        "ids": ids, "vectors": x.astype("<i4").tobytes(), "cluster": cluster.astype("<i4").tobytes(),
        "upper": upper.tobytes(), "lower": lower.tobytes(), "sums": sums.tobytes(), "counts": counts.tobytes(),
        "radius": radius.tobytes(), "scanned": scanned,
    }


def _rows(blocks: list[dict]) -> pa.RecordBatch:
    types = {"ids": pa.list_(pa.int64()), "scanned": pa.int64()}
    return pa.record_batch({n: pa.array([b[n] for b in blocks], types.get(n, pa.binary())) for n in blocks[0]})


def _started(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The first round: every vector is compared with every centroid."""
    k, width = centroids.shape

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy().reshape(-1, width).astype(np.int64)
        ids = batch.column(0).to_pylist()
        cut = range(0, len(x), BLOCK)
        return _rows([_block(ids[i:i + BLOCK], x[i:i + BLOCK], *_scan(x[i:i + BLOCK], centroids), k, len(x[i:i + BLOCK])) for i in cut])

    return map_batches(rows, each, _STATE)


def _moved(state: DataFrame, centroids: np.ndarray, drift: np.ndarray, loose: np.ndarray) -> DataFrame:
    """A later round: bounds follow the centroids, and only vectors they cannot decide are scanned."""
    k, width = centroids.shape

    def block(row: dict) -> dict:
        x = np.frombuffer(row["vectors"], "<i4").reshape(-1, width).astype(np.int64)
        cluster = np.frombuffer(row["cluster"], "<i4").astype(np.int32)
        upper = np.frombuffer(row["upper"]) + drift[cluster]
        lower = np.frombuffer(row["lower"]) - loose[cluster]

        def unsure(i: np.ndarray) -> np.ndarray:
            return i[upper[i] * (1 + OFF) + OFF >= lower[i]]

        left = unsure(np.arange(len(x)))
        own = x[left] - centroids[cluster[left]]
        upper[left] = np.sqrt((own * own).sum(axis=1).astype(float))
        left = unsure(left)
        if len(left):
            cluster[left], upper[left], lower[left] = _scan(x[left], centroids)
        return _block(row["ids"], x, cluster, upper, lower, k, len(left))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _rows([block(row) for row in batch.to_pylist()])

    return map_batches(state.select("ids", "vectors", "cluster", "upper", "lower"), each, _STATE)


def _totals(state: DataFrame, k: int, width: int) -> tuple[list[list[int]], list[int], np.ndarray]:
    """Per cluster the sum of its vectors, how many they are, and the largest upper bound.

    A task adds up its blocks first; the driver gets one number per cluster and component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, radius = np.zeros((k, width), np.int64), np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            for one, many, wide in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sums += np.frombuffer(one, np.int64).reshape(k, width)
                counts += np.frombuffer(many, np.int64)
                radius = np.maximum(radius, np.frombuffer(wide))
        yield pa.record_batch({"cluster": np.arange(k, dtype=np.int32), "total": pa.array(list(np.c_[sums, counts]), pa.list_(pa.int64())), "radius": radius})

    parts = state.select("sums", "counts", "radius").mapInArrow(run, "cluster int, total array<bigint>, radius double")
    # Decimals, since the sums of all blocks may pass 64 bits.
    whole = parts.select("cluster", "radius", F.posexplode("total").alias("at", "v")).groupBy("cluster", "at").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.max("radius").alias("radius"))
    table, radius = np.zeros((k, width + 1), object), np.zeros(k)
    for r in whole.collect():
        table[r["cluster"], r["at"]], radius[r["cluster"]] = int(r["v"]), r["radius"]
    return table[:, :width].tolist(), table[:, width].tolist(), radius


def assigned(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, key: str = "vec_id", column: str = "embedding",
    dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """The working table after the last assignment, the centroids, and the vectors scanned in each round."""
    rows = integers(vectors, key, column, dimensions, scale)
    centroids = np.array(first_centroids(rows, k), np.int64).reshape(-1, dimensions)
    if not len(centroids):
        return rows.limit(0), centroids, []
    state = replaced(_started(rows, centroids), "clusters")
    scanned = [state.agg(F.sum("scanned")).first()[0]]
    for _ in range(rounds):
        sums, counts, radius = _totals(state, len(centroids), dimensions)
        moved = np.array([[s // n for s in one] if n else c for one, n, c in zip(sums, counts, centroids.tolist())], np.int64)
        old, new = centroids.astype(float), moved.astype(float)
        drift = np.sqrt(((new - old) ** 2).sum(axis=1)) * (1 + OFF) + OFF
        state = replaced(_moved(state, moved, drift, loosening(old, new, radius)), "clusters", state)
        scanned.append(state.agg(F.sum("scanned")).first()[0])
        centroids = moved
    return state, centroids, scanned


def clustered(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, key: str = "vec_id", column: str = "embedding",
    dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` for every vector that takes part.

    Centroids start at the vectors whose ids have the smallest digests; each
    round assigns every vector to its nearest centroid (squared Euclidean
    distance, ties to the smaller number) and moves the centroids to the floor
    of their vectors' mean; at the end vectors are assigned once more.  All of
    it is exact in integers; bounds in doubles only decide, with a margin,
    which vectors need not be looked at.

    Vectors go through every round in blocks of their own tasks: nothing is
    exchanged but sums per cluster, so a third of all rows in one cluster costs
    nothing more.  Each round is a table in the shared folder, the one before
    it is removed.

    A vector that is NULL, of another length, or holds a NULL, a NaN, an
    infinity or a component whose scaled size reaches 2^27 (its distance would
    leave 64 bits) takes no part.  Rows with equal ids are vectors of their
    own; those without an id start a centroid last.  Of fewer vectors than
    ``k`` each starts one.  An empty table gives no rows.
    """
    state, centroids, _ = assigned(vectors, k, rounds, key, column, dimensions, scale)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"{schema}, cluster_inertia bigint, inertia bigint, centroid array<bigint>")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.concatenate([np.frombuffer(v.as_py(), "<i4") for v in batch.column(1)]).reshape(-1, dimensions).astype(np.int64)
        cluster = np.concatenate([np.frombuffer(c.as_py(), "<i4") for c in batch.column(2)])
        own = x - centroids[cluster]
        return pa.record_batch([batch.column(0).flatten(), pa.array(cluster), pa.array((own * own).sum(axis=1))], ["vec_id", "cluster", "distance"])

    rows = map_batches(state.select("ids", "vectors", "cluster"), each, schema)
    # One row per cluster.
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    each_sum = F.array(*[F.lit(sums.get(c, 0)).cast("bigint") for c in range(len(centroids))])
    each_centroid = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in c]) for c in centroids.tolist()])
    return rows.withColumns({
        "cluster_inertia": F.get(each_sum, F.col("cluster")), "inertia": F.lit(sum(sums.values())).cast("bigint"),
        "centroid": F.get(each_centroid, F.col("cluster"))})
