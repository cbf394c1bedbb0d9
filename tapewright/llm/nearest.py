"""Nearest neighbours by inner product: inverted lists with an adaptive scan of the dimensions."""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapewright.llm.common import map_batches, sample_of, written

# Vectors that fit the lists, at most; they also set each query's first radius and the number of lists to probe.
SAMPLE = 16_384
# Vectors per list that the number of lists aims at, and the most lists.
LIST, LISTS = 800, 4096
# Columns per block, and how far a partial distance may exceed its expectation before a candidate is abandoned.
BLOCK, EPSILON = 16, 1.2
# Share of the sample's true neighbours that the probed lists must hold.
RECALL = 0.97
# Vectors of the sample from which a query's first radius is taken.
NEAR = 8192
# A task compares so many candidates with so many queries at a time.
CANDIDATES, QUERIES = 4096, 512


@dataclasses.dataclass(frozen=True)
class Index:
    """Rotation, list centres (rotated) and what was learned from the sample.

    Vectors get one more coordinate that brings all to the length of the
    longest; then the largest inner product is the smallest distance.
    """

    longest: float
    rotation: np.ndarray
    centres: np.ndarray
    sample: np.ndarray
    probes: int

    def stored(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest]) @ self.rotation

    def asked(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.rotation


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of ``a`` to every row of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def _centres(x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(10):
        nearest = _squares(x, centres).argmin(1)
        sums, sizes = np.zeros_like(centres), np.bincount(nearest, minlength=lists)
        np.add.at(sums, nearest, x)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def _probes(x: np.ndarray, asked: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Lists to probe so that, within the sample, enough of the true neighbours lie in them."""
    near = np.argsort(_squares(asked, x), axis=1, kind="stable")[:, 1:k + 1]
    ranks = np.argsort(np.argsort(_squares(asked, centres), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(ranks, _squares(x, centres).argmin(1)[near], 1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1 if len(needed) else len(centres)


def fit(vectors: DataFrame, total: int, k: int, sample: int = SAMPLE, recall: float = RECALL, seed: int = 0) -> Index:
    """An index from a bounded sample of the usable vectors."""
    rows = sample_of(vectors.select("vec"), sample, seed).limit(2 * sample).toArrow()
    x = np.array(rows.column("vec").to_pylist())
    longest = float(vectors.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))).first()[0]) ** 0.5
    rng = np.random.default_rng(seed)
    d = x.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    index = Index(longest, rotation, np.zeros((0, d)), np.zeros((0, d)), 0)
    stored = index.stored(x)
    lists = max(1, min(LISTS, total // LIST, len(x) // 8))
    centres = _centres(stored, lists, rng)
    some = rng.choice(len(x), min(len(x), 256), replace=False)
    probes = _probes(stored, index.asked(x[some]), centres, k, recall)
    return dataclasses.replace(index, centres=centres, sample=stored[rng.permutation(len(stored))[:NEAR]], probes=probes)


def usable(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vec`` of the vectors that take part: finite numbers, not all zero, of the commonest length."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = embeddings.filter(v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    rows = kept.select(F.col(key).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("vec"))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (common["n"] if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy().reshape(len(values), -1)


def scan(index: Index, x: np.ndarray, q: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) whose distance may lie within the query's radius.

    Block by block of the rotated columns; a partial distance estimates the
    whole, and a pair is abandoned once it is too large for the radius by more
    than chance allows.  The first block is a product over all pairs, later
    ones touch only the pairs that are left.
    """
    xs, qs = index.stored(x), index.asked(q)
    d = xs.shape[1]
    first = min(BLOCK, d)

    def bound(n: int) -> np.ndarray:
        return radius * (n / d) * (1 + EPSILON / math.sqrt(n) if n < d else 1 + 1e-9) ** 2

    partial = _squares(qs[:, :first], xs[:, :first])
    i, j = np.nonzero(partial <= bound(first)[:, None])
    partial = partial[i, j]
    for start in range(first, d, BLOCK):
        end = min(start + BLOCK, d)
        at = slice(start, end)
        partial = partial + np.square(xs[j, at] - qs[i, at]).sum(1)
        left = partial <= bound(end)[i]
        i, j, partial = i[left], j[left], partial[left]
    return i, j


def _best(qid: np.ndarray, vid: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Rows that are among their query's first ``k``: largest score, then smaller id."""
    order = np.lexsort((vid, -score, qid))
    qid = qid[order]
    first = np.flatnonzero(np.append(True, qid[1:] != qid[:-1])) if len(qid) else np.zeros(0, int)
    place = np.arange(len(qid)) - np.repeat(first, np.diff(np.append(first, len(qid))))
    return order[place < k]


def _listed(vectors: DataFrame, index: Index) -> DataFrame:
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = _squares(index.stored(_matrix(batch.column("vec"))), index.centres).argmin(1)
        return pa.record_batch([*batch.columns, pa.array(lists, pa.int32())], ["vec_id", "vec", "list"])

    return map_batches(vectors, each, "vec_id bigint, vec array<double>, list int")


def _probing(queries: DataFrame, index: Index, k: int, everything: bool) -> DataFrame:
    """Each query with the lists it probes and its first radius.

    The radius is the distance of its 2k-th neighbour in a part of the sample,
    so at least twice as many vectors lie within it as are wanted, and of a
    large table a small share.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        asked = index.asked(_matrix(batch.column("vec")))
        probes = len(index.centres) if everything else index.probes
        lists = np.argsort(_squares(asked, index.centres), axis=1, kind="stable")[:, :probes]
        radius = np.full(len(asked), np.inf)
        if not everything and len(index.sample) > 2 * k:
            # A little more, so that rounding loses no vector of the same distance.
            radius = np.partition(_squares(asked, index.sample), 2 * k, axis=1)[:, 2 * k] + 1e-9 * index.longest ** 2
        return pa.record_batch(
            [*batch.columns, pa.array(list(lists), pa.list_(pa.int32())), pa.array(radius)], ["vec_id", "vec", "lists", "radius"])

    probing = map_batches(queries, each, "vec_id bigint, vec array<double>, lists array<int>, radius double")
    return probing.select("vec_id", "vec", "radius", F.explode("lists").alias("list"))


def _searched(stored: DataFrame, probing: DataFrame, index: Index, k: int) -> DataFrame:
    """Each query's nearest from each list it probes.

    A list with many vectors or many queries is dealt out in blocks, every
    block of candidates against every block of queries.
    """

    def blocks(df: DataFrame, size: int) -> dict[int, int]:
        return {r["list"]: -(-r["count"] // size) for r in df.groupBy("list").count().collect()}

    def of(counts: dict[int, int]):
        return F.get(F.array(*[F.lit(counts.get(i, 1)) for i in range(len(index.centres))]), F.col("list"))

    ours, theirs = of(blocks(stored, CANDIDATES)), of(blocks(probing, QUERIES))

    def dealt(df: DataFrame, own: str, other: str, mine, against) -> DataFrame:
        placed = df.withColumn(own, F.pmod(F.xxhash64("vec_id"), mine.cast("bigint")))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), against.cast("bigint") - 1)))

    candidates = dealt(stored, "c", "q", ours, theirs)
    queries = dealt(probing, "q", "c", theirs, ours)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        x, q = _matrix(left.column("vec")), _matrix(right.column("vec"))
        xid, qid = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        i, j = scan(index, x, q, right.column("radius").to_numpy())
        other = xid[j] != qid[i]
        i, j = i[other], j[other]
        score = (x[j] * q[i]).sum(1)
        best = _best(qid[i], xid[j], score, k)
        return pa.table({"query_id": qid[i][best], "vec_id": xid[j][best], "score": score[best]})

    key = ["list", "c", "q"]
    return candidates.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")


def search(
    embeddings: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    sample: int = SAMPLE, recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found, nearest first.

    ``queries`` are rows of ``embeddings``; a query is no candidate of its own.
    The index is fitted on a bounded sample and holds every usable vector.  The
    score is the inner product of the original vectors in double precision,
    ties go to the smaller id.  A query that finds too few in the lists it
    probes is asked again of all lists without a radius.

    Vectors that are NULL, zero, of an unusual length, or hold NULL or a number
    that is not finite take no part, neither do NULL ids; of rows that repeat
    an id each is a candidate.  Fewer candidates than ``k`` are all returned,
    and an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    vectors = written(usable(embeddings.dropna(subset=[key]), key, vector), "vectors")
    total = vectors.count()
    if not total:
        return spark.createDataFrame([], schema)
    index = fit(vectors, total, k, sample, recall)
    stored = written(_listed(vectors, index), "lists")
    asked = vectors.join(queries.select(F.col(key).cast("bigint").alias("vec_id")).distinct(), "vec_id", "left_semi")
    asked = written(asked.dropDuplicates(["vec_id"]), "queries")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")

    probing = written(_probing(asked, index, k, False), "probes")
    found = written(ranked(_searched(stored, probing, index, k)), "found")
    full = found.groupBy("query_id").count().filter(F.col("count") >= min(k, total - 1)).select(F.col("query_id").alias("vec_id"))
    short = written(asked.join(full, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return found
    again = ranked(_searched(stored, written(_probing(short, index, k, True), "probes"), index, k))
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(again)
