import hashlib
import math
import random

import numpy as np
import pytest

from tapewright.llm import clusters

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, distance string, x int, ids int"


def slow(rows, k=40, rounds=5, dimensions=64):
    """Plain Lloyd rounds in Python integers: (id, cluster, distance) and the centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimensions and all(c is not None and math.isfinite(c) for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [x for _, x in order[:k]]

    def assign():
        out = []
        for i, x in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(x, y)), c) for c, y in enumerate(centroids))
            out.append((i, c, d, x))
        return out

    for _ in range(rounds):
        now = assign()
        for c in range(len(centroids)):
            own = [x for _, n, _, x in now if n == c]
            if own:
                centroids[c] = [sum(v) // len(own) for v in zip(*own)]
    return [r[:3] for r in assign()] if centroids else [], centroids


def test_equals_plain_rounds(spark):
    rng = random.Random(5)
    centres = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(12)]
    rows = [(n, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]) for n in range(300)]
    rows += [(rng.randrange(300), rows[n % 7][1]) for n in range(150)]  # copies, repeated ids
    rows += [(None, rows[0][1]), (None, rows[1][1]), (900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65),
             (904, [None] + [0.5] * 63), (905, [float("nan")] + [0.5] * 63), (906, [float("inf")] * 64), (907, [0.0] * 64)]
    frame = spark.createDataFrame([(i, v, 1, "c", "d", 3, 4) for i, v in rows], SCHEMA)
    got = clusters.clustered(frame).collect()
    wanted, centroids = slow(rows)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == sorted(wanted, key=str)
    sums = {c: sum(d for _, n, d in wanted if n == c) for c in range(40)}
    assert all(r["centroid"] == centroids[r["cluster"]] and r["cluster_inertia"] == sums[r["cluster"]] for r in got)
    assert {r["inertia"] for r in got} == {sum(sums.values())}


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    frame = spark.createDataFrame([(i, v, 1, "c", "d", 3, 4) for i, v in rows], SCHEMA)
    got = [(r["vec_id"], r["cluster"], r["distance"]) for r in clusters.clustered(frame).collect()]
    assert sorted(got) == sorted(slow(rows)[0])


def test_components_beyond_64_bits_take_no_part(spark):
    frame = spark.createDataFrame([(1, [3e38] * 64, 1, "c", "d", 3, 4), (2, [1.0] * 64, 1, "c", "d", 3, 4)], SCHEMA)
    assert [r["vec_id"] for r in clusters.clustered(frame).collect()] == [2]


def test_loosening_is_a_bound_and_below_the_drift():
    rng = np.random.default_rng(1)
    old = rng.normal(size=(8, 6)) * 10
    new = old + rng.normal(size=(8, 6))
    radius = rng.uniform(0.5, 6, 8)
    loose = clusters.loosening(old, new, radius)
    drift = np.sqrt(((new - old) ** 2).sum(axis=1))
    tighter = 0
    for i in range(8):
        others = [j for j in range(8) if j != i]
        y = rng.normal(size=(4000, 6))
        y = old[i] + radius[i] * rng.uniform(size=(4000, 1)) ** (1 / 6) * y / np.linalg.norm(y, axis=1)[:, None]
        for j in others:
            lost = np.linalg.norm(y - old[j], axis=1) - np.linalg.norm(y - new[j], axis=1)
            assert lost.max() <= loose[i]
        assert loose[i] <= drift[others].max() + 1e-6
        tighter += loose[i] < 0.99 * drift[others].max()
    assert tighter


def test_bounds_spare_most_scans_of_separate_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.uniform(-4, 4, size=(40, 64))
    rows = [(i, (centres[i % 40] + rng.normal(0, 0.05, 64)).tolist(), 1, "c", "d", 3, 4) for i in range(2000)]
    _, _, scanned = clusters.assigned(spark.createDataFrame(rows, SCHEMA))
    assert scanned[0] == 2000 and sum(scanned[3:]) < 2000
