import numpy as np
import pytest

from tapewright.llm import nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int, vec string, list string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "l", "s") for i, v in rows], SCHEMA)


def brute(vectors, queries, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float32).astype(float)
    out = {}
    for q in queries:
        score = (x * x[ids == q][0]).sum(1)
        order = [o for o in np.lexsort((ids, -score)) if ids[o] != q][:k]
        out[q] = [(int(ids[o]), score[o]) for o in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_few_vectors_are_all_found_and_odd_ones_take_no_part(spark):
    good = {1: [1.0, 0.0], 2: [0.5, 0.5], 3: [0.5, 0.5], 4: [-1.0, 3.0], 5: [2.0, 2.0]}
    odd = [(10, None), (11, [0.0, 0.0]), (12, [None, 1.0]), (13, [float("nan"), 1.0]), (14, [float("inf"), 1.0]), (15, [1.0]), (16, []), (None, [1.0, 1.0])]
    rows = frame(spark, [*good.items(), *odd])
    got = found(nearest.search(rows, rows))
    wanted = brute(good, good, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in wanted.items()}
    assert all(a == pytest.approx(b) for q in got for (_, a), (_, b) in zip(got[q], wanted[q]))


def test_recall_with_a_vector_that_holds_a_third_of_all_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((6000, 32)) * rng.uniform(0.5, 2, (6000, 1))
    x[::3] = x[0]
    vectors = {i: v.astype(np.float32).tolist() for i, v in enumerate(x)}
    rows = frame(spark, list(vectors.items()))
    queries = [i for i in vectors if i % 20 == 0]
    got = found(nearest.search(rows, rows.filter("vec_id % 20 = 0"), sample=3000))
    wanted = brute(vectors, queries, 20)
    assert sorted(got) == queries and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in queries)
    assert hits >= 0.9 * 20 * len(queries)
    # The copies tie; the smaller ids come first.
    assert [i for i, _ in got[60]] == [3 * i for i in range(21) if 3 * i != 60][:20]


def test_the_scan_finds_what_the_radius_holds():
    rng = np.random.default_rng(5)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal((20, 64))
    rotation = np.linalg.qr(rng.standard_normal((65, 65)))[0]
    longest = float(np.sqrt((x * x).sum(1).max()))
    index = nearest.Index(longest, rotation, np.zeros((1, 65)), np.zeros((0, 65)), 1)
    distances = nearest._squares(index.asked(q), index.stored(x))
    radius = np.partition(distances, 40, axis=1)[:, 40]
    i, j = nearest.scan(index, x, q, radius)
    truth = {(a, b) for a, b in zip(*np.nonzero(distances <= radius[:, None]))}
    kept = set(zip(i.tolist(), j.tolist()))
    assert kept <= {(a, b) for a, b in zip(*np.nonzero(distances <= radius[:, None] * (1 + 1e-6)))}
    assert len(kept & truth) >= 0.97 * len(truth)


def test_lists_in_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 8)).astype(np.float32))])
    whole = found(nearest.search(rows, rows.filter("vec_id % 20 = 0"), k=5))
    monkeypatch.setattr(nearest, "CANDIDATES", 64)
    monkeypatch.setattr(nearest, "QUERIES", 4)
    assert found(nearest.search(rows, rows.filter("vec_id % 20 = 0"), k=5)) == whole


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nearest.search(none, none).collect() == []
    only_odd = frame(spark, [(1, None), (2, [0.0])])
    assert nearest.search(only_odd, only_odd).collect() == []
