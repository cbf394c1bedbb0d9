import random

import numpy as np
import pytest
import xxhash
from awkward import awkward, docs, none  # noqa: F401

from tapewright.llm import components, simhash


def slow_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, firsts):
    """The smallest first of all that is reachable within three bits."""
    names, left, out = list(prints), set(range(len(prints))), {}
    while left:
        todo = [left.pop()]
        group = list(todo)
        while todo:
            a = todo.pop()
            near = [b for b in left if (prints[names[a]] ^ prints[names[b]]).bit_count() <= 3]
            left -= set(near)
            todo += near
            group += near
        least = min((firsts[names[i]] for i in group if firsts[names[i]] is not None), default=None)
        out |= {names[i]: least for i in group}
    return out


def test_awkward_documents(docs):  # noqa: F811
    rows = awkward()
    prints = {i: slow_fingerprint(r[1]) for i, r in enumerate(rows)}
    wanted = slow_groups(prints, {i: r[0] for i, r in enumerate(rows)})
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(str, got)) == sorted(
        str(type(got[0])(doc_id=r[0], fingerprint=f"{prints[i]:016x}", component_id=wanted[i])) for i, r in enumerate(rows))


def test_one_of_each_group_stays(docs):  # noqa: F811
    got = simhash.representatives(docs)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    wanted = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(ids) == sorted(wanted)


def near(rng, word, bits):
    for b in rng.sample(range(64), bits):
        word ^= 1 << b
    return word


@pytest.mark.parametrize("bucket", [4096, 3])
def test_links_connect_all_that_is_near(spark, bucket):
    """Chains, dense groups and single fingerprints; with small buckets everything goes the finer way."""
    rng = random.Random(bucket)
    words = {rng.getrandbits(64) for _ in range(300)}
    for centre in [rng.getrandbits(64) for _ in range(3)]:
        words |= {near(rng, centre, rng.randint(0, 4)) for _ in range(120)}
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(near(rng, chain[-1], 3))
    words |= set(chain)
    signed = {w: w - (1 << 64) if w >> 63 else w for w in words}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp bigint")
    links = simhash.links(frame, bucket)
    for a, b in links.collect():
        assert 0 < ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    wanted = slow_groups({s: w for w, s in signed.items()}, {s: s for s in signed.values()})
    assert {s: roots.get(s, s) for s in signed.values()} == wanted


def test_a_dense_group_gives_few_links():
    fps = np.arange(1 << 12, dtype=np.int64)
    table = np.stack([np.bitwise_count(fps.view(np.uint64) ^ np.uint64(p)) for p in simhash.PIVOTS], 1).astype(np.uint8)
    assert sum(len(a) for a, _ in simhash._spread(fps, table)) == len(fps) - 1


def test_components_of_long_chains(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 100)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(100)}}


def test_no_rows(none):  # noqa: F811
    assert simhash.near_duplicates(none).collect() == [] and simhash.representatives(none).collect() == []


def test_coordinates_are_differences_of_distances(spark):
    from pyspark.sql import functions as F
    rng = random.Random(8)
    words = [rng.getrandbits(64) for _ in range(50)] + [0, (1 << 64) - 1]
    frame = spark.createDataFrame([(w - (1 << 64) if w >> 63 else w,) for w in words], "fp bigint")
    for w, r in zip(words, frame.select(simhash.coordinates(F.col("fp")).alias("c")).collect()):
        c = r["c"] & (1 << 64) - 1
        for i, pair in enumerate(simhash.PAIRS):
            assert c >> 2 * i & 3 == (w.bit_count() - (w ^ pair).bit_count() + 2) // 2


def test_rows_stay_where_they_are(spark, docs):  # noqa: F811
    plan = simhash.representatives(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_row") and not any("Exchange" in line and "_row" in line for line in plan.splitlines())
    scan = plan.index("Scan parquet spark_catalog.default.rows_")
    assert "Exchange" not in plan[:scan].replace("BroadcastExchange", "").split("SortMergeJoin")[-1] or "Broadcast" in plan[:scan]
