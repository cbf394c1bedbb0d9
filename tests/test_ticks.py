import datetime as dt
import random

import pytest
from conftest import plan_of, rows

from tapewright.operators import joins, ticks

T0 = dt.datetime(2024, 1, 1)


def at(us):
    return T0 + dt.timedelta(microseconds=us)


@pytest.fixture
def ranges(spark):
    """Small ranges, so that one key's line is cut in many."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _line(rng, n, keys):
    return [(i, rng.choice(keys), rng.randrange(400) if rng.random() < 0.95 else None) for i in range(n)]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("by", [("k",), ()])
def test_asof_equals_search(spark, ranges, direction, by):
    rng = random.Random(direction)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = _line(rng, 300, keys)
    points = [(k, t, i if rng.random() < 0.9 else None) for i, k, t in _line(rng, 60, keys)]
    frame = spark.createDataFrame([(i, k, None if t is None else at(t)) for i, k, t in left], "id int, k string, t timestamp")
    line = spark.createDataFrame([(k, None if t is None else at(t), v) for k, t, v in points], "k string, u timestamp, v int")
    got = {r["id"]: (r["matched_at"], r["v"]) for r in ticks.asof_join(frame, line, "t", "u", ["v"], by, direction).collect()}
    assert len(got) == 300
    for i, k, t in left:
        its = {}
        for pk, pt, v in points:
            if pt is not None and (not by or (pk == k and k is not None)):
                its.setdefault(pt, []).append(v)
        known = sorted(its)
        before = [p for p in known if t is not None and p <= t][-1:]
        after = [p for p in known if t is not None and p >= t][:1]
        hit = {"backward": before, "forward": after}.get(direction)
        if hit is None:
            hit = before if before and (not after or t - before[0] <= after[0] - t) else after
        best = max(its[hit[0]], key=lambda v: (v is not None, v or 0)) if hit else None
        assert got[i] == ((at(hit[0]), best) if hit else (None, None)), (i, k, t)


def test_asof_tolerance_and_unknown_direction(spark):
    frame = spark.createDataFrame([(1, at(5_000_000)), (2, at(5_000_001))], "id int, t timestamp")
    line = spark.createDataFrame([(at(0), 9)], "u timestamp, v int")
    assert rows(ticks.asof_join(frame, line, "t", "u", ["v"], tolerance=5).select("id", "v")) == [(1, 9), (2, None)]
    with pytest.raises(ValueError):
        ticks.asof_join(frame, line, "t", "u", ["v"], direction="sideways")


@pytest.mark.parametrize("width", [1, 4, 60])
def test_rolling_mean_across_ranges(spark, ranges, width):
    rng = random.Random(width)
    data = [(i, rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(9) if rng.random() < 0.97 else None) for i in range(400)]
    got = {r["i"]: r["rolling_mean"] for r in ticks.rolling_mean(spark.createDataFrame(data, "i int, k string, v int"), ["k"], ["i"], "v", width).collect()}
    assert len(got) == 400
    seen = {}
    for i, k, v in data:
        line = seen.setdefault(k, [])
        line.append(v)
        last = line[-width:]
        assert got[i] == (sum(last) / width if len(last) == width and None not in last else None), (i, k)


def test_change_carries_over_ranges(spark, ranges):
    rng = random.Random(7)
    data = [(i, rng.choice(["hot"] * 8 + ["a"]), rng.randrange(4) if rng.random() < 0.2 else None) for i in range(400)]
    got = {r["i"]: r["pct_change"] for r in ticks.pct_change(spark.createDataFrame(data, "i int, k string, v int"), ["k"], ["i"], "v").collect()}
    known = {}
    for i, k, v in data:
        then, now = known.get(k), v if v is not None else known.get(k)
        known[k] = now
        assert got[i] == ((now / then - 1) * 100 if then else None), (i, k)


def test_a_hot_line_is_cut(spark, ranges):
    data = [(i, "hot", i % 5) for i in range(5000)]
    cut = ticks._cut(spark.createDataFrame(data, "i int, k string, v int"), ["k"], ["i"])
    sizes = [r["count"] for r in cut.groupBy("_range").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2500


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join_equals_pairs(spark, how):
    rng = random.Random(11)
    day = lambda n: None if n is None else dt.date(1999, 12, 1) + dt.timedelta(days=n)
    bands = [(i, rng.choice([rng.randrange(-500, 900), None]) if i % 9 == 0 else rng.randrange(-500, 900)) for i in range(120)]
    bands = [(i, s, None if i % 7 == 0 else (s or 0) + rng.choice([0, -1, 1, 6, 7, 8, 63, 64, 365, 4000])) for i, s in bands]
    data = [(i, rng.choice([None, *[rng.randrange(-600, 1200)] * 12])) for i in range(300)]
    got = rows(joins.interval_join(
        spark.createDataFrame([(i, day(d)) for i, d in data], "i int, d date"),
        spark.createDataFrame([(i, day(s), day(e)) for i, s, e in bands], "band int, s date, e date"), "d", "s", "e", ["band"], how).select("i", "band"))
    want = []
    for i, d in data:
        hit = [b for b, s, e in bands if d is not None and (s is None or s <= d) and (e is None or d <= e)
               and not (s is not None and e is not None and s > e)]
        want += [(i, b) for b in hit] or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=repr)


def test_interval_join_to_the_microsecond_and_without_loops(spark):
    bands = spark.createDataFrame([("a", at(1_500_000), at(1_700_000)), ("b", at(0), at(90_000_000_000)), ("c", at(5), at(4))], "band string, s timestamp, e timestamp")
    data = spark.createDataFrame([(i, at(i)) for i in (1_499_999, 1_500_000, 1_700_000, 1_700_001, 90_000_000_001, 0, -1)], "i long, t timestamp")
    found = joins.interval_join(data, bands, "t", "s", "e", ["band"], "inner")
    assert rows(found.select("i", "band")) == sorted(
        [(0, "b"), (1_499_999, "b"), (1_500_000, "a"), (1_500_000, "b"), (1_700_000, "a"), (1_700_000, "b"), (1_700_001, "b")], key=repr)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_interval_join_writes_an_interval_with_all_rows_of_a_time(spark):
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(days=n)
    data = spark.createDataFrame([(i, day(i % 3) if i % 10 else None) for i in range(200)], "i int, d date")
    bands = spark.createDataFrame([(b, day(0), day(b % 2)) for b in range(40)], "band int, s date, e date")
    got = [(r["d"], r["band"]) for r in joins.interval_join(data, bands, "d", "s", "e", ["band"]).collect()]
    inside = [x for x in got if x[1] is not None]
    assert len(inside) == 40 * 60 + 20 * 60 and len(got) - len(inside) == 200 - 120
    # Runs of equal time and interval are as few as they can be, so the pairs pack well.
    assert sum(a != b for a, b in zip(inside, [None, *inside])) == len(set(inside)) == 60


def test_nodes_of_a_long_interval_are_few(spark):
    from pyspark.sql import functions as F
    frame = spark.range(1).select(F.lit(-719162).cast("bigint").alias("a"), F.lit(2932896).cast("bigint").alias("b"))
    nodes = frame.select(F.inline(joins._nodes(F.col("a"), F.col("b")))).collect()
    covered = sorted((n["node"] * 8 ** n["level"], (n["node"] + 1) * 8 ** n["level"]) for n in nodes)
    assert len(nodes) <= 14 * 8 and covered[0][0] == -719162 and covered[-1][1] == 2932897
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))




def test_interval_totals_equal_pairs(spark):
    rng = random.Random(5)
    micros = lambda: rng.choice([rng.randrange(3_000_000), rng.randrange(40_000_000_000)])
    bands = [(i, rng.randrange(9), None if i % 11 == 0 else micros()) for i in range(150)]
    bands = [(i, u, s, None if i % 13 == 0 else (s or 0) + rng.choice([-1, 0, 1, 400_000, 2_000_000, 9_000_000_000])) for i, u, s in bands]
    data = [(i, None if i % 40 == 0 else rng.choice([micros(), *[x for b in bands for x in b[2:] if x is not None][:60]])) for i in range(200)]
    moment = lambda us: None if us is None else at(us)
    totals = {"n": ("count", "band"), "least": ("min", "band"), "most": ("max", "band"), "users": ("sum", "u")}
    found = {how: joins.interval_totals(
        spark.createDataFrame([(i, moment(t)) for i, t in data], "i int, t timestamp"),
        spark.createDataFrame([(i, u, moment(s), moment(e)) for i, u, s, e in bands], "band int, u int, s timestamp, e timestamp"),
        "t", "s", "e", totals, how) for how in ("inner", "left")}
    want = []
    for i, t in data:
        hit = [(b, u) for b, u, s, e in bands if t is not None and (s is None or s <= t) and (e is None or t <= e)]
        if hit:
            want.append((i, len(hit), min(hit)[0], max(hit)[0], sum(u for _, u in hit)))
    assert rows(found["inner"].drop("t")) == sorted(want, key=repr)
    empty = [(i, None, None, None, None) for i, _ in data if i not in {w[0] for w in want}]
    assert empty and rows(found["left"].drop("t")) == sorted(want + empty, key=repr)
    assert "NestedLoop" not in plan_of(found["inner"])
