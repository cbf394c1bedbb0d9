import datetime as dt
import random

import pandas as pd
import pytest
from conftest import day, plan_of, rows

from pyspark.sql import functions as F

from tapewright.operators import joins

LEFT = "id int, k string, d date"
RIGHT = "k string, n date"


def _random(seed, n, days=40):
    rng = random.Random(seed)
    start = dt.date(2023, 12, 20)
    keys = ["a", "b", None]
    return [(i, rng.choice(keys), start + dt.timedelta(rng.randrange(days)) if rng.random() > 0.1 else None)
            for i in range(n)]


@pytest.mark.parametrize("n_days", [1, 7, 14])
@pytest.mark.parametrize("on", [[], ["k"]])
def test_window_counts_equal_the_theta_join(frame, n_days, on):
    left, right = _random(1, 60), [(k, d) for _, k, d in _random(2, 25)]
    want = []
    for i, k, d in left:
        gaps = [
            abs((d - n).days) for rk, n in right
            if d and n and abs((d - n).days) <= n_days and (not on or (k is not None and k == rk))
        ]
        want.append((i, len(gaps), min(gaps) if gaps else None))
    got = joins.date_window_count(frame(left, LEFT), frame(right, RIGHT), "d", "n", n_days, on)
    assert rows(got.select("id", "news_count", "min_days_apart")) == sorted(want, key=repr)


def test_unmatched_counts_zero_and_edges_are_included(frame):
    left = frame([(1, "a", day("2024-03-10")), (2, "a", day("2024-06-01"))], LEFT)
    right = frame([("a", day("2024-03-03")), ("a", day("2024-03-17")), ("a", day("2024-03-18"))], RIGHT)
    got = joins.date_window_count(left, right, "d", "n").select("id", "news_count", "min_days_apart")
    assert rows(got) == [(1, 2, 7), (2, 0, None)]


def test_coarser_grain_counts_distinct_events(frame):
    left = frame([(1, "a", day("2024-03-10")), (2, "a", day("2024-03-10"))], LEFT)
    right = frame([("a", day("2024-03-10"))], RIGHT)
    got = joins.date_window_count(left, right, "d", "n", by=["k", "d"])
    assert rows(got.select("k", "news_count")) == [("a", 1)]


def test_weighted_days_add_up(frame):
    left = frame([(1, "a", day("2024-03-10"))], LEFT)
    right = frame([(day("2024-03-09"), 5), (day("2024-03-09"), 2)], "n date, w bigint")
    got = joins.date_window_count(left, right, "d", "n", weight="w")
    assert rows(got.select("news_count", "min_days_apart")) == [(7, 1)]


@pytest.mark.parametrize("on", [[], ["k"]])
def test_no_nested_loops(frame, on):
    left, right = frame([(1, "a", day("2024-03-10"))], LEFT), frame([("a", day("2024-03-10"))], RIGHT)
    plan = plan_of(joins.date_window_count(left, right, "d", "n", 7, on))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
def test_asof_equals_pandas(frame, direction):
    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    points = sorted(rng.sample(range(100), 20))
    line = [(start + dt.timedelta(p), None if p % 7 == 0 else float(p)) for p in points]
    days = [(i, start + dt.timedelta(rng.randrange(-5, 110))) for i in range(50)]
    left = pd.DataFrame(days, columns=["id", "d"]).assign(d=lambda x: pd.to_datetime(x.d)).sort_values("d")
    right = pd.DataFrame(line, columns=["s", "v"]).assign(s=lambda x: pd.to_datetime(x.s))
    want = pd.merge_asof(left, right, left_on="d", right_on="s", direction=direction)
    want = {r.id: (None if pd.isna(r.s) else r.s.date(), None if pd.isna(r.v) else r.v) for r in want.itertuples()}
    got = joins.asof_join(
        frame(days, "id int, d date"), frame(line, "s date, v double"), "d", "s", ["v"], direction=direction
    )
    assert {r.id: (r.matched_date, r.v) for r in got.collect()} == want


def test_asof_ties_duplicates_and_tolerance(frame):
    line = frame(
        [("a", day("2024-01-01"), 1.0, 1), ("a", day("2024-01-01"), 9.0, 2), ("a", day("2024-01-05"), 5.0, 1),
         ("b", day("2024-02-01"), 7.0, 1)], "k string, s date, v double, o int")
    left = frame([("a", day("2024-01-03")), ("a", day("2024-01-20")), ("b", day("2024-02-03")), ("c", day("2024-02-03")),
                  ("a", None)], "k string, d date")
    got = joins.asof_join(left, line, "d", "s", ["v"], by=["k"], tolerance=3, last_by=["o"]).select("k", "d", "v")
    want = [("a", day("2024-01-03"), 9.0), ("a", day("2024-01-20"), None), ("b", day("2024-02-03"), 7.0),
            ("c", day("2024-02-03"), None), ("a", None, None)]
    assert rows(got) == sorted(want, key=repr)


def test_asof_rejects_other_directions(frame):
    df = frame([(day("2024-01-01"), 1.0)], "d date, v double")
    with pytest.raises(ValueError):
        joins.asof_join(df, df, "d", "d", ["v"], direction="sideways")


def test_interval_tag_includes_both_ends_and_needs_no_join(frame):
    bands = [("2001-03-01", "2001-11-01", "one"), ("2001-11-01", "2001-12-01", "two")]
    df = frame([(day(d),) for d in ("2001-02-28", "2001-03-01", "2001-11-01")] + [(None,)], "d date")
    got = joins.interval_tag(df, "d", bands)
    assert rows(got) == sorted([
        (day("2001-02-28"), None), (day("2001-03-01"), "one"), (day("2001-11-01"), "one"),
        (day("2001-11-01"), "two"), (None, None)], key=repr)
    assert "Join" not in plan_of(got)


def test_lookups(frame):
    facts = frame([("aapl",), ("zzz",)], "t string")
    dim = frame([("AAPL", 320193), ("MSFT", 12345678901)], "ticker string, cik_str bigint")
    assert rows(joins.padded_lookup(facts, dim, "t", "ticker", "cik_str")) == [("aapl", "0000320193")]
    names = frame([("DFF", "Funds")], "code string, name string")
    named = joins.name_lookup(frame([("DFF",), ("X",)], "code string"), names, "code", "name")
    assert rows(named) == [("DFF", "Funds"), ("X", "X")]


def test_member_filter_with_and_without_a_pick(frame):
    facts = frame([("a", 1), ("b", 2), ("c", 3)], "t string, v int")
    groups = frame([("g", "a"), ("g", "b"), ("h", "c")], "grp string, t string")
    assert rows(joins.member_filter(facts, groups, "t", "t", "grp", "g")) == [("a", 1), ("b", 2)]
    assert rows(joins.member_filter(facts, groups, "t", "t", "grp", "g", ["b", "c"])) == [("b", 2)]


def test_hot_key_join_is_whole(spark):
    """A third of both sides on one key."""
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 30).cast("int")).alias("d"))
    got = joins.date_window_count(left, left.select("k", F.col("d").alias("n")), "d", "n", 1, ["k"])
    local = left.toPandas()
    per_day = local[local.k == "hot"].groupby("d").size()
    want = {d: sum(per_day.get(d + dt.timedelta(o), 0) for o in (-1, 0, 1)) for d in per_day.index}
    hot = got.filter("k = 'hot'").select("d", "news_count").distinct().collect()
    assert {r.d: r.news_count for r in hot} == want
    assert got.count() == 3000


def test_hot_lookup_key_is_split_at_run_time(spark):
    """With broadcasts off, the partition of a key that holds a third of all rows is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string").alias("k"), "id")
        dim = spark.range(0, 60_000, 1, 4).select(F.col("id").cast("string").alias("code"), (F.col("id") * 2).alias("v"))
        joined = joins.lookup(facts, dim, "k", "code")
        assert joined.count() == 60_000
        got = joined.groupBy("k").agg(F.sum(F.col("v") + F.col("id")).alias("s"))
        got.collect()
        assert "skew=true" in plan_of(got)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
