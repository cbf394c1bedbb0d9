import datetime as dt
import re
import math

import numpy as np
import pandas as pd
import pytest
from conftest import day, plan_of, rows


from tapewright.operators import correlation, series

VALUES = [5.0, None, 7.0, 7.5, 0.0, 3.0, None, None, 9.0, 1.25]
LINE = [("s", dt.date(2024, 1, 1) + dt.timedelta(i), v) for i, v in enumerate(VALUES)]
SCHEMA = "k string, d date, v double"


def _column(df, name):
    return [r[name] for r in df.orderBy("d").collect()]


def _same(got, want):
    for g, w in zip(got, want, strict=True):
        if w is None or (isinstance(w, float) and math.isnan(w)):
            assert g is None
        else:
            assert g == pytest.approx(w, abs=1e-9)


@pytest.mark.parametrize("width", [1, 2, 3, 20])
def test_rolling_mean_equals_pandas(frame, width):
    got = series.rolling_mean(frame(LINE, SCHEMA), ["k"], "d", "v", width)
    _same(_column(got, "rolling_mean"), pd.Series(VALUES, dtype=float).rolling(width).mean())


def test_rolling_mean_off(frame):
    assert series.rolling_mean(frame(LINE, SCHEMA), ["k"], "d", "v", 0).columns == ["k", "d", "v"]


def test_pct_change_carries_forward_and_gives_null_for_a_zero_base(frame):
    want = pd.Series(VALUES, dtype=float).ffill().pct_change() * 100
    want = [None if math.isinf(x) else x for x in want]
    _same(_column(series.pct_change(frame(LINE, SCHEMA), ["k"], "d", "v"), "pct_change"), want)
    plain = series.pct_change(frame(LINE, SCHEMA), ["k"], "d", "v", fill=False)
    assert _column(plain, "pct_change")[2] is None


def test_rebase(frame):
    got = series.rebase(frame(LINE, SCHEMA), ["k"], "d", "v")
    assert _column(got, "rebased")[:3] == [100.0, None, 140.0]
    zero = frame([("z", day("2024-01-01"), 0.0), ("z", day("2024-01-02"), 4.0)], SCHEMA)
    assert _column(series.rebase(zero, ["k"], "d", "v"), "rebased") == [None, None]


def test_latest_previous_and_direction(frame):
    data = [("a", day("2024-01-01"), -2.0), ("a", day("2024-01-02"), -1.0), ("b", day("2024-01-01"), 3.0),
            ("c", day("2024-01-01"), 4.0), ("c", day("2024-01-03"), 4.0), ("z", day("2024-01-01"), 0.0),
            ("z", day("2024-01-02"), 1.0)]
    both = series.latest_and_previous(frame(data, SCHEMA), ["k"], "d", "v")
    got = {r.k: r for r in series.with_change(both, "latest", "prev").collect()}
    assert (got["a"].change, got["a"].pct, got["a"].direction) == (1.0, 50.0, "up")
    assert (got["b"].prev, got["b"].direction) == (None, None)
    assert got["c"].direction == "flat"
    assert got["z"].pct is None
    assert {r.k: r.direction for r in series.with_change(both, "latest", "prev", "down").collect()}["c"] == "down"


def test_period_stats(frame):
    got = series.period_stats(frame(LINE, SCHEMA), ["k"], "d", "v").first()
    assert (got.first_value, got.last_value, got.high, got.low, got.n) == (5.0, 1.25, 9.0, 0.0, 10)
    assert (got.change, got.pct) == (-3.75, -75.0)
    zero = frame([("z", day("2024-01-01"), 0.0), ("z", day("2024-01-02"), 4.0)], SCHEMA)
    assert series.period_stats(zero, ["k"], "d", "v").first().pct == 0.0


@pytest.mark.parametrize("members", [None, ["s", "same"]])
def test_histogram_equals_numpy(frame, members):
    values = [float(x) for x in np.random.default_rng(3).normal(size=500).round(3)]
    data = [("s", v) for v in values] + [("same", 2.0)] * 3 + [("s", None)]
    got = series.histogram(frame(data, "k string, v double"), "k", "v", 50, members).collect()
    counts, _ = np.histogram(values, 50)
    assert {r.bin: r.n for r in got if r.k == "s"} == {i: c for i, c in enumerate(counts) if c}
    assert [(r.bin, r.n) for r in got if r.k == "same"] == [(0, 3)]


def test_histogram_of_members_exchanges_no_raw_rows(frame):
    plan = plan_of(series.histogram(frame([("a", 1.0)], "k string, v double"), "k", "v", members=["a"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_month_end_takes_the_last_known_value(frame):
    data = [("a", day("2024-01-05"), 1.0), ("a", day("2024-01-30"), None), ("a", day("2024-02-01"), 3.0)]
    got = series.month_end(frame(data, SCHEMA), ["k"], "d", "v")
    assert rows(got) == [("a", day("2024-01-31"), 1.0), ("a", day("2024-02-29"), 3.0)]


def test_bars(frame):
    ts = lambda s: dt.datetime.fromisoformat(f"2024-01-01T{s}")
    ticks = [("x", ts("09:00:00"), 2, 10.0), ("x", ts("09:00:00"), 1, 11.0), ("x", ts("17:00:00"), 3, 9.0)]
    df = frame(ticks, "k string, t timestamp, i int, p double")
    assert rows(series.bars(df, "k", "t", "p", ["i"])) == [("x", day("2024-01-01"), 11.0, 11.0, 9.0, 9.0, 3, 10.0)]


def test_measure_is_checked():
    with pytest.raises(ValueError):
        series.measure("close; drop")


def test_pivot_and_sparse_rows(frame):
    data = [("a", day("2024-01-01"), 1.0), ("a", day("2024-01-01"), 3.0), ("b", day("2024-01-01"), 4.0),
            ("b", day("2024-01-02"), 5.0)]
    wide = series.pivot_mean(frame(data, SCHEMA), "d", "k", "v", {"a": "x", "b": "y"})
    assert rows(wide) == [(day("2024-01-01"), 2.0, 4.0), (day("2024-01-02"), None, 5.0)]
    assert rows(series.drop_sparse(wide, ["x", "y"], 2)) == [(day("2024-01-01"), 2.0, 4.0)]


def test_week_labels_at_new_year(frame):
    df = frame([(day("2024-12-30"),), (day("2024-07-01"),)], "d date")
    assert rows(series.weekly_counts(df, "d")) == [("2024-W27", 1), ("2025-W01", 1)]
    assert rows(series.weekly_counts(df, "d", compat=True)) == [("2024-W01", 1), ("2024-W27", 1)]


def _prices(seed, gaps):
    rng = np.random.default_rng(seed)
    out = []
    for k in ("a", "b", "c", "d"):
        level = 100.0
        for i in range(60):
            level *= 1 + rng.normal() / 50
            if rng.random() > gaps:
                out.append((k, dt.date(2024, 1, 1) + dt.timedelta(i), round(level, 4)))
    return out


@pytest.mark.parametrize("gaps", [0.0, 0.2])
def test_return_corr_equals_pandas(frame, gaps):
    data = _prices(7, gaps)
    pdf = pd.DataFrame(data, columns=["k", "d", "v"])
    want = pdf.pivot_table(index="d", columns="k", values="v").ffill().pct_change().dropna()
    corr = want.corr()
    got = correlation.return_corr(frame(data, SCHEMA), "k", "d", "v", ["a", "b", "c", "d"]).collect()
    assert len(got) == 6
    for r in got:
        assert r.n == len(want)
        assert r["corr"] == pytest.approx(corr.loc[r.a, r.b], abs=1e-9)


def test_monthly_corr_equals_pandas(frame):
    rng = np.random.default_rng(9)
    data = [(k, dt.date(2023, 1, 1) + dt.timedelta(i), float(rng.normal() + 1e5))
            for k in "abcd" for i in range(0, 500, 3) if not (k == "d" and i < 200)]
    pdf = pd.DataFrame(data, columns=["k", "d", "v"]).assign(d=lambda x: pd.to_datetime(x.d))
    wide = pdf.pivot_table(index="d", columns="k", values="v").resample("ME").last().dropna(thresh=4)
    corr = wide.corr()
    got = correlation.monthly_corr(frame(data, SCHEMA), "k", "d", "v", list("abcd"), 4).collect()
    for r in got:
        assert r["corr"] == pytest.approx(corr.loc[r.a, r.b], abs=1e-6)
        assert -1 <= r["corr"] <= 1


def test_constant_series_and_single_points_have_no_correlation(frame):
    wide = [(1.0, 0.1, None), (2.0, 0.1, 3.0), (4.0, 0.1, None)]
    long = frame([(i, m, v) for i, row in enumerate(wide) for m, v in enumerate(row)], "i int, m int, v double")
    got = {(r.a, r.b): (r.n, r["corr"]) for r in correlation.pairwise(long, "i", "m", "v", ["x", "y", "z"]).collect()}
    assert got == {("x", "y"): (3, None), ("x", "z"): (1, None), ("y", "z"): (1, None)}


def test_no_pair_rows_are_emitted(frame):
    plan = plan_of(correlation.return_corr(frame(LINE, SCHEMA), "k", "d", "v", ["s", "t"]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_members_in_blocks(frame):
    """Three hundred members: several blocks, the same plan as for two but for the list of names."""
    rng = np.random.default_rng(4)
    common = rng.normal(size=40)
    names = [f"m{i:03d}" for i in range(300)]
    x = {n: common * rng.normal() + rng.normal(size=40) for n in names}
    data = [(n, day("2024-01-01") + dt.timedelta(i), float(v)) for n in names for i, v in enumerate(x[n]) if (i + len(n)) % 39]
    few, many = (correlation.monthly_corr(frame(data, SCHEMA), "k", "d", "v", m, 1) for m in (names[:2], names))
    strip = lambda plan: re.sub(r"\[[^]]*\]|#\d+|\d+", "", plan_of(plan))
    assert len(strip(few).split("\n")) == len(strip(many).split("\n"))
    rows_ = frame([(i, m, float(v)) for m, n in enumerate(names) for i, v in enumerate(x[n])], "i int, m int, v double")
    got = {(r.a, r.b): r["corr"] for r in correlation.pairwise(rows_, "i", "m", "v", names).collect()}
    want = np.corrcoef(np.stack([x[n] for n in names]))
    assert len(got) == 300 * 299 // 2
    assert max(abs(got[names[a], names[b]] - want[a, b]) for a in range(300) for b in range(a + 1, 300)) < 1e-9


def test_mean_rank_is_ascending(frame):
    df = frame([("a", 5), ("b", 1), ("b", 2)], "k string, v int")
    assert [tuple(r) for r in series.mean_rank(df, "k", "v", "m").collect()] == [("b", 1.5), ("a", 5.0)]


def test_one_per_day_averages_repeated_days(frame):
    df = frame([("a", day("2024-01-01"), 1.0), ("a", day("2024-01-01"), 2.0)], SCHEMA)
    assert rows(series.one_per_day(df, ["k"], "d", "v")) == [("a", day("2024-01-01"), 1.5)]


def test_rebase_on_a_first_value_of_zero(frame):
    data = [("z", day(f"2024-01-0{i}"), v) for i, v in enumerate([0.0, 4.0, -2.0, None], 1)] + [("m", day("2024-01-01"), -0.0), ("m", day("2024-01-02"), 4.0)]
    got = [r.rebased for r in series.rebase(frame(data, SCHEMA), ["k"], "d", "v", ieee=True).orderBy("k", "d").collect()]
    assert math.isnan(got[0]) and got[1] == -math.inf
    assert math.isnan(got[2]) and got[3:] == [math.inf, -math.inf, None]
