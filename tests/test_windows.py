import datetime as dt

import pytest
from conftest import day, rows

from tapewright.operators import joins
from tapewright.streaming import feeds, windows

FILINGS, NEWS = "id string, filed date", "url string, d date"


def _put(frame, folder, data, ddl):
    frame(data, ddl).coalesce(1).write.mode("append").parquet(str(folder))


def _stream(spark, folder, ddl):
    return feeds.file_stream(spark, str(folder), spark.createDataFrame([], ddl).schema, "parquet", files_per_trigger=1)


def _days(*parts):
    return [(name, day(d)) for name, d in parts]


def test_both_sides_late_and_a_restart(spark, frame, tmp_path):
    """Each side has rows that come after newer ones, each in another run than what they meet."""
    a, b, out, mark = tmp_path / "filings", tmp_path / "news", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        streams = _stream(spark, a, FILINGS), _stream(spark, b, NEWS)
        feeds.to_parquet(windows.near_days(*streams, "filed", "d", "id", "url", 7, "30 days"), out, mark)

    filings, news = [], []

    def put(more, articles):
        filings.extend(more)
        news.extend(articles)
        _put(frame, a, more, FILINGS)
        _put(frame, b, articles, NEWS)
        run()

    put(_days(("f1", "2024-01-10"), ("f2", "2024-01-31")), _days(("n1", "2024-01-12"), ("n2", "2024-01-30")))
    # Behind what has been seen, but within 30 days of it.
    put(_days(("f3", "2024-01-11"), ("f4", "2024-02-20")), _days(("n3", "2024-01-05"), ("n4", "2024-02-27"), ("n5", "2024-01-12")))
    put(_days(("f5", "2024-02-02")), _days(("n6", "2024-02-09"), ("n7", "2024-02-25")))
    stored = frame(filings + _days(("quiet", "2020-01-01")), FILINGS)
    for folder, ddl, time in ((a, FILINGS, "filed"), (b, NEWS, "d")):
        windows.heartbeat(frame([], ddl), time, "2024-06-01").write.mode("append").parquet(str(folder))
    run()
    met = spark.read.schema("id string, day date, n bigint, days_apart int").parquet(out)
    got = windows.coverage(stored, met, "id")
    want = joins.date_window_count(stored, frame(news, NEWS), "filed", "d", 7)
    assert rows(got) == rows(want.select(*got.columns))
    assert dict((r["id"], r["news_count"]) for r in got.collect())["f1"] == 3
    # A run with nothing new adds nothing.
    n = met.count()
    run()
    assert spark.read.parquet(out).count() == n


def test_a_row_behind_the_watermark_is_not_counted(spark, frame, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        feeds.to_parquet(windows.weeks(_stream(spark, source, NEWS), "d", "url", "2 days"), out, mark)

    _put(frame, source, _days(("x", "2024-01-02"), ("x", "2024-02-01")), NEWS)
    run()
    _put(frame, source, _days(("x", "2024-01-03"), ("x", "2024-01-31"), (None, "2024-04-01")), NEWS)
    run()
    # 2024-01-03 came when its week was closed.
    assert rows(spark.read.parquet(out)) == [(day("2024-01-01"), "x", 1), (day("2024-01-29"), "x", 2)]


def _plain_bursts(data, at_least, days):
    out, by = [], {}
    for t, d in data:
        by.setdefault(t, []).append(d)
    for t, its in by.items():
        for d in sorted(set(its)):
            now = sum(d - dt.timedelta(days - 1) <= x <= d for x in its)
            before = sum(d - dt.timedelta(days) <= x <= d - dt.timedelta(1) for x in its)
            if now >= at_least > before:
                out.append((t, d, now))
    return sorted(out, key=repr)


@pytest.mark.parametrize("at_least, days", [(3, 7), (2, 1), (4, 3)])
def test_bursts_fire_once_each_time(spark, frame, tmp_path, at_least, days):
    import random
    rng = random.Random(at_least)
    data = [(rng.choice("ab"), dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(60))) for _ in range(60)]
    data.sort(key=lambda r: r[1])
    late = {i for i, r in enumerate(data[:40]) if rng.random() < 0.1 and r[1] > dt.date(2024, 1, 25)}
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        feeds.to_parquet(windows.bursts(_stream(spark, source, "k string, d date"), "d", "k", at_least, days, "30 days"), out, mark)

    first = [r for i, r in enumerate(data[:40]) if i not in late]
    second = [r for i, r in enumerate(data) if i >= 40 or i in late]
    for part in (first, second, [(None, dt.date(2024, 9, 1))]):
        _put(frame, source, part, "k string, d date")
        run()
    assert rows(spark.read.parquet(out)) == _plain_bursts(data, at_least, days)


def test_a_burst_that_ends_may_come_again(spark, frame, tmp_path):
    days = [1, 2, 3, 4, 20, 21, 22]
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    _put(frame, source, [("k", dt.date(2024, 1, d)) for d in days], "k string, d date")
    _put(frame, source, [(None, dt.date(2024, 6, 1))], "k string, d date")
    feeds.to_parquet(windows.bursts(_stream(spark, source, "k string, d date"), "d", "k", 3, 7, "10 days"), out, mark)
    assert rows(spark.read.parquet(out)) == sorted([("k", day("2024-01-03"), 3), ("k", day("2024-01-22"), 3)], key=repr)


def test_days_of_filings_wait_instead_of_filings(spark, frame, tmp_path):
    a, b, out, mark = tmp_path / "filings", tmp_path / "news", str(tmp_path / "out"), str(tmp_path / "mark")
    filings, news = [], []
    for more, articles in (
            (_days(("f1", "2024-01-10"), ("f2", "2024-01-31"), ("f6", "2024-01-31")), _days(("n1", "2024-01-12"), ("n2", "2024-01-30"))),
            (_days(("f3", "2024-01-11"), ("f4", "2024-02-20")), _days(("n3", "2024-01-05"), ("n4", "2024-02-27"), ("n5", "2024-01-12"))),
            (_days(("f5", "2024-02-02"), (None, "2024-06-01")), _days(("n6", "2024-02-09"), (None, "2024-06-01")))):
        filings.extend(more)
        news.extend(articles)
        _put(frame, a, more, FILINGS)
        _put(frame, b, articles, NEWS)
        streams = _stream(spark, a, FILINGS), _stream(spark, b, NEWS)
        feeds.to_parquet(windows.near_filed_days(*streams, "filed", "d", "id", "url", 7, "30 days"), out, mark)
    stored = frame([f for f in filings if f[0]] + _days(("quiet", "2020-01-01")), FILINGS)
    met = spark.read.schema("filed_day date, day date, n bigint, days_apart int").parquet(out)
    want = joins.date_window_count(stored, frame([n for n in news if n[0]], NEWS), "filed", "d", 7)
    got = windows.day_coverage(stored, met, "filed")
    assert rows(got) == rows(want.select(*got.columns))
    # Two filings of a day are one row for each day with news.
    assert met.groupBy("filed_day", "day").count().filter("count > 1").count() == 0


def test_streamed_parts_are_files_of_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from tapewright.catalogue import streams
    rows_of = spark.range(400).repartition(4).select(F.expr("date_add(DATE '2024-01-01', cast(id % 90 AS int))").alias("d"), "id")
    (first, second), end = streams._dated(rows_of, "d", "id")
    for n, part in enumerate((first, second), 1):
        streams._put(part, str(tmp_path / "in"))
        assert len(list((tmp_path / "in").glob("part-*"))) == 4 * n
    assert streams._a_part(spark, str(tmp_path / "in"), 2) == 4
    assert first.count() + second.count() == 400 and end == "2024-06-28"
