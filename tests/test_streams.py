import datetime as dt

import pytest
from conftest import day, rows

from tapewright import session, sinks
from tapewright.operators import clean, joins, merge
from tapewright.plans import loads
from tapewright.sinks import store
from tapewright.streaming import feeds

KV = "k string, v int"


def _publish(frame, folder, name, data, ddl=KV):
    """One more file in a growing folder."""
    frame(data, ddl).coalesce(1).write.mode("append").json(str(folder / name))


def _stream(spark, folder, ddl=KV, **options):
    from pyspark.sql.types import _parse_datatype_string

    return feeds.file_stream(spark, str(folder / "*"), _parse_datatype_string(ddl), "json", **options)


def test_ingest_goes_on_where_it_stopped(spark, frame, tmp_path):
    ddl = "series_code string, date string, value double"
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        feeds.ingest(feeds.file_stream(spark, str(source / "*")), "market", out, mark)
        return rows(loads.table(spark, out, "market").selectExpr("series_code", "date", "double(value)"))

    _publish(frame, source, "a", [("s", "2024-01-01", 1.0), ("t", "2024-01-01", None)], ddl)
    assert run() == [("s", day("2024-01-01"), 1.0)]
    _publish(frame, source, "b", [("u", "2024-01-01", 2.0), ("s", "2024-1-1", 9.0), ("v", "bad", 1.0)], ddl)
    assert run() == [("s", day("2024-01-01"), 1.0), ("u", day("2024-01-01"), 2.0)]
    assert run() == [("s", day("2024-01-01"), 1.0), ("u", day("2024-01-01"), 2.0)]


WIRE = {
    "news": [{"url": "u", "title": " T ", "published_at": "2024-01-02T03:00:00Z"}, {"url": None, "title": "t"}],
    "filings": [{"accession_number": "1", "form_type": "8-K", "filed_at": "2024-01-02", "fetched_at": "2024-01-03T00:00:00"},
                {"accession_number": None}],
    "market": [{"series_code": "s", "date": "2024-01-02", "value": 1.5}, {"series_code": "s", "date": "bad", "value": 1.5}],
    "prices": [{"ticker": "a", "date": "2024-01-02", "close": 1.5, "volume": 3}, {"ticker": "a", "date": "2024-01-03"}],
}
BATCH = {"news": clean.clean_news, "filings": clean.clean_filings, "market": clean.clean_market, "prices": clean.clean_prices}


@pytest.mark.parametrize("feed", list(WIRE))
def test_streamed_feed_equals_batch(spark, frame, tmp_path, feed):
    schema = loads.FEEDS[feed].wire
    data = [tuple(r.get(f.name) for f in schema) for r in WIRE[feed] + WIRE[feed]]
    sinks.publish_files(frame(data, schema), str(tmp_path / "in"))
    feeds.ingest(feeds.file_stream(spark, str(tmp_path / "in")), feed, str(tmp_path / "out"), str(tmp_path / "mark"))
    want = clean.conform(BATCH[feed](frame(data, schema)), loads.FEEDS[feed].table, sinks.CLIPPED)
    got = loads.table(spark, str(tmp_path / "out"), feed)
    assert rows(got.select(*want.columns)) == rows(want)
    assert got.count() == 1


def test_four_runs_equal_one_batch(spark, frame, tmp_path):
    """Late rows, rows without a load time and copies far apart: nothing depends on a clock."""
    ddl = "series_code string, date string, value double, fetched_at string"
    files = [
        [("X", "2024-06-01", 1.0, "2024-06-01T00:00:00")], [("OLD", "2024-01-01", 2.0, "2024-01-01T00:00:00")],
        [("NF", "2024-06-02", 3.0, None)], [("AFTER", "2024-06-03", 4.0, "2024-06-03T00:00:00"), ("X", "2024-06-01", 9.0, "2024-11-01T00:00:00")],
    ]
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    for i, data in enumerate(files):
        _publish(frame, source, str(i), data, ddl)
        feeds.ingest(feeds.file_stream(spark, str(source / "*")), "market", out, mark)
    got = rows(loads.table(spark, out, "market").selectExpr("series_code", "double(value)"))
    once = str(tmp_path / "once")
    messages = frame([r for f in files for r in f], ddl).selectExpr("to_json(struct(*)) AS value")
    loads.load_market(spark, messages, once)
    assert got == rows(loads.table(spark, once, "market").selectExpr("series_code", "double(value)"))
    assert got == [("AFTER", 4.0), ("NF", 3.0), ("OLD", 2.0), ("X", 1.0)]


@pytest.mark.parametrize("spread", [False, True])
def test_dedupe_across_runs(spark, frame, tmp_path, spread):
    ddl = "k string, t timestamp"
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    at = lambda d: dt.datetime(2024, 1, d)

    def run():
        unique = feeds.dedupe(_stream(spark, source, ddl), ["k"], "t", "30 days", spread)
        feeds.to_parquet(unique.select("k"), out, mark)
        return rows(spark.read.parquet(out))

    _publish(frame, source, "a", [("a", at(1)), ("a", at(2)), ("a", at(2)), ("b", at(1))], ddl)
    assert run() == [("a",), ("b",)]
    _publish(frame, source, "b", [("a", at(3)), ("c", at(3))], ddl)
    assert run() == [("a",), ("b",), ("c",)]


def test_merge_per_batch(spark, frame, tmp_path):
    source, path, mark = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "mark")
    schema = frame([], KV).schema
    store.insert_new(spark, path, schema, frame([("a", 1)], KV), ["k"], "k")
    _publish(frame, source, "a", [("a", 9), ("b", 2)])
    _publish(frame, source, "b", [("c", 4), ("c", 3)])
    feeds.merge_into(spark, _stream(spark, source, files_per_trigger=1), path, schema, ["k"], "k", mark)
    assert rows(store.read(spark, path, schema)) == [("a", 1), ("b", 2), ("c", 3)]


def test_upsert_per_batch(spark, frame, tmp_path):
    ddl = "k string, v int, part string"
    source, path, mark = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "mark")
    stored = frame([("a", 1, "p"), ("b", 1, "q")], ddl)
    store.replace_parts(spark, path, stored.schema, stored, "part", lambda old, new: merge.upsert(old, new, ["k"]))
    _publish(frame, source, "a", [("a", 2, "p")], ddl)
    _publish(frame, source, "b", [("c", 3, "q")], ddl)
    feeds.upsert_into(
        spark, _stream(spark, source, ddl, files_per_trigger=1), path, stored.schema, "part",
        lambda old, new: merge.upsert(old, new, ["k"]), mark,
    )
    assert rows(store.read(spark, path, stored.schema)) == [("a", 2, "p"), ("b", 1, "q"), ("c", 3, "q")]


def test_streamed_window_counts_equal_the_batch_join(spark, frame, tmp_path):
    news = [(day("2024-01-01"),)] * 3 + [(day("2024-01-09"),), (None,)]
    source, counts, mark = tmp_path / "in", str(tmp_path / "counts"), str(tmp_path / "mark")
    for i, row in enumerate(news):
        _publish(frame, source, str(i), [row], "d date")
    feeds.count_days(_stream(spark, source, "d date", files_per_trigger=2), "d", counts, mark)
    assert spark.read.schema(feeds.DAILY_COUNTS).parquet(counts).select("batch_id").distinct().count() > 1
    filings = frame([(1, day("2024-01-05")), (2, day("2024-03-01")), (3, None)], "id int, f date")
    got = feeds.window_counts(spark, filings, "f", counts, 5)
    want = joins.date_window_count(filings, frame(news, "d date"), "f", "d", 5)
    assert rows(got) == rows(want)
    assert rows(got.filter("id = 1").select("news_count", "min_days_apart")) == [(4, 4)]


def test_a_replayed_batch_of_counts_adds_nothing(spark, frame, tmp_path):
    source, counts = tmp_path / "in", str(tmp_path / "counts")
    _publish(frame, source, "a", [(day("2024-01-01"),)], "d date")
    for mark in ("one", "two"):  # a lost checkpoint replays batch 0
        feeds.count_days(_stream(spark, source, "d date"), "d", counts, str(tmp_path / mark))
    assert rows(spark.read.schema(feeds.DAILY_COUNTS).parquet(counts).select("day", "n")) == [(day("2024-01-01"), 1)]


def test_weekly_counts_have_open_weeks_and_late_rows(spark, frame, tmp_path):
    ddl = "k string, t timestamp"
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    at = lambda d: dt.datetime(2024, 1, d)
    for i, data in enumerate([[("a", at(1)), ("b", at(8)), ("a", at(16))], [("a", at(7)), ("a", None)]]):
        _publish(frame, source, str(i), data, ddl)
        feeds.count_weeks(_stream(spark, source, ddl), "t", "k", out, mark)
    assert sorted(map(tuple, feeds.week_counts(spark, "k", out).collect())) == [
        (day("2024-01-01"), "a", 2), (day("2024-01-08"), "b", 1), (day("2024-01-15"), "a", 1)]


def test_alerts_are_the_same_for_batch_and_stream(spark, frame, tmp_path):
    ddl = "ticker string, filed_at date, form_type string"
    data = [("a", day("2024-01-30"), "8-K"), ("a", day("2024-01-30"), "10-K"), ("z", day("2024-01-30"), "8-K"),
            ("a", day("2023-01-30"), "8-K")]
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    _publish(frame, source, "a", data, ddl)
    args = (["a"], day("2024-01-31"), 30, "8-K")
    feeds.to_parquet(feeds.alerts(_stream(spark, source, ddl), *args), out, mark)
    want = feeds.alerts(frame(data, ddl), *args)
    assert rows(spark.read.parquet(out).select(*want.columns)) == rows(want) == [data[0]]


def test_shared_folder_needs_the_cluster_setting(spark, monkeypatch):
    folder = session.shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != session.shared_folder(spark, "x")

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    for master in ("yarn", "local-cluster[2,1,1024]"):
        Cluster.sparkContext.master = master
        with pytest.raises(ValueError):
            session.shared_folder(Cluster, "x")


def test_streamed_feed_keeps_rejects_bodies_and_whole_titles(spark, frame, tmp_path):
    """Stream equals batch for table, documents and rejects; a replayed batch adds nothing to any of them."""
    import json

    messages = [
        json.dumps({"url": "u1", "title": "t" * 800, "content": "body " * 200, "published_at": "2024-01-02T00:00:00Z"}),
        json.dumps({"url": "u2"}), "not json", json.dumps({"title": "no address"}),
    ]
    source = tmp_path / "in"
    frame([(m,) for m in messages], "value string").coalesce(1).write.text(str(source))
    table, docs, rejects = (str(tmp_path / n) for n in ("table", "docs", "rejects"))
    for mark in ("mark", "mark"):
        feeds.ingest(feeds.file_stream(spark, str(source)), "news", table, str(tmp_path / mark), docs, rejects)
    batch = [str(tmp_path / f"b-{n}") for n in ("table", "docs", "rejects")]
    loads.load_news(spark, frame([(m,) for m in messages], "value string"), *batch)
    assert rows(loads.table(spark, table, "news")) == rows(loads.table(spark, batch[0], "news"))
    assert rows(loads.articles(spark, docs)) == rows(loads.articles(spark, batch[1]))
    refused = feeds.rejected(spark, rejects)
    assert rows(refused.drop("batch_id")) == rows(spark.read.parquet(batch[2]))
    assert refused.count() == 3
    whole = loads.articles(spark, docs).first()
    assert len(whole["title"]) == 800 and whole["content"] == "body " * 200


def test_replayed_batch_adds_no_second_version(spark, frame, tmp_path):
    schema = frame([("a", "x")], "k string, t string").schema
    path = str(tmp_path / "log")
    for run in ("one-0", "one-0", "one-1", "one-0"):
        store.append_documents(spark, path, schema, frame([("a", run)], schema), "k", run=run)
    assert len(store.live(spark, path)[1][store.LOG]) == 2
    assert rows(store.documents(spark, path, schema, "k")) == [("a", "one-1")]


def test_only_feeds_with_documents_take_them(spark, tmp_path):
    with pytest.raises(ValueError):
        feeds.ingest(None, "market", str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "c"))
