import datetime as dt
import json

import pytest
from conftest import day, rows

from pyspark.sql import functions as F

from tapewright import schemas, sinks
from tapewright.functions import strings
from tapewright.operators import clean
from tapewright.sources import messages, pages, payloads, tables

RUN = dt.datetime(2024, 5, 1)


def _payload(frame, value, **more):
    names = list(more)
    ddl = ", ".join([*[f"{n} string" for n in names], "payload string"])
    return frame([(*more.values(), json.dumps(value) if not isinstance(value, str) else value)], ddl)


def test_articles(frame):
    page = {"articles": [
        {"source": {"name": "S"}, "title": "Profit up", "url": "u1", "publishedAt": "2024-04-30T01:02:03Z"},
        {"source": None, "title": None, "url": "u2"}, {"title": "no address", "url": ""}, {"title": "none"}]}
    got = payloads.articles(_payload(frame, page, q="x"), "payload", "q", RUN).collect()
    assert [(r.source_name, r.url, r.category, r.search_query) for r in got] == [
        ("S", "u1", "earnings", "x"), (None, "u2", "general", "x")]
    assert got[0].fetched_at == RUN


def test_malformed_and_empty_payloads_give_no_rows(frame):
    for value in ("{broken", "{}", '{"articles": []}'):
        assert payloads.articles(_payload(frame, value, q="x"), "payload", "q").count() == 0
    assert payloads.price_bars(_payload(frame, {"bars": {"A": []}}), "payload").count() == 0


def _pages(frame):
    recent = {"form": ["8-K", "X", "10-K"], "filingDate": ["2024-01-03", "2024-01-02"],
              "accessionNumber": ["0-1", "0-2", "0-3"], "primaryDocument": ["a.htm", "b.htm", ""]}
    older = {"form": ["10-Q"], "accessionNumber": ["0-9"], "reportDate": ["2020-01-01"]}
    whole = {"name": "Acme", "filings": {"recent": recent, "files": [{"name": "p1"}]}}
    df = frame([("acme", "0000000007", json.dumps(whole))], "t string, cik string, payload string")
    files = frame([("p1", json.dumps(older)), ("p2", json.dumps(older))], "name string, arrays string")
    return payloads.filing_pages(df, "payload", "t", files)


def test_filing_arrays_of_unequal_length(frame):
    got = payloads.filing_rows(_pages(frame), "arrays", "t", run_ts=RUN).orderBy("page", "pos").collect()
    assert [(r.page, r.pos, r.form_type, r.filed_at, r.period, r.accession_number) for r in got] == [
        (0, 0, "8-K", "2024-01-03", None, "0-1"), (0, 2, "10-K", None, None, "0-3"),
        (1, 0, "10-Q", None, "2020-01-01", "0-9")]
    assert [r.document_url for r in got] == [f"{'https://www.sec.gov/Archives/edgar/data'}/7/01/a.htm", None, None]
    assert [r.is_material_event for r in got] == [True, False, False]


def test_filing_cap_follows_page_order(frame):
    got = payloads.filing_rows(_pages(frame), "arrays", "t", limit=2)
    assert rows(got.select("accession_number")) == [("0-1",), ("0-3",)]


def test_observations(frame):
    value = {"observations": [{"date": "1999-12-31", "value": "1"}, {"date": "2000-01-01", "value": "."},
                              {"date": "2000-01-02", "value": "2.5"}, {"date": "2000-01-03", "value": "n/a"}]}
    got = payloads.observations(_payload(frame, value, c="DFF"), "payload", "c", start=day("2000-01-01"), run_ts=RUN)
    assert rows(got.select("series_name", "date", "value")) == [
        ("DFF", "2000-01-02", 2.5), ("DFF", "2000-01-03", None)]


def test_price_bars(frame):
    value = {"bars": {"A": [{"t": "2024-01-02T05:00:00Z", "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10}], "B": []}}
    got = payloads.price_bars(_payload(frame, value), "payload", RUN).drop("fetched_at")
    assert rows(got) == [("A", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10, None)]


def test_company_numbers(frame):
    value = {"0": {"cik_str": 320193, "ticker": "aapl"}}
    assert rows(payloads.company_numbers(_payload(frame, value), "payload")) == [("AAPL", "0000320193")]


def test_messages_round_trip_and_rejects(spark, frame, tmp_path):
    df = frame([("s", "n", "2024-01-01", 1.5, None), ("t", None, None, None, None)],
               "series_code string, series_name string, date string, value double, fetched_at string")
    sinks.publish_files(df, str(tmp_path / "m"))
    stored = messages.file_messages(spark, str(tmp_path / "m"))
    assert rows(messages.decode(stored, schemas.MARKET_WIRE)) == rows(df)
    bad = stored.unionByName(frame([("{broken",)], "value string"))
    assert rows(messages.undecodable(bad, schemas.MARKET_WIRE)) == [("{broken",)]
    assert messages.decode(bad, schemas.MARKET_WIRE).dropna(subset=["series_code"]).count() == 2


def _news(frame, data):
    full = [{f.name: None for f in schemas.NEWS_WIRE} | r for r in data]
    return frame([tuple(r[f.name] for f in schemas.NEWS_WIRE) for r in full], schemas.NEWS_WIRE)


def test_clean_news(frame):
    df = _news(frame, [
        {"url": "u", "title": "  Second ", "published_at": "2024-01-02T00:00:00Z", "fetched_at": "2024-01-03"},
        {"url": "u", "title": " First" + "x" * 600, "published_at": "soon", "fetched_at": "2024-01-02"},
        {"url": None, "title": "t"}, {"url": "v", "title": None}])
    got = clean.clean_news(df, ["fetched_at"]).collect()
    assert len(got) == 1
    assert (len(got[0].title), got[0].title[:5], got[0].category) == (605, "First", "general")
    assert (got[0].published_at, got[0].date_only) == (None, None)


def test_clean_filings_bad_dates(frame):
    df = frame([("8-K", "2024-01-02", "junk", "a"), (None, "bad", None, "b"), ("8-K", None, None, None)],
               "form_type string, filed_at string, period string, accession_number string"
               ).withColumn("fetched_at", F.lit("2024-01-01T10:00:00"))
    got = clean.clean_filings(df).select("accession_number", "filed_at", "period", "is_material_event")
    assert rows(got) == [("a", day("2024-01-02"), None, True), ("b", None, None, False)]


def test_clean_daily_feeds(frame):
    df = frame([("s", "2024-01-01", 1.0), ("s", "2024-1-1", 2.0), ("s", "bad", 3.0), ("s", "2024-01-02", None)],
               "series_code string, date string, value double").withColumn("fetched_at", F.lit(None).cast("string"))
    assert rows(clean.clean_market(df).select("date", "value")) == [(day("2024-01-01"), 1.0)]
    prices = df.withColumnsRenamed({"series_code": "ticker", "value": "close"})
    assert rows(clean.clean_prices(prices).select("date", "close")) == [(day("2024-01-01"), 1.0)]


def test_conform_types_and_required_columns(frame):
    df = frame([("s", "2024-01-01", "1.23456789"), ("s", "bad", "1"), (None, "2024-01-01", "1")],
               "series_code string, date string, value string")
    got = clean.conform(df, schemas.MARKET_TABLE)
    assert [f.dataType for f in got.schema] == [f.dataType for f in schemas.MARKET_TABLE]
    assert [(r.series_code, r.date, float(r.value)) for r in got.collect()] == [("s", day("2024-01-01"), 1.234568)]


def test_documents_and_conditions(frame):
    df = frame([(1, "a", 3), (2, "a", 9), (3, "b", 5)], "id int, c string, p int")
    got = tables.documents(df, ["id", "p"], {"c": "a"}, ["p", "id"], 1)
    assert rows(got) == [(2, 9)]
    assert df.filter(tables.all_of([None, F.col("id") > 1, F.col("p") > 5])).count() == 1
    assert df.filter(tables.all_of([None])).count() == 3


def test_pages_appended_in_order(frame):
    one, two = frame([("a",)], "v string"), frame([("b",)], "v string")
    assert rows(tables.append_pages([one, two])) == [("a", 0), ("b", 1)]


def test_bound_query(spark, frame):
    df = frame([("a", 1), ("b'; --", 2)], "k string, v int")
    got = tables.bound_query(spark, "SELECT v FROM {t} WHERE k = :k", {"t": df}, k="b'; --")
    assert rows(got) == [(2,)]


def test_wrappers_are_followed_to_the_first_longer_page(frame):
    store = frame([(10, "http://h/long.htm", "L" * 200), (11, "http://h/short.htm", "s"),
                   (12, "http://h/longer.htm", "M" * 300)], "page_id int, url string, html string")
    link = '<a href="short.htm"></a><a href="long.htm"></a><a href="http://h/longer.htm"></a>'
    wrapped = frame([(1, "http://h/x.htm", link), (2, "http://h/y.htm", "no links"),
                     (3, "http://h/z.htm", link + "x" * 6000)], "page_id int, url string, html string")
    got = {r.page_id: (r.taken_from, r.html[:2]) for r in pages.follow_wrappers(wrapped, store).collect()}
    assert got == {1: ("http://h/long.htm", "LL"), 2: (None, "no"), 3: (None, "<a")}


def test_wrapper_needs_a_mention_where_asked(frame):
    df = frame([("x .HTM",), ("x",)], "html string")
    assert [r[0] for r in df.select(pages.is_wrapper(F.col("html"), 100, (".htm", ".txt"))).collect()] == [True, False]


@pytest.mark.parametrize("split", [None, ("id", "0", "10", 4)])
def test_relational_reads_and_writes_pass_their_options(spark, frame, monkeypatch, split):
    from pyspark.sql import DataFrameReader, DataFrameWriter

    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *a, **k: seen.update(read=(a, k)))
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: seen.update(write=(a, k)))
    tables.jdbc_table(spark, "jdbc:x", "t", {"user": "u"}, split)
    sinks.relational(frame([(1,)], "id int"), "jdbc:x", "t", {"user": "u"})
    assert seen["read"][1].get("numPartitions") == (4 if split else None)
    assert seen["write"][1]["properties"] == {"batchsize": "500", "user": "u"}


def test_a_url_of_several_pages_makes_no_rows(frame):
    store = frame([(10, "http://h/a", "L" * 200), (11, "http://h/a", "M" * 300), (12, "http://h/a", "N" * 300), (13, "http://h/b", "B" * 400)],
                  "page_id int, url string, html string")
    wrapped = frame([(1, "http://h/x", '<a href="a"></a>'), (2, "http://h/y", '<a href="a"></a><a href="b"></a>')], "page_id int, url string, html string")
    got = [(r.page_id, r.taken_from, r.html[0]) for r in pages.follow_wrappers(wrapped, store, strings.ANY_LINK).orderBy("page_id").collect()]
    assert got == [(1, "http://h/a", "M"), (2, "http://h/a", "M")]
    seen = store.withColumn("seen_from", F.when(F.col("page_id") == 12, 1).when(F.col("page_id") == 13, 2))
    got = [(r.page_id, r.taken_from, r.html[0]) for r in pages.follow_wrappers(wrapped, seen, strings.ANY_LINK, seen_from="seen_from").orderBy("page_id").collect()]
    assert got == [(1, "http://h/a", "N"), (2, "http://h/b", "B")]
