import datetime as dt

import pytest
from conftest import day, rows

from pyspark.sql import functions as F

from tapewright import schemas
from tapewright.operators import summary
from tapewright.plans import reports

ALL = (day("2000-01-01"), day("2030-01-01"))
FILING = "accession_number string, ticker string, company_name string, form_type string, filed_at date, " \
         "period date, is_material_event boolean, document_url string"


@pytest.fixture
def filings(frame):
    return frame([
        ("1", "a", "Alpha Inc", "8-K", day("2024-01-05"), None, True, "u1"),
        ("2", "a", "Alpha Inc", "10-K", day("2024-01-05"), None, False, None),
        ("3", "b", "Beta 100% Ltd", "8-K", day("2024-02-01"), None, True, "u3"),
        ("4", "c", None, "10-K", day("2023-12-01"), None, False, None),
    ], FILING)


@pytest.fixture
def market(frame):
    return frame([("x", "X", dt.date(2024, 1, d), float(d)) for d in range(1, 11)]
                 + [("y", "Y", day("2024-01-03"), 0.0)],
                 "series_code string, series_name string, date date, value double")


def test_selection_conditions(filings):
    pick = lambda **kw: [r[0] for r in rows(
        reports.filing_selection(filings, kw.pop("period", ALL), **kw).select("accession_number"))]
    assert pick() == ["1", "2", "3", "4"]
    assert pick(tickers=["a"], form="10-K") == ["2"]
    assert pick(material_only=True) == ["1", "3"]
    assert pick(company="ALPHA") == ["1", "2"]
    assert pick(company="100%") == ["3"]
    assert pick(company="a_pha") == [] and pick(company="a_pha", wildcards=True) == ["1", "2"]
    assert pick(period=(day("2024-01-05"), day("2024-01-05"))) == ["1", "2"]


def test_orders(filings):
    order = lambda o: [r[0] for r in reports.filing_list(filings, o).collect()]
    assert order("Filed (newest)") == ["3", "1", "2", "4"]
    assert order("Filed (oldest)") == ["4", "1", "2", "3"]
    assert order("Ticker A-Z") == ["1", "2", "3", "4"]
    with pytest.raises(ValueError):
        reports.filing_list(filings, "1; DROP")


def test_totals_and_counts(filings):
    assert rows(reports.filing_totals(filings)) == [(4, 2, 2, 3, 2)]
    assert rows(reports.by_month(filings)) == [("2023-12", "10-K", 1), ("2024-01", "10-K", 1), ("2024-01", "8-K", 1),
                                               ("2024-02", "8-K", 1)]
    assert rows(reports.document_links(filings).select("accession_number")) == [("1",), ("3",)]
    assert [r[0] for r in reports.recent_filings(filings, 2).collect()] == ["3", "1"]


def test_coverage(filings, frame):
    news = frame([(day("2024-01-01"),), (day("2024-01-12"),), (day("2024-01-13"),), (None,)], "date_only date")
    got = reports.coverage(filings, news)
    assert rows(got.select("accession_number", "news_count", "min_days_apart")) == [
        ("1", 2, 4), ("2", 2, 4), ("3", 0, None), ("4", 0, None)]
    assert [r[0] for r in reports.top_coverage(got).collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        reports.coverage(filings, news, -1)


def test_snapshot(market):
    got = {r.series_code: r for r in reports.macro_snapshot(market, ["x", "y"], {"x": "Ex"}, {"x": "%"}).collect()}
    assert (got["x"].latest, got["x"].prev, got["x"].label, got["x"].unit) == (10.0, 9.0, "Ex", "%")
    assert (got["y"].prev, got["y"].pct, got["y"].label, got["y"].unit) == (None, None, "y", "")


def test_indicator(market):
    lines = reports.indicator_lines(market, ["x"], (day("2024-01-03"), day("2024-01-08")), 2,
                                    [("2024-01-04", "2024-01-05", "b")]).orderBy("date").collect()
    assert [r.rolling_mean for r in lines] == [None, 3.5, 4.5, 5.5, 6.5, 7.5]
    assert [r.band for r in lines] == [None, "b", "b", None, None, None]
    assert lines[-1].rebased == pytest.approx(800 / 3)
    assert [r.value for r in reports.newest_points(market, "x", ALL, 2).collect()] == [10.0, 9.0]


def test_price_report(frame):
    prices = frame([("a", day("2024-01-01"), 2.0, 4.0, 1.0, 2.0, 10, None), ("a", day("2024-01-02"), 2.0, 4.0, 1.0, 3.0, 20, None),
                    ("b", day("2024-01-02"), 2.0, 4.0, 1.0, 5.0, 1, None)],
                   "ticker string, date date, open double, high double, low double, close double, volume bigint, vwap double")
    got = {r.ticker: (r.latest, r.prev, r.pct, r.direction) for r in reports.price_changes(prices, ["a", "b"], ALL).collect()}
    assert got == {"a": (3.0, 2.0, 50.0, "up"), "b": (5.0, 5.0, 0.0, "up")}
    view = reports.price_view(prices, ["a"], ALL, "volume", True)
    assert rows(view.select("value")) == [(100.0,), (200.0,)]
    assert [tuple(r) for r in reports.volume_ranking(prices, ["a", "b"], ALL).collect()] == [("b", 1.0), ("a", 15.0)]


def test_news_feed_searches_within_the_newest(frame):
    df = frame([(f"title {i}", "Wire" if i % 2 else None, i, "d" * (125 + i), f"u{i}", None) for i in range(10)],
               "title string, source_name string, published_at int, description string, url string, category string")
    feed = reports.news_feed(df, 3, search="wire")
    assert sorted(r.url for r in feed.collect()) == ["u7", "u9"]
    first = reports.news_feed(df, 3, search="wire", search_first=True)
    assert sorted(r.url for r in first.collect()) == ["u5", "u7", "u9"]
    card = reports.cards(reports.news_feed(df, 2)).orderBy("url").collect()
    assert (card[0].source_name, card[0].category, card[0].sentiment) == ("?", "general", "neutral")
    assert card[0].description == "d" * 130 + "..."
    assert rows(reports.sentiment_counts(feed)) == [(0, 2, 0)]


def test_filing_markers(market, filings):
    got = reports.filing_markers(market, filings, "x")
    assert rows(got.select("ticker", "form_type", "value")) == [
        ("a", "10-K", 5.0), ("a", "8-K", 5.0), ("b", "8-K", 10.0), ("c", "10-K", 1.0)]


def test_drilldown_and_weeks(filings):
    assert [r[0] for r in reports.company_history(filings, "a").collect()] == ["1", "2"]
    assert rows(reports.alert_weeks(filings.filter("ticker = 'b'"))) == [("2024-W05", "b", 1)]
    assert rows(reports.by_year(filings.filter("ticker = 'c'"))) == [(2023, "10-K", 1)]


def test_volume_summary_and_freshness(market, filings, frame):
    texts = frame([("é" * 512,), (None,)], "text string")
    empty = filings.limit(0)
    got = summary.volume_summary(market, filings, empty, empty, texts, "text", 1).first().asDict()
    assert (got["market_rows"], got["series_count"], got["filing_rows"], got["ticker_count"], got["news_rows"]) == (11, 2, 4, 3, 0)
    assert (got["total_rows"], got["text_chars"], got["text_mb"]) == (15, 512, 512 / 1048576)
    fresh = summary.freshness([("m", market, "date"), ("f", empty, "filed_at")])
    assert rows(fresh) == [("f", "No data"), ("m", "Jan 10 00:00 UTC")]


def test_quality_checks(frame):
    df = frame([("a", "2024-01-01", 1), ("a", "bad", 2), (None, None, 3)], "k string, d string, v int")
    assert rows(summary.key_violations(df, ["k"])) == [("a", 2)]
    assert rows(summary.field_violations(df, ["k"], {"d": "date"})) == [(1, 1)]
    assert rows(summary.stage_counts(df, F.col("k").isNotNull(), ["k"])) == [(3, 2, 1, 2)]
    watched, watch = summary.observed(df, "check")
    watched.write.format("noop").mode("overwrite").save()
    assert watch.get == {"rows": 3}


def test_schemas_match_their_keys():
    for name, wire in [("news", schemas.NEWS_WIRE), ("filings", schemas.FILING_WIRE),
                       ("market", schemas.MARKET_WIRE), ("prices", schemas.PRICE_WIRE)]:
        assert set(schemas.NATURAL_KEY[name]) <= set(wire.fieldNames())
