from conftest import day, rows

from tapewright import schemas
from tapewright.plans import loads
from tapewright.sources.messages import encode


def _messages(frame, schema, data):
    return encode(frame([tuple(r.get(f.name) for f in schema) for r in data], schema))


def test_market_run_twice(spark, frame, tmp_path):
    path = str(tmp_path / "m")
    data = [{"series_code": "s", "date": "2024-01-01", "value": 1.25}, {"series_code": "s", "date": "bad", "value": 1.0}]
    for _ in range(2):
        loads.load_market(spark, _messages(frame, schemas.MARKET_WIRE, data), path)
    later = [{"series_code": "s", "date": "2024-01-01", "value": 9.0}, {"series_code": "s", "date": "2024-01-02", "value": 2.0}]
    loads.load_market(spark, _messages(frame, schemas.MARKET_WIRE, later), path)
    got = loads.table(spark, path, "market")
    assert rows(got.select("date", got.value.cast("double"))) == [(day("2024-01-01"), 1.25), (day("2024-01-02"), 2.0)]


def test_prices_keep_the_first_open(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    for open_, close in [(1.0, 2.0), (5.0, 6.0), (5.0, 6.0)]:
        data = [{"ticker": "a", "date": "2024-01-01", "open": open_, "close": close, "volume": 3}]
        loads.load_prices(spark, _messages(frame, schemas.PRICE_WIRE, data), path)
    got = loads.table(spark, path, "prices")
    assert rows(got.select(got.open.cast("double"), got.close.cast("double"), "volume")) == [(1.0, 6.0, 3)]


def test_news_go_to_both_stores(spark, frame, tmp_path):
    table, docs = str(tmp_path / "t"), str(tmp_path / "d")
    first = [{"url": "u", "title": "one", "published_at": "2024-01-02T00:00:00Z", "content": "abc"},
             {"url": None, "title": "lost"}]
    again = [{"url": "u", "title": "two", "content": None}, {"url": "v", "title": "three", "content": "x"}]
    assert loads.load_news(spark, _messages(frame, schemas.NEWS_WIRE, first), table, docs).kept == 1
    for _ in range(2):
        assert loads.load_news(spark, _messages(frame, schemas.NEWS_WIRE, again), table, docs).kept == 2
    assert rows(loads.table(spark, table, "news").select("url", "title", "category")) == [
        ("u", "one", "general"), ("v", "three", "general")]
    assert rows(loads.articles(spark, docs).select("url", "title", "content_length", "has_full_content")) == [
        ("u", "two", 0, False), ("v", "three", 1, True)]


def test_filings_keep_their_text(spark, frame, tmp_path):
    table, docs = str(tmp_path / "t"), str(tmp_path / "d")
    runs = [{"accession_number": "1", "form_type": "8-K", "filed_at": "2024-01-02", "full_text": text}
            for text in ("long", "", "longer", "")]
    for run in runs:
        loads.load_filings(spark, _messages(frame, schemas.FILING_WIRE, [run, run]), table, docs)
    assert rows(loads.table(spark, table, "filings").select("accession_number", "filed_at", "is_material_event")) == [
        ("1", day("2024-01-02"), True)]
    assert rows(loads.filing_texts(spark, docs).select("accession_number", "full_text", "text_chars")) == [("1", "longer", 6)]


def test_nothing_is_dropped_without_a_trace(spark, frame, tmp_path):
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    good = {"series_code": "s", "date": "2024-01-01", "value": 1.0}
    bad = [{"series_code": "s", "date": "never", "value": 1.0}, {"series_code": None, "date": "2024-01-01", "value": 1.0},
           {"series_code": "s", "date": "2024-01-01"}, {"series_code": "big", "date": "2024-01-01", "value": 1e20}]
    messages = _messages(frame, schemas.MARKET_WIRE, [good, good, *bad]).union(frame([("{",), (None,)], "value string"))
    run = loads.load_market(spark, messages, table, rejects)
    assert (run.messages, run.usable, run.kept) == (8, 3, 1 + 1)
    assert run.rejected == {"no_key": 2, "incomplete": 1, "undecodable": 2}
    assert spark.read.parquet(rejects).count() == 5
    assert rows(loads.table(spark, table, "market").select("series_code")) == [("big",), ("s",)]


def test_whole_titles_in_documents(spark, frame, tmp_path):
    table, docs = str(tmp_path / "t"), str(tmp_path / "d")
    data = [{"url": "u", "title": "x" * 800, "content": "c"}]
    loads.load_news(spark, _messages(frame, schemas.NEWS_WIRE, data), table, docs)
    assert loads.table(spark, table, "news").selectExpr("length(title)").first()[0] == 500
    assert loads.articles(spark, docs).selectExpr("length(title)").first()[0] == 800


def test_copies_are_left_out_without_exchanging_texts(spark, frame, tmp_path):
    from conftest import plan_of

    from tapewright.operators import dedupe
    data = [("a", "2", "x"), ("a", "1", "z"), ("a", "1", "y"), ("b", "1", "x"), ("b", "1", "x"), ("c", None, None)]
    rows_in = frame(data, "url string, fetched_at string, content string").repartition(3)
    rows_in.write.parquet(str(tmp_path / "stage"))
    stored = dedupe.placed(spark.read.parquet(str(tmp_path / "stage")))
    places = dedupe.later_copies(stored, ["url"])
    assert places.count() == 3 and "content" not in places.columns
    got = dedupe.without_places(stored, places)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, dedupe.keep_first(rows_in, ["url"]).collect()))
    places.write.parquet(str(tmp_path / "places"))
    assert "Exchange hashpartitioning" not in plan_of(dedupe.without_places(stored, spark.read.parquet(str(tmp_path / "places"))))
