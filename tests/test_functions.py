import datetime as dt

import pytest
from conftest import day, rows

from pyspark.sql import functions as F

from tapewright import dims
from tapewright.functions import dates, numbers, strings, text
from tapewright.operators.clean import is_material


def _one(frame, value, schema="v string"):
    return lambda expr: frame([(value,)], schema).select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("value, padded", [("42", "0000000042"), ("12345678901", "12345678901"), (None, None)])
def test_zero_pad_never_cuts(frame, value, padded):
    assert _one(frame, value)(strings.zero_pad) == padded


def test_archive_url(frame):
    df = frame([("0000320193", "0000320193-24-000001", "a.htm"), ("1", "2-3", ""), ("1", "2-3", None)],
               "c string, a string, d string")
    got = df.select(strings.archive_url(F.col("c"), F.col("a"), F.col("d"))).collect()
    assert [r[0] for r in got] == [f"{dims.ARCHIVE_ROOT}/320193/000032019324000001/a.htm", None, None]


def test_white_space_is_unicode(frame):
    assert _one(frame, " \t a  \n b　")(strings.squash) == " a b "
    assert _one(frame, " \t a b　\x1f")(strings.strip) == "a b"


@pytest.mark.parametrize("value, marked", [("x" * 131, "x" * 130 + "..."), ("x" * 130, "x" * 130 + "..."),
                                           ("x" * 129, "x" * 129), (None, "")])
def test_marked_clip(frame, value, marked):
    assert _one(frame, value)(lambda c: strings.clip_marked(c, 130)) == marked


def test_contains_literal_and_wild(frame):
    df = frame([("100% Corp",), ("100 Corp",), (None,)], "v string")
    c = F.col("v")
    assert [tuple(r) for r in df.select(strings.contains_literal(c, "0% c"), strings.contains_wild(c, "0% c")).collect()] == [
        (True, True), (False, True), (None, None)]


def test_links_and_resolution(frame):
    html = """<a HREF="a/b.htm">x</a><a href='http://h/c.txt'><a href="d.pdf">"""
    links = _one(frame, html)(strings.links)
    assert links == ["a/b.htm", "http://h/c.txt"]
    df = frame([(link, "http://h/x/y.htm") for link in links], "l string, u string")
    assert [r[0] for r in df.select(strings.resolve(F.col("l"), F.col("u"))).collect()] == [
        "http://h/x/a/b.htm", "http://h/c.txt"]


def test_word_set(frame):
    assert sorted(_one(frame, " Gain gain, loss\n")(strings.word_set)) == ["gain", "gain,", "loss"]
    assert sorted(_one(frame, "gain, (LOSS)")(lambda c: strings.word_set(c, True))) == ["gain", "loss"]
    assert _one(frame, None)(strings.word_set) == []


@pytest.mark.parametrize("value, tag", [
    ("Q3 Earnings beat", "earnings"), ("Merger of earners", "earnings"), ("IPO soon", "m&a"),
    ("corporate news", "macro"), ("a second look", "regulatory"), ("hello", "general"), (None, "general")])
def test_tag_rules_substring(frame, value, tag):
    assert _one(frame, value)(text.tag_by_rules) == tag


def test_tag_rules_words_and_versions(frame):
    assert _one(frame, "corporate news")(lambda c: text.tag_by_rules(c, mode="word")) == "general"
    assert _one(frame, "the fed, again")(lambda c: text.tag_by_rules(c, mode="word")) == "macro"
    for word, old, new in [("quarterly", "general", "earnings"), ("lawsuit", "general", "regulatory")]:
        assert _one(frame, word)(lambda c: text.tag_by_rules(c, dims.TAG_RULES_V1)) == old
        assert _one(frame, word)(text.tag_by_rules) == new
    with pytest.raises(ValueError):
        text.has_any(F.lit("x"), ["x"], "regex")


def test_sentiment(frame):
    df = frame([("Surge surge", "gain and loss"), ("surge,", None), ("crash", "loss gain"), ("rise", "fall")],
               "t string, d string")
    got = [(r.positive_hits, r.negative_hits, r.sentiment) for r in text.with_sentiment(df, "t", "d").collect()]
    assert got == [(2, 1, "positive"), (0, 0, "neutral"), (1, 2, "negative"), (1, 1, "neutral")]
    clean = text.with_sentiment(df, "t", "d", strip_punct=True).collect()[1]
    assert (clean.positive_hits, clean.sentiment) == (1, "positive")


def test_page_text(frame):
    html = "<p>One&nbsp;<b>two</b>\n\n three</p>" + "<i>" * 3
    assert _one(frame, html)(text.page_text) == "One&nbsp; two three"
    assert _one(frame, html)(lambda c: text.page_text(c, 4)) == "One&"


def test_bad_dates_and_timestamps_are_null(frame):
    assert _one(frame, "bad")(dates.to_day) is None
    assert _one(frame, "bad")(dates.to_ts) is None
    assert _one(frame, "2024-02-30")(dates.to_day) is None
    assert _one(frame, "2024-01-02T03:04:05Z")(lambda c: dates.stamp_label(dates.to_ts(c))) == "Jan 02 03:04 UTC"
    assert _one(frame, None)(lambda c: dates.stamp_label(dates.to_ts(c))) == "No data"


def test_named_ranges():
    as_of = day("2024-03-31")
    assert dates.named_range("Last 30 days", as_of) == (day("2024-03-01"), as_of)
    assert dates.named_range("Since 2010", as_of) == (day("2010-01-01"), as_of)
    custom = (day("2020-01-01"), day("2020-02-01"))
    assert dates.named_range("Custom", as_of, custom) == custom
    with pytest.raises(ValueError):
        dates.named_range("Yesterday", as_of)


def test_numbers(frame):
    df = frame([(0.0,), (-4.0,), (None,)], "v double")
    v = F.col("v")
    got = df.select(
        numbers.pct_change(F.lit(2.0), v), numbers.pct_of_base(F.lit(2.0), v), numbers.direction(v, "up")
    ).collect()
    assert [tuple(r) for r in got] == [(None, None, "up"), (-150.0, 50.0, "down"), (None, None, None)]
    share = frame([(512.0,), (4096.0,)], "v double").select(numbers.share_of_limit(F.col("v")))
    assert [r[0] for r in share.collect()] == [50.0, 100.0]


def test_exact_sums_do_not_depend_on_order(frame):
    values = [0.1, 1e9, 0.2, -1e9, 0.3] * 50
    sums = {
        frame([(v,) for v in vs], "v double").agg(numbers.total(F.col("v"), "decimal(18,6)")).first()[0]
        for vs in (values, values[::-1], sorted(values))
    }
    assert sums == {30.0}


def test_means_keep_tiny_and_huge_values(frame):
    def mean(*values):
        return frame([(v,) for v in values], "v double").agg(numbers.mean(F.col("v"))).first()[0]

    assert abs(mean(1e-7, 3e-7) - 2e-7) < 1e-15 and mean(2e12, 4e12) == 3e12 and mean() is None


@pytest.mark.parametrize("form, flag", [("8-K", True), ("8-K/A", False), (None, False)])
def test_material_flag(frame, form, flag):
    assert _one(frame, form)(is_material) is flag


def test_dimensions(spark):
    assert (len(dims.TICKERS), len(set(dims.TICKERS)), len(dims.SERIES)) == (90, 90, 39)
    assert (len(dims.SEARCH_PHRASES), len(dims.FORM_TYPES), len(dims.SECTORS)) == (20, 6, 7)
    assert (len(dims.POSITIVE_WORDS), len(dims.NEGATIVE_WORDS)) == (20, 24)
    assert dims.tickers_frame(spark).filter("ordinal <= 5").count() == 5
    assert dims.series_frame(spark).count() == 39
    assert dims.phrases_frame(spark).count() == 20
    assert dims.sectors_frame(spark).filter("sector = 'Energy'").count() == 3
    assert (dims.SNAPSHOT_LABELS["DFF"], dims.SNAPSHOT_UNITS["DFF"]) == ("Fed Funds Rate", "%")


def test_small_dimensions_have_a_known_size(spark):
    big = spark.range(10).select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("ticker"))
    joined = big.join(dims.tickers_frame(spark), "ticker")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_since(frame):
    df = frame([(day("2024-03-01"),), (day("2024-02-29"),)], "d date")
    assert [r[0] for r in df.select(dates.since(F.col("d"), dt.date(2024, 3, 31), 30)).collect()] == [True, False]
