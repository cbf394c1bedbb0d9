"""The reports a user asks for: operators composed, parameters in, one lazy frame out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tapewright import dims
from tapewright.dims import CARD_TEXT_CHARS, CARD_TITLE_CHARS
from tapewright.functions import dates, strings
from tapewright.functions.text import with_sentiment
from tapewright.operators import correlation, joins, series
from tapewright.operators.series import label_counts
from tapewright.sources.tables import all_of, documents

Range = tuple[dt.date, dt.date]


def between(day: str, period: Range) -> Column:
    return F.col(day).between(F.lit(period[0]), F.lit(period[1]))


def _picked(tickers: Sequence[str]) -> Column:
    return F.col("ticker").isin(list(tickers)) if tickers else F.lit(True)


# --- Overview ---------------------------------------------------------------


def index_with_mean(market: DataFrame, code: str, width: int = 50, exact: str | None = None) -> DataFrame:
    """Level of one series with its rolling mean, by date."""
    line = market.filter(F.col("series_code") == code).select("series_code", "date", "value")
    return series.rolling_mean(line, ["series_code"], "date", "value", width, exact=exact).orderBy("date")


def filings_by_company(filings: DataFrame, tickers: Sequence[str] = ()) -> DataFrame:
    """Filings per ticker and form; no tickers means all."""
    return label_counts(filings.filter(_picked(tickers)), "ticker", "form_type").orderBy("ticker", "form_type")


def macro_snapshot(
    market: DataFrame, codes: Sequence[str], labels: dict[str, str] | None = None,
    units: dict[str, str] | None = None, zero: str = "flat",
) -> DataFrame:
    """Latest and previous value per series, change, percent of the size of the previous one."""
    picked = market.filter(F.col("series_code").isin(list(codes)))
    both = series.latest_and_previous(picked, ["series_code"], "date", "value")
    changed = series.with_change(both, "latest", "prev", zero)
    return changed.withColumns({
        "label": F.coalesce(_literal_map(labels, "series_code"), F.col("series_code")),
        "unit": F.coalesce(_literal_map(units, "series_code"), F.lit("")),
    })


def macro_overview(market: DataFrame) -> DataFrame:
    """The snapshot of the series of the overview, with their display labels and units."""
    return macro_snapshot(market, list(dims.SNAPSHOT_LABELS), dims.SNAPSHOT_LABELS, dims.SNAPSHOT_UNITS)


def _literal_map(values: dict[str, str] | None, key: str) -> Column:
    if not values:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(key))


def recent_filings(filings: DataFrame, n: int = 12, tie: str = "accession_number") -> DataFrame:
    return filings.orderBy(F.col("filed_at").desc(), tie).limit(n)


# --- Indicators -------------------------------------------------------------


def indicator_list(market: DataFrame) -> DataFrame:
    return market.select("series_code", "series_name").distinct().orderBy("series_code")


def indicator(market: DataFrame, codes: Sequence[str], period: Range) -> DataFrame:
    """Points of the chosen series in a period (both ends included)."""
    chosen = F.col("series_code").isin(list(codes)) & between("date", period)
    return market.filter(chosen).select("series_code", "date", "value")


def indicator_lines(
    market: DataFrame, codes: Sequence[str], period: Range, width: int = 0,
    bands: Sequence[tuple[str, str, str]] = (), exact: str | None = None,
) -> DataFrame:
    """Value, mean, change and rebased value per day, with the interval the day is in."""
    lines = indicator(market, codes, period)
    keys = ["series_code"]
    lines = series.rolling_mean(lines, keys, "date", "value", width, exact=exact)
    lines = series.pct_change(lines, keys, "date", "value")
    lines = series.rebase(lines, keys, "date", "value", ieee=True)
    return joins.interval_tag(lines, "date", bands) if bands else lines


def recession_lines(market: DataFrame, codes: Sequence[str], period: Range) -> DataFrame:
    """Points of the chosen series with the recession each day is in (NULL outside)."""
    bands = dims.literal_frame(
        market.sparkSession, [(dt.date.fromisoformat(a), dt.date.fromisoformat(b), name) for a, b, name in dims.RECESSIONS], "_from", "_to", "recession")
    return joins.interval_join(indicator(market, codes, period), bands, "date", "_from", "_to", ["recession"])


def newest_points(market: DataFrame, code: str, period: Range, n: int = 500) -> DataFrame:
    return indicator(market, [code], period).orderBy(F.col("date").desc()).limit(n)


# --- Prices -----------------------------------------------------------------


def sector_prices(prices: DataFrame, sector: str, picked: Sequence[str] = ()) -> DataFrame:
    """Bars of the tickers of a listed sector, or of those picked from it."""
    return joins.member_filter(prices, dims.sectors_frame(prices.sparkSession), "ticker", "ticker", "sector", sector, picked)


def price_rows(prices: DataFrame, tickers: Sequence[str], period: Range) -> DataFrame:
    """Bars of the tickers (none means all) in a period."""
    chosen = _picked(tickers) & between("date", period)
    columns = ("ticker", "date", "open", "high", "low", "close", "volume", "vwap")
    return prices.filter(chosen).select(*columns)


def price_table(prices: DataFrame, tickers: Sequence[str], period: Range) -> DataFrame:
    """The bars themselves: by ticker, newest first."""
    return price_rows(prices, tickers, period).orderBy("ticker", F.col("date").desc())


def price_view(
    prices: DataFrame, tickers: Sequence[str], period: Range, measure: str = "close", rebased: bool = False
) -> DataFrame:
    """One measure per ticker and day, as it is or rebased to 100 (after a first value of 0: infinities and NaN)."""
    rows = price_rows(prices, tickers, period).select(
        "ticker", "date", series.measure(measure).cast("double").alias("value")
    )
    if rebased:
        rows = series.rebase(rows, ["ticker"], "date", "value", "value", ieee=True)
    return rows


def price_changes(
    prices: DataFrame, tickers: Sequence[str], period: Range, zero: str = "up"
) -> DataFrame:
    """Latest and previous close per ticker; a single bar is its own previous one."""
    both = series.latest_and_previous(price_rows(prices, tickers, period), ["ticker"], "date", "close")
    both = both.withColumn("prev", F.coalesce("prev", "latest"))
    return series.with_change(both, "latest", "prev", zero)


def volume_ranking(prices: DataFrame, tickers: Sequence[str], period: Range) -> DataFrame:
    return series.mean_rank(price_rows(prices, tickers, period), "ticker", "volume", "avg_volume")


def price_correlation(
    prices: DataFrame, tickers: Sequence[str], period: Range, exact: str | None = None
) -> DataFrame:
    return correlation.return_corr(
        price_rows(prices, tickers, period), "ticker", "date", "close", tickers, exact
    )


# --- Filings ----------------------------------------------------------------

ORDERS = {
    "Filed (newest)": lambda: F.col("filed_at").desc(),
    "Filed (oldest)": lambda: F.col("filed_at").asc(),
    "Ticker A-Z": lambda: F.col("ticker").asc(),
}


def filing_selection(
    filings: DataFrame, period: Range, tickers: Sequence[str] = (), form: str | None = None,
    material_only: bool = False, company: str | None = None, wildcards: bool = False,
) -> DataFrame:
    """Filings that meet every condition given; no tickers means all."""
    search = strings.contains_wild if wildcards else strings.contains_literal
    return filings.filter(all_of([
        between("filed_at", period),
        _picked(tickers),
        F.col("form_type") == form if form else None,
        F.col("is_material_event") if material_only else None,
        search(F.col("company_name"), company) if company else None,
    ]))


def filing_list(selection: DataFrame, order: str = "Filed (newest)") -> DataFrame:
    if order not in ORDERS:
        raise ValueError(f"unknown order {order!r}")
    columns = (
        "accession_number", "ticker", "company_name", "form_type", "filed_at", "period",
        "is_material_event", "document_url",
    )
    return selection.select(*columns).orderBy(ORDERS[order](), "accession_number")


def filing_totals(selection: DataFrame, form: str = "10-K") -> DataFrame:
    return selection.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_material_event").alias("material"),
        F.count_if(F.col("form_type") == form).alias("of_form"),
        F.count_distinct("ticker").alias("companies"),
        F.count("document_url").alias("with_document"),
    )


def by_form(selection: DataFrame) -> DataFrame:
    return label_counts(selection, "form_type").orderBy(F.col("n").desc(), "form_type")


def by_month(selection: DataFrame) -> DataFrame:
    return label_counts(selection, dates.month_label(F.col("filed_at")).alias("month"), "form_type")


def by_year(selection: DataFrame) -> DataFrame:
    return label_counts(selection, F.year("filed_at").alias("year"), "form_type")


def by_ticker(selection: DataFrame) -> DataFrame:
    return label_counts(selection, "ticker").orderBy("n", "ticker")


def document_links(selection: DataFrame) -> DataFrame:
    return selection.filter(F.col("document_url").isNotNull()).select(
        "accession_number", "ticker", "company_name", "form_type", "filed_at", "document_url"
    )


def company_history(filings: DataFrame, ticker) -> DataFrame:
    columns = ("accession_number", "form_type", "filed_at", "period", "is_material_event", "document_url")
    return (
        filings.filter(F.col("ticker") == ticker)
        .select(*columns)
        .orderBy(F.col("filed_at").desc(), "accession_number")
    )


# --- News -------------------------------------------------------------------

CARD_FIELDS = ("title", "source_name", "published_at", "description", "url", "category")


def by_category(news: DataFrame) -> DataFrame:
    return label_counts(news, "category").orderBy(F.col("n").desc(), "category")


def news_feed(
    news: DataFrame, n: int, category: str | None = None, search: str | None = None,
    search_first: bool = False, positive: Sequence[str] | None = None, negative: Sequence[str] | None = None,
) -> DataFrame:
    """The newest ``n`` articles with their sentiment.

    The search looks only among those ``n``; ``search_first`` searches all
    articles and then takes the newest.
    """
    def matching(df: DataFrame) -> DataFrame:
        if not search:
            return df
        hit = strings.contains_literal(F.col("title"), search) | strings.contains_literal(
            F.col("source_name"), search
        )
        return df.filter(F.coalesce(hit, F.lit(False)))

    equal = {"category": category} if category else None
    pool = matching(news) if search_first else news
    newest = documents(pool, CARD_FIELDS, equal, ("published_at", "url"), n)
    found = newest if search_first else matching(newest)
    lexicons = {k: v for k, v in {"positive": positive, "negative": negative}.items() if v}
    return with_sentiment(found, "title", "description", **lexicons)


def cards(feed: DataFrame) -> DataFrame:
    """Display fields: cut to size, with a default for whatever is missing."""
    return feed.select(
        strings.or_default(F.col("category"), "general").alias("category"),
        strings.clip(strings.or_default(F.col("title"), ""), CARD_TITLE_CHARS).alias("title"),
        strings.or_default(F.col("source_name"), "?").alias("source_name"),
        strings.clip_marked(F.col("description"), CARD_TEXT_CHARS).alias("description"),
        strings.clip(F.col("published_at").cast("string"), 10).alias("published"),
        strings.or_default(F.col("url"), "#").alias("url"),
        "sentiment",
    )


def sentiment_counts(feed: DataFrame) -> DataFrame:
    """One row, a class without articles counts 0."""
    return feed.agg(*[
        F.count_if(F.col("sentiment") == label).alias(label)
        for label in ("positive", "neutral", "negative")
    ])


# --- Cross-source -----------------------------------------------------------


def coverage(
    filings: DataFrame, news: DataFrame, n_days: int = 7, on: Sequence[str] = (), by: Sequence[str] | None = None
) -> DataFrame:
    """News around each filing: how many articles, and how many days away the nearest.

    ``by`` gives a coarser grain: one row per distinct combination of those columns.
    """
    if n_days < 0:
        raise ValueError("a window has no negative number of days")
    if by is None:
        filings = filings.select("accession_number", "ticker", "company_name", "form_type", "filed_at")
    return joins.date_window_count(filings, news, "filed_at", "date_only", n_days, on, by)


def top_coverage(covered: DataFrame, k: int = 50, tie: str = "accession_number") -> DataFrame:
    """The most covered filings, newest first among equals; those without news are left out."""
    return (
        covered.filter("news_count > 0")
        .orderBy(F.col("news_count").desc(), F.col("filed_at").desc(), tie)
        .limit(k)
    )


def filing_markers(
    market: DataFrame, filings: DataFrame, code: str, forms: Sequence[str] = ("8-K", "10-K")
) -> DataFrame:
    """Distinct filing days, each with the indicator's value on the nearest date."""
    line = market.filter(F.col("series_code") == code).select("date", "value")
    days = (
        filings.filter(F.col("form_type").isin(list(forms)))
        .select(F.col("filed_at").alias("date"), "ticker", "form_type")
        .distinct()
    )
    return joins.asof_join(days, line, "date", "date", ["value"])


def macro_correlation(
    market: DataFrame, codes: Sequence[str], period: Range, at_least: int = 3, exact: str | None = None
) -> DataFrame:
    return correlation.monthly_corr(
        market.filter(between("date", period)), "series_code", "date", "value", codes, at_least, exact
    )


def alert_weeks(alerts: DataFrame, compat: bool = False) -> DataFrame:
    return series.weekly_counts(alerts, "filed_at", "ticker", compat=compat)
