"""Whole runs of the feeds, from the payloads as received to the stored tables.

Each flattens its payloads, keeps what lies in its look-back period, publishes
messages to a folder, and loads them from there.  A run that is repeated
leaves the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapewright import sinks
from tapewright.dims import MAX_FILINGS_WITH_TEXT, NEWS_LOOKBACK_DAYS, PRICE_LOOKBACK_DAYS, SERIES_START
from tapewright.functions import dates
from tapewright.functions.text import page_text
from tapewright.plans import loads
from tapewright.session import shared_folder
from tapewright.sources import messages, payloads


def _published(spark: SparkSession, rows: DataFrame, feed: str) -> DataFrame:
    """The rows as messages, by way of a folder of files."""
    path = shared_folder(spark, f"{feed}-messages")
    sinks.publish_files(rows.select(*[c for c in rows.columns if c in loads.FEEDS[feed].wire.fieldNames()]), path)
    return messages.file_messages(spark, path)


def _recent(day: Column, as_of: dt.date, days: int) -> Column:
    return dates.since(dates.to_day(F.substring(day, 1, 10)), as_of, days)


def run_news(
    spark: SparkSession, pages: DataFrame, phrases: DataFrame, as_of: dt.date, table: str, documents: str,
    days: int = NEWS_LOOKBACK_DAYS, run_ts: dt.datetime | None = None,
) -> loads.Run:
    """Search pages (payload, search_query, page), tagged, each article once under the first phrase that found it."""
    found = payloads.articles(pages, "payload", "search_query", run_ts, carry=["page"])
    recent = found.filter(_recent(F.col("published_at"), as_of, days))
    seen = payloads.first_seen(recent, phrases, ["page", "pos"])
    return loads.load_news(spark, _published(spark, seen, "news"), table, documents)


def run_filings(
    spark: SparkSession, submissions: DataFrame, dictionary: DataFrame, pages: DataFrame, table: str, documents: str,
    limit: int | None = MAX_FILINGS_WITH_TEXT, older: DataFrame | None = None, run_ts: dt.datetime | None = None, **options,
) -> loads.Run:
    """Submissions (ticker, payload) with their company's number, the first of each entity, and the text of their page (url, html).

    ``text_chars`` counts the text's characters; a filing without a page has an empty text.
    """
    numbered = submissions.join(payloads.company_numbers(dictionary, "payload"), "ticker")
    found = payloads.filing_rows(
        payloads.filing_pages(numbered, "payload", "ticker", older), "arrays", "ticker", limit=limit, run_ts=run_ts, **options)
    texts = pages.select(F.col("url").alias("document_url"), page_text(F.col("html")).alias("full_text"))
    filed = found.join(texts, "document_url", "left").withColumn("full_text", F.coalesce("full_text", F.lit("")))
    filed = filed.withColumn("text_chars", F.length("full_text").cast("bigint"))
    return loads.load_filings(spark, _published(spark, filed, "filings"), table, documents)


def run_market(
    spark: SparkSession, points: DataFrame, names: DataFrame, table: str, start: dt.date = SERIES_START,
    run_ts: dt.datetime | None = None,
) -> loads.Run:
    """Observations (payload, series_code) from ``start`` on, with the names of their series."""
    rows = payloads.observations(points, "payload", "series_code", names, start, run_ts)
    return loads.load_market(spark, _published(spark, rows, "market"), table)


def run_prices(
    spark: SparkSession, bars: DataFrame, tickers: DataFrame, as_of: dt.date, table: str,
    days: int = PRICE_LOOKBACK_DAYS, run_ts: dt.datetime | None = None,
) -> loads.Run:
    """Bars (payload) of the listed tickers in the look-back period."""
    rows = payloads.price_bars(bars, "payload", run_ts).join(tickers.select("ticker"), "ticker", "left_semi")
    recent = rows.filter(_recent(F.col("date"), as_of, days))
    return loads.load_prices(spark, _published(spark, recent, "prices"), table)
