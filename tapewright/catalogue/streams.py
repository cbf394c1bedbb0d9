"""Streaming jobs run until their input is drained; the result is read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapewright import sinks
from tapewright.catalogue import query, standins
from tapewright.catalogue.coverage import WINDOW_SQL
from tapewright.catalogue.loads import _article_messages
from tapewright.catalogue.merges import INSERT_SQL, KEY_PART, STORED, UPSERT_SQL, WEEK, _bar_parts
from tapewright.catalogue.standins import sql
from tapewright.operators import merge
from tapewright.plans import loads
from tapewright.session import shared_folder
from tapewright.sinks import store
from tapewright.sources.tables import parquet
from tapewright.streaming import feeds, windows


def _table_stream(spark, sf, name):
    schema = parquet(spark, sf, name).schema
    return feeds.file_stream(spark, sf, schema, "parquet", pattern=f"{name}.parquet")


def _folders(spark, *names):
    return [shared_folder(spark, n) for n in names]


def _a_part(spark, folder, parts):
    """Files of a folder per part that was written to it."""
    return max(1, -(-len([n for n in store.names(spark, folder) if n.startswith("part-")]) // parts))


@query("stream_ingest", """
SELECT CAST(event_id AS VARCHAR) AS series_code, event_type AS series_name, CAST(ts AS DATE) AS date,
       CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) AS value
FROM events WHERE event_type <> 'error'""")
def stream_ingest(spark, sf):
    """Messages published twice, about a part per trigger, ingested once; those without a value are rejects.

    Some have no load time, and one part has all of a day months after the others.
    """
    source, out, mark = _folders(spark, "messages", "market", "checkpoint")
    late = F.col("event_id") % 97 == 0
    newest_first = parquet(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("series_code"),
        F.col("event_type").alias("series_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_id") % 10 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("fetched_at"),
        late.alias("late"),
    )
    for rows in (newest_first.filter("NOT late"), newest_first, newest_first.filter("late")):
        sinks.publish_files(rows.drop("late"), source, "append")
    feeds.ingest(feeds.file_stream(spark, source, files_per_trigger=_a_part(spark, source, 3)), "market", out, mark)
    return loads.table(spark, out, "market").select("series_code", "series_name", "date", F.col("value").cast("double").alias("value"))


@query("stream_dedupe", """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS date FROM events""")
def stream_dedupe(spark, sf):
    out, mark = _folders(spark, "keys", "checkpoint")
    rows = _table_stream(spark, sf, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("date"), "ts", "event_id"
    )
    unique = feeds.dedupe(rows, ["user_id", "event_type", "date"], "ts", "60 days")
    keys = unique.select("user_id", "event_type", "date")
    feeds.to_parquet(keys, out, mark)
    return spark.read.schema(keys.schema).parquet(out)


@query("stream_merge", INSERT_SQL)
def stream_merge(spark, sf):
    """Insert-if-absent of streamed rows into a table that has some of them."""
    path, mark = _folders(spark, "orders", "checkpoint")
    columns = ("o_orderkey", "o_custkey", "o_totalprice")
    stored = parquet(spark, sf, "orders").filter(STORED).select(*columns)
    store.insert_new(spark, path, stored.schema, stored, ["o_orderkey"], KEY_PART)
    rows = _table_stream(spark, sf, "orders").filter("o_orderstatus IN ('P', 'O')").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    feeds.merge_into(spark, rows, path, stored.schema, ["o_orderkey"], KEY_PART, mark)
    return store.read(spark, path, stored.schema)


@query("stream_upsert", UPSERT_SQL)
def stream_upsert(spark, sf):
    """Bars published as files and upserted into a table in parts by week."""
    source, path, mark = _folders(spark, "bars-in", "bars", "checkpoint")
    stored, batch = _bar_parts(spark, sf)
    store.replace_parts(spark, path, stored.schema, stored, WEEK, merge.upsert_prices)
    batch.write.parquet(source)
    rows = feeds.file_stream(spark, source, batch.schema, "parquet")
    feeds.upsert_into(spark, rows, path, stored.schema, WEEK, merge.upsert_prices, mark)
    return store.read(spark, path, stored.schema)


@query("stream_window_join", sql(WINDOW_SQL.format(n=7) + """
SELECT accession_number, ticker, form_type, filed_at, news_count, min_days_apart FROM covered""", "filings", "news"))
def stream_window_join(spark, sf):
    """Both feeds streamed: news as daily counts, filings as rows; counted per filing."""
    counts, rows, mark_a, mark_b = _folders(spark, "days", "filings", "checkpoint-a", "checkpoint-b")
    lines = _table_stream(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date_only"))
    feeds.count_days(lines, "date_only", counts, mark_a)
    orders = _table_stream(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("accession_number"),
        F.col("o_custkey").cast("string").alias("ticker"),
        F.col("o_orderpriority").alias("form_type"),
        F.to_date("o_orderdate").alias("filed_at"),
    )
    feeds.to_parquet(orders, rows, mark_b)
    return feeds.window_counts(spark, spark.read.schema(orders.schema).parquet(rows), "filed_at", counts)


@query("stream_alerts", sql("""
SELECT accession_number, ticker, filed_at FROM filings
WHERE sector = 'BUILDING' AND filed_at >= DATE '2001-06-30' - 90 AND form_type = '1-URGENT'""", "filings"))
def stream_alerts(spark, sf):
    out, mark = _folders(spark, "alerts", "checkpoint")
    orders = _table_stream(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("accession_number"),
        F.col("o_custkey").cast("string").alias("ticker"),
        F.col("o_orderpriority").alias("form_type"),
        F.to_date("o_orderdate").alias("filed_at"),
    )
    fired = feeds.alerts(
        orders, standins.watched(spark, sf), dt.date(2001, 6, 30), 90, standins.MATERIAL
    ).drop("form_type")
    feeds.to_parquet(fired, out, mark)
    return spark.read.schema(fired.schema).parquet(out)


@query("stream_weekly_counts", """
SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def stream_weekly_counts(spark, sf):
    """Every week, the open one included."""
    out, mark = _folders(spark, "weeks", "checkpoint")
    feeds.count_weeks(_table_stream(spark, sf, "events"), "ts", "event_type", out, mark)
    return feeds.week_counts(spark, "event_type", out)


def _streamed_articles(spark, sf):
    """Documents as articles in three parts; the whole feed ingested, and asked for more when there is none."""
    source, table, docs, rejects, mark = _folders(spark, "articles", "news", "documents", "rejects", "checkpoint")
    messages = _article_messages(spark, sf)
    third = F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3))
    for n in range(3):
        messages.filter(third == n).write.mode("append").text(source)
    for _ in range(2):
        feeds.ingest(feeds.file_stream(spark, source, files_per_trigger=_a_part(spark, source, 3)), "news", table, mark, docs, rejects)
    return table, docs, rejects


@query("stream_news", """
SELECT CAST(doc_id AS VARCHAR) AS url, substring(t, 1, 500) AS title, md5(t) AS whole_title, md5(text) AS body,
       CAST(length(text) AS INTEGER) AS content_length
FROM (SELECT doc_id, text, trim(string_split(text, chr(10))[1], ' ') AS t FROM documents)
WHERE doc_id % 11 <> 3 AND doc_id % 7 > 0 AND doc_id % 5 > 0""")
def stream_news(spark, sf):
    """The streamed feed keeps bodies and whole titles in its documents, cut titles in its table."""
    table, docs, _ = _streamed_articles(spark, sf)
    whole = loads.articles(spark, docs).select(
        "url", F.md5(F.col("title").cast("binary")).alias("whole_title"), F.md5(F.col("content").cast("binary")).alias("body"), "content_length")
    return loads.table(spark, table, "news").select("url", "title").join(whole, "url")


@query("stream_rejects", """
SELECT CASE WHEN doc_id % 11 = 3 THEN 'undecodable' ELSE 'incomplete' END AS reason, COUNT(*) AS n
FROM documents WHERE doc_id % 11 = 3 OR doc_id % 7 = 0 OR doc_id % 5 = 0 GROUP BY 1""")
def stream_rejects(spark, sf):
    """What the streamed feed could not use, message by message, with the reason."""
    _, _, rejects = _streamed_articles(spark, sf)
    return feeds.rejected(spark, rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _dated(rows, day, key):
    """A feed in two parts: the second has what is newer, and some of the last weeks of the first, late; and a day after all."""
    middle, end = rows.select(F.expr(f"cast(percentile_approx({day}, 0.5) as date)"), F.date_add(F.max(day), 90)).first()
    late = (F.col(day) >= F.date_sub(F.lit(middle), 20)) & (F.pmod(F.xxhash64(key), F.lit(10)) == 0)
    first = (F.col(day) < F.lit(middle)) & ~late
    return [rows.filter(first), rows.filter(~first)], str(end)


def _put(rows, folder):
    """Files as they come from the tasks; a run reads all that are new as one batch, so none of a part comes behind its clock."""
    rows.write.mode("append").parquet(folder)


def _beat(rows, day, end, folder):
    windows.heartbeat(rows, day, end).coalesce(1).write.mode("append").parquet(folder)


@query("stream_stream_window", sql(WINDOW_SQL.format(n=7) + """
SELECT accession_number, filed_at, news_count, min_days_apart FROM covered""", "filings", "news"))
def stream_stream_window(spark, sf):
    """Both feeds streamed and joined by day while they run, with late rows on both sides, in three runs."""
    a, b, out, mark = _folders(spark, "filings-in", "news-in", "met", "checkpoint")
    filings = standins.filing_facts(spark, sf).select("accession_number", "filed_at")
    news = standins.news(spark, sf).select("url", "date_only")
    (filed, filed_end), (published, published_end) = _dated(filings, "filed_at", "accession_number"), _dated(news, "date_only", "url")

    def run():
        streams = [feeds.file_stream(spark, f, rows.schema, "parquet") for f, rows in ((a, filings), (b, news))]
        feeds.to_parquet(windows.near_filed_days(*streams, "filed_at", "date_only", "accession_number", "url", 7, "30 days"), out, mark)

    for rows, articles in zip(filed, published):
        _put(rows, a)
        _put(articles, b)
        run()
    # The feeds go quiet: heartbeats close the last days, in a run that goes on from the state of those before.
    end = max(filed_end, published_end)
    _beat(filings, "filed_at", end, a)
    _beat(news, "date_only", end, b)
    run()
    met = spark.read.schema("filed_day date, day date, n bigint, days_apart int").parquet(out)
    return windows.day_coverage(filings, met, "filed_at")


def _windowed(spark, sf, watched):
    """A windowed report over the orders of all customers' segments, streamed in two parts and closed by a heartbeat."""
    source, out, mark = _folders(spark, "orders-in", "windows", "checkpoint")
    rows = standins.filings(spark, sf).select(F.col("sector").alias("ticker"), "filed_at", "accession_number")
    parts, end = _dated(rows, "filed_at", "accession_number")

    def run():
        found = watched(feeds.file_stream(spark, source, rows.schema, "parquet"))
        feeds.to_parquet(found, out, mark)
        return spark.read.schema(found.schema).parquet(out)

    for part in parts:
        _put(part, source)
        run()
    _beat(rows, "filed_at", end, source)
    return run()


@query("stream_bursts", sql("""
WITH d AS (SELECT sector AS ticker, filed_at AS day, COUNT(*) AS n FROM filings GROUP BY 1, 2),
c AS (
  SELECT ticker, day,
    SUM(n) OVER (PARTITION BY ticker ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS n,
    COALESCE(SUM(n) OVER (PARTITION BY ticker ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING), 0) AS b
  FROM d),
m AS (SELECT CAST(ROUND(COUNT(*) / 5 / 2404 * 7) AS BIGINT) AS at_least FROM filings)
SELECT ticker, day, CAST(n AS BIGINT) AS n FROM c, m WHERE n >= at_least AND b < at_least""", "filings"))
def stream_bursts(spark, sf):
    """Alerts on segments that reach about their mean of filings in a sliding week, once each time."""
    at_least = round(parquet(spark, sf, "orders").count() / 5 / 2404 * 7)
    return _windowed(spark, sf, lambda rows: windows.bursts(rows, "filed_at", "ticker", at_least))


@query("stream_weekly_windows", sql("""
SELECT CAST(date_trunc('week', filed_at) AS DATE) AS week_start, sector AS ticker, COUNT(*) AS n FROM filings GROUP BY 1, 2""", "filings"))
def stream_weekly_windows(spark, sf):
    """Weeks as windows that close when the watermark passes them."""
    return _windowed(spark, sf, lambda rows: windows.weeks(rows, "filed_at", "ticker"))
