"""Whole runs of the feeds, twice each, read back from their tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapewright import dims
from tapewright.catalogue import query, standins
from tapewright.catalogue.ingest import PAGE, RUN, _json
from tapewright.catalogue.pages import TEXT
from tapewright.catalogue.standins import COLUMNS, sql
from tapewright.functions import strings
from tapewright.plans import loads, runs
from tapewright.session import shared_folder
from tapewright.sources.tables import parquet

AS_OF = dt.date(2024, 2, 1)
LANGS = ["en", "de", "fr", "es"]
SERIES = dict(zip(COLUMNS, dims.SERIES))


def _values(rows: dict) -> str:
    quoted = [f"('{k}', '{str(v).replace(chr(39), chr(39) * 2)}')" for k, v in rows.items()]
    return f"(VALUES {', '.join(quoted)})"


PHRASES = dict(zip(LANGS, dims.SEARCH_PHRASES))


@query("run_news", f"""
WITH d AS (
  SELECT md5(text) AS url, phrase AS search_query, source, doc_id, text,
         DATE '2023-12-20' + CAST(doc_id % 40 AS INTEGER) AS day,
         list_position(['{"', '".join(LANGS)}'], lang) AS ordinal
  FROM documents JOIN {_values(PHRASES)} p(lang, phrase) USING (lang)),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ordinal, doc_id) AS rn FROM d WHERE day >= DATE '2024-02-01' - 30)
SELECT url, source AS source_name, search_query, day AS date_only, md5(text) AS digest,
       CAST(length(text) AS INTEGER) AS content_length FROM r WHERE rn = 1""")
def run_news(spark, sf):
    """Whole texts found by several searches, a part of them before the look-back period."""
    day = F.expr("date_add(DATE '2023-12-20', cast(doc_id % 40 AS int))")
    article = F.struct(
        F.col("doc_id").alias("k"), F.struct(F.col("source").alias("name")).alias("source"), F.lit("A title").alias("title"),
        F.md5(F.col("text").cast("binary")).alias("url"), F.concat(day.cast("string"), F.lit("T10:00:00Z")).alias("publishedAt"),
        F.col("text").alias("content"))
    pages = (
        parquet(spark, sf, "documents")
        .groupBy("lang", F.floor(F.col("doc_id") / PAGE).alias("page"))
        .agg(F.array_sort(F.collect_list(article)).alias("articles"))
        .select(F.element_at(F.create_map(*[F.lit(x) for p in PHRASES.items() for x in p]), F.col("lang")).alias("search_query"),
                "page", _json("articles"))
    )
    table, docs = shared_folder(spark, "news"), shared_folder(spark, "articles")
    for _ in range(2):
        runs.run_news(spark, pages, dims.phrases_frame(spark), AS_OF, table, docs, run_ts=RUN)
    stored = loads.table(spark, table, "news").select("url", "source_name", "date_only")
    whole = loads.articles(spark, docs).select("url", "search_query", F.md5(F.col("content").cast("binary")).alias("digest"), "content_length")
    return stored.join(whole, "url")


@query("run_filings", f"""
WITH t AS (SELECT page_id, {TEXT} AS text FROM pages)
SELECT printf('%010d-%02d', o_orderkey, o_orderkey % 100) AS accession_number, 'C' || o_custkey AS ticker,
       o_orderpriority AS form_type, md5(COALESCE(text, '')) AS digest, CAST(length(COALESCE(text, '')) AS BIGINT) AS text_chars
FROM orders LEFT JOIN t ON page_id = o_orderkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def run_filings(spark, sf):
    """Submissions of every customer, their numbers from a dictionary, and the pages some of them link."""
    accession = F.format_string("%010d-%02d", "o_orderkey", F.pmod("o_orderkey", F.lit(100)))
    document = F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".htm"))
    entry = F.struct(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("form"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filed"),
        accession.alias("accession"), document.alias("document"))
    orders = parquet(spark, sf, "orders")

    def pick(field: str):
        return F.transform(F.col("e"), lambda x: x[field])

    arrays = F.struct(
        pick("form").alias("form"), pick("filed").alias("filingDate"), pick("accession").alias("accessionNumber"),
        pick("document").alias("primaryDocument"), pick("filed").alias("reportDate"))
    ticker = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    submissions = orders.groupBy(ticker.alias("ticker")).agg(F.array_sort(F.collect_list(entry)).alias("e")).select(
        "ticker", F.to_json(F.struct(F.col("ticker").alias("name"), F.struct(arrays.alias("recent")).alias("filings"))).alias("payload"))
    dictionary = orders.select("o_custkey").distinct().select(F.to_json(F.create_map(
        F.col("o_custkey").cast("string"),
        F.struct(F.col("o_custkey").alias("cik_str"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("ticker")))).alias("payload"))
    linked = orders.join(parquet(spark, sf, "pages"), F.col("page_id") == F.col("o_orderkey")).select(
        strings.archive_url(strings.zero_pad(F.col("o_custkey")), accession, document).alias("url"), "html")
    table, docs = shared_folder(spark, "filings"), shared_folder(spark, "texts")
    for _ in range(2):
        runs.run_filings(
            spark, submissions, dictionary, linked, table, docs, None, forms=["1-URGENT", "2-HIGH"],
            material_form=standins.MATERIAL, run_ts=RUN)
    texts = loads.filing_texts(spark, docs).select("accession_number", F.md5(F.col("full_text").cast("binary")).alias("digest"), "text_chars")
    return loads.table(spark, table, "filings").select("accession_number", "ticker", "form_type").join(texts, "accession_number")


@query("run_market", sql(f"""
SELECT code AS series_code, name AS series_name, date, CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) AS value
FROM market JOIN {_values(SERIES)} s(series_code, code) USING (series_code) JOIN {_values(dims.SERIES)} n(code, name) USING (code)
WHERE date >= DATE '2000-01-01'""", "market"))
def run_market(spark, sf):
    """Observations under the codes of known series, from the first day that is kept."""
    code = F.element_at(F.create_map(*[F.lit(x) for p in SERIES.items() for x in p]), F.col("series_code"))
    point = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("value").cast("string").alias("value"))
    points = (
        standins.market(spark, sf).groupBy(code.alias("series_code"), F.last_day("date").alias("month"))
        .agg(F.collect_list(point).alias("observations")).select("series_code", _json("observations"))
    )
    table = shared_folder(spark, "market")
    for _ in range(2):
        runs.run_market(spark, points, dims.series_frame(spark), table, run_ts=RUN)
    return loads.table(spark, table, "market").select("series_code", "series_name", "date", F.col("value").cast("double").alias("value"))


TICKERS = dict(enumerate(dims.TICKERS, 1))


@query("run_prices", sql(f"""
SELECT t.ticker, p.date, CAST(CAST(p.close AS DECIMAL(12,4)) AS DOUBLE) AS close, p.volume
FROM prices p JOIN {_values(TICKERS)} t(n, ticker) ON p.ticker = t.n WHERE p.date >= DATE '2024-02-01' - 30""", "prices"))
def run_prices(spark, sf):
    """Bars of all users, of whom the first are listed tickers, in a look-back period of thirty days."""
    listed = dims.tickers_frame(spark).select(F.col("ordinal").cast("string").alias("n"), F.col("ticker").alias("name"))
    bar = F.struct(
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T05:00:00Z")).alias("t"), F.col("open").alias("o"), F.col("high").alias("h"),
        F.col("low").alias("l"), F.col("close").alias("c"), F.col("volume").alias("v"), F.col("vwap").alias("vw"))
    named = standins.prices(spark, sf).join(listed, F.col("ticker") == F.col("n"), "left").withColumn("ticker", F.coalesce("name", F.concat(F.lit("x"), "ticker")))
    pages = named.groupBy("ticker", F.last_day("date").alias("month")).agg(F.collect_list(bar).alias("bars")).select(
        F.create_map("ticker", "bars").alias("bars")).select(_json("bars"))
    table = shared_folder(spark, "prices")
    for _ in range(2):
        runs.run_prices(spark, pages, dims.tickers_frame(spark), AS_OF, table, 30, RUN)
    return loads.table(spark, table, "prices").select("ticker", "date", F.col("close").cast("double").alias("close"), "volume")
