"""Whole runs of a feed, repeated, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.catalogue import query, standins
from tapewright.catalogue.standins import sql
from tapewright.operators import merge
from tapewright.plans import loads, reports
from tapewright.session import shared_folder
from tapewright.sinks import store
from tapewright.sources.messages import encode
from tapewright.sources.tables import parquet


@query("load_prices_twice", sql("""
SELECT ticker, date, CAST(CAST(close AS DECIMAL(12,4)) AS DOUBLE) AS close, volume FROM prices""", "prices"))
def load_prices_twice(spark, sf):
    bars = encode(standins.prices(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd")))
    path = shared_folder(spark, "prices")
    for _ in range(2):
        loads.load_prices(spark, bars, path)
    return loads.table(spark, path, "prices").select("ticker", "date", F.col("close").cast("double").alias("close"), "volume")


@query("load_and_cover", sql("""
WITH daily AS (SELECT DATE '1995-01-01' + CAST(doc_id AS INTEGER) AS d, COUNT(*) AS n FROM documents GROUP BY 1)
SELECT accession_number, filed_at, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS news_count,
       CAST(MIN(abs(d - filed_at)) AS INTEGER) AS min_days_apart
FROM filings LEFT JOIN daily ON d BETWEEN filed_at - 7 AND filed_at + 7 GROUP BY 1, 2""", "filings"))
def load_and_cover(spark, sf):
    """News and filings loaded from messages, then joined by date from their tables."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), F.col("doc_id").cast("int"))
    articles = parquet(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"),
        F.col("source").alias("title"),
        F.date_format(day, "yyyy-MM-dd'T'12:00:00'Z'").alias("published_at"),
        F.col("text").alias("content"),
    )
    facts = standins.filing_facts(spark, sf)
    dated = {c: F.date_format(c, "yyyy-MM-dd") for c in ("filed_at", "period")}
    news, news_docs, filings, filing_docs = (
        shared_folder(spark, n) for n in ("news", "news-documents", "filings", "filing-documents")
    )
    loads.load_news(spark, encode(articles), news, news_docs)
    loads.load_filings(spark, encode(facts.withColumns(dated)), filings, filing_docs)
    covered = reports.coverage(loads.table(spark, filings, "filings"), loads.table(spark, news, "news"))
    return covered.select("accession_number", "filed_at", "news_count", "min_days_apart")


def _article_messages(spark, sf):
    """Documents as articles: some without an address or a title, some messages cut off."""
    d = F.col("doc_id")
    rows = parquet(spark, sf, "documents").select(
        F.when(d % 7 > 0, d.cast("string")).alias("url"), F.when(d % 5 > 0, F.substring_index("text", "\n", 1)).alias("title"),
        F.lit("2024-01-02T03:04:05Z").alias("published_at"), F.col("text").alias("content"), d.alias("_d"))
    whole = F.to_json(F.struct("url", "title", "published_at", "content"))
    return rows.select(F.when(F.col("_d") % 11 == 3, "{\"url\": ").otherwise(whole).alias("value"))


@query("load_rejects", """
SELECT CASE WHEN doc_id % 11 = 3 THEN 'undecodable' ELSE 'incomplete' END AS reason, COUNT(*) AS n
FROM documents WHERE doc_id % 11 = 3 OR doc_id % 7 = 0 OR doc_id % 5 = 0 GROUP BY 1""")
def load_rejects(spark, sf):
    """What a run of a load could not use, with the reason."""
    news, docs, rejects = (shared_folder(spark, n) for n in ("news", "documents", "rejects"))
    run = loads.load_news(spark, _article_messages(spark, sf), news, docs, rejects)
    return spark.read.parquet(run.rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("long_titles", """
SELECT CAST(doc_id AS VARCHAR) AS url, substring(t, 1, 500) AS title, md5(t) AS whole FROM (
  SELECT doc_id, trim(replace(text, chr(10), ' '), ' ') AS t FROM documents)""")
def long_titles(spark, sf):
    """Whole texts as titles: cut in the table, whole in the documents."""
    articles = parquet(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("url"), F.translate("text", "\n", " ").alias("title"))
    news, docs = shared_folder(spark, "news"), shared_folder(spark, "documents")
    loads.load_news(spark, encode(articles), news, docs)
    whole = loads.articles(spark, docs).select("url", F.md5(F.col("title").cast("binary")).alias("whole"))
    return loads.table(spark, news, "news").select("url", "title").join(whole, "url")


@query("load_documents_twice", """
SELECT CAST(doc_id AS VARCHAR) AS accession_number, CASE WHEN doc_id % 3 = 0 THEN '10-K' ELSE '8-K' END AS form_type,
       md5(CASE WHEN lang = 'en' AND length(text) > 1000 THEN '' WHEN doc_id % 6 = 0 THEN upper(source) ELSE text END) AS digest
FROM documents""")
def load_documents_twice(spark, sf):
    """Filings loaded, then a part of them again with and without new text (twice); long texts reset in the end."""
    docs = parquet(spark, sf, "documents")
    first = docs.select(F.col("doc_id").cast("string").alias("accession_number"), F.lit("8-K").alias("form_type"), F.col("text").alias("full_text"))
    text = F.when(F.col("doc_id") % 6 == 0, F.upper("source")).otherwise("")
    again = docs.filter("doc_id % 3 = 0").select(
        F.col("doc_id").cast("string").alias("accession_number"), F.lit("10-K").alias("form_type"), text.alias("full_text"))
    table, path = shared_folder(spark, "filings"), shared_folder(spark, "documents")
    for rows in (first, again, again):
        loads.load_filings(spark, encode(rows), table, path)
    long_english = docs.filter("lang = 'en' AND length(text) > 1000").select(F.col("doc_id").cast("string").alias("accession_number"), F.lit("").alias("reset"))
    stored = loads.filing_texts(spark, path).join(long_english, "accession_number", "left")
    kept = merge.reset_where(stored, F.col("reset").isNotNull(), "full_text")
    return kept.select("accession_number", "form_type", F.md5(F.col("full_text").cast("binary")).alias("digest"))


@query("reset_stored_documents", """
SELECT CAST(doc_id AS VARCHAR) AS accession_number, CASE WHEN length(text) > 1000 THEN 0 ELSE length(text) END AS text_chars
FROM documents""")
def reset_stored_documents(spark, sf):
    """Long texts of a stored table emptied; older versions do not come back."""
    rows = parquet(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("accession_number"), F.col("text").alias("full_text"))
    table, path = shared_folder(spark, "filings"), shared_folder(spark, "documents")
    loads.load_filings(spark, encode(rows), table, path)
    store.reset_documents(spark, path, loads.filing_schema(), "accession_number", F.length("full_text") > 1000, "full_text")
    return loads.filing_texts(spark, path).select("accession_number", "text_chars")
