"""Payload flattening, message and file round trips, cleaning.

Payloads are built from the supplied tables in pages of bounded size: a page
takes the rows of one short range of a unique id (or of one month), so no
group grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapewright import schemas, sinks
from tapewright.catalogue import query, standins
from tapewright.catalogue.standins import sql
from tapewright.dims import literal_frame
from tapewright.operators import clean
from tapewright.session import shared_folder
from tapewright.sources import messages, payloads
from tapewright.sources.tables import parquet

RUN = dt.datetime(2024, 2, 1, 6, 0, 0)
PAGE = 20


def _json(column: str) -> F.Column:
    return F.to_json(F.struct(F.col(column))).alias("payload")


@query("flatten_articles", """
SELECT source AS source_name, split_part(text, chr(10), 1) AS title, md5(text) AS digest,
       'https://news.example/' || doc_id AS url, '2024-01-01T00:00:00Z' AS published_at, lang AS search_query,
       '2024-02-01 06:00:00' AS fetched
FROM documents""")
def flatten_articles(spark, sf):
    """Whole texts as article content; an article without an address is left out."""
    article = F.struct(
        F.struct(F.col("source").alias("name")).alias("source"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit("2024-01-01T00:00:00Z").alias("publishedAt"),
        F.col("text").alias("content"),
    )
    unaddressed = article.withField("url", F.lit("")).withField("content", F.lit(None).cast("string"))
    pages = (
        parquet(spark, sf, "documents")
        .withColumn("articles", F.array(unaddressed, article))
        .select("lang", _json("articles"))
    )
    flat = payloads.articles(pages, "payload", "lang", RUN)
    return flat.select(
        "source_name", "title", F.md5(F.col("content").cast("binary")).alias("digest"), "url", "published_at",
        "search_query",
        F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched"),
    )


@query("first_seen_articles", """
SELECT doc_id, url, search_query FROM (
  SELECT doc_id, md5(text) AS url, lang AS search_query, row_number() OVER (PARTITION BY md5(text)
    ORDER BY CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END, doc_id) AS rn
  FROM documents) WHERE rn = 1""")
def first_seen_articles(spark, sf):
    """The same article found by several searches belongs to the first of them."""
    docs = parquet(spark, sf, "documents")
    article = F.struct(
        F.col("doc_id").alias("k"),
        F.format_string("%d", "doc_id").alias("title"),
        F.md5(F.col("text").cast("binary")).alias("url"),
    )
    pages = (
        docs.groupBy("lang", F.floor(F.col("doc_id") / PAGE).alias("page"))
        .agg(F.array_sort(F.collect_list(article)).alias("articles"))
        .select("lang", "page", _json("articles"))
    )
    phrases = literal_frame(spark, [(1, "en"), (2, "de"), (3, "fr"), (4, "es")], "ordinal", "search_query")
    found = payloads.articles(pages, "payload", "lang", RUN, carry=["page"])
    seen = payloads.first_seen(found, phrases, ["page", "pos"])
    return seen.select(F.col("title").cast("bigint").alias("doc_id"), "url", "search_query")


def _arrays(entries: str):
    """Sorted entries as parallel arrays; the document array is one too short."""
    def pick(field: str):
        return F.transform(F.col(entries), lambda e: e[field])

    return F.struct(
        pick("form").alias("form"),
        pick("filed").alias("filingDate"),
        pick("accession").alias("accessionNumber"),
        F.slice(pick("document"), F.lit(1), F.size(entries) - 1).alias("primaryDocument"),
        pick("period").alias("reportDate"),
    )


def _filing_payloads(spark, sf):
    """Pages of parallel arrays per group of customers, each of at most 1,000 filings."""
    entry = F.struct(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderpriority").alias("form"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("filed"),
        F.format_string("%010d-%02d", "o_orderkey", F.pmod("o_orderkey", F.lit(100))).alias("accession"),
        F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".htm")).alias("document"),
        F.date_format(F.date_sub("o_orderdate", 30), "yyyy-MM-dd").alias("period"),
    )
    block = F.floor(F.col("o_orderkey") / 1000)
    return (
        parquet(spark, sf, "orders")
        .groupBy(F.floor(F.col("o_custkey") / 100).cast("string").alias("ticker"), block.alias("block"))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select("ticker", "block", _arrays("entries").alias("arrays"))
    )


FLAT_FILINGS = """
WITH e AS (SELECT *, CAST(o_custkey // 100 AS VARCHAR) AS ticker, o_orderkey // 1000 AS block,
    row_number() OVER (PARTITION BY o_custkey // 100, o_orderkey // 1000 ORDER BY o_orderkey DESC) AS from_end
  FROM orders)
SELECT ticker, lpad(ticker, 10, '0') AS cik, 'Company ' || ticker AS company_name, o_orderpriority AS form_type,
       strftime(o_orderdate, '%Y-%m-%d') AS filed_at,
       strftime(CAST(o_orderdate AS DATE) - 30, '%Y-%m-%d') AS period,
       printf('%010d-%02d', o_orderkey, o_orderkey % 100) AS accession_number,
       CASE WHEN from_end > 1 THEN 'https://www.sec.gov/Archives/edgar/data/' || ticker || '/'
         || printf('%010d%02d', o_orderkey, o_orderkey % 100) || '/d' || o_orderkey || '.htm' END AS document_url,
       o_orderpriority = '1-URGENT' AS is_material_event
FROM e WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
"""


@query("flatten_parallel_arrays", FLAT_FILINGS)
def flatten_parallel_arrays(spark, sf):
    """Recent pages in the payload, older pages joined by file name, arrays of unequal length."""
    blocks = _filing_payloads(spark, sf).withColumn("part", F.floor(F.col("block") / 10))
    file_name = F.concat_ws("-", F.lit("page"), "ticker", F.col("block").cast("string"))
    first = F.col("block") % 10 == 0
    recent = blocks.filter(first).select("ticker", "part", F.col("arrays").alias("recent"))
    files = (
        blocks.filter(~first)
        .groupBy("ticker", "part")  # at most nine names
        .agg(F.array_sort(F.collect_list(F.struct(file_name.alias("name")))).alias("files"))
    )
    whole = recent.join(files, ["ticker", "part"], "full").select(
        "ticker",
        F.lpad("ticker", 10, "0").alias("cik"),
        F.to_json(F.struct(
            F.concat(F.lit("Company "), F.col("ticker")).alias("name"),
            F.struct("recent", "files").alias("filings"),
        )).alias("payload"),
    )
    older = blocks.filter(~first).select(file_name.alias("name"), F.to_json("arrays").alias("arrays"))
    pages = payloads.filing_pages(whole, "payload", "ticker", older)
    rows = payloads.filing_rows(
        pages, "arrays", "ticker", ["1-URGENT", "2-HIGH", "5-LOW"], material_form=standins.MATERIAL, run_ts=RUN
    )
    return rows.drop("fetched_at", "page", "pos")


@query("flatten_filings_capped", f"""
WITH f AS ({FLAT_FILINGS})
SELECT ticker, accession_number FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY accession_number) AS rn FROM f) WHERE rn <= 20""")
def flatten_filings_capped(spark, sf):
    """The first twenty filings of each group in page and position order."""
    pages = _filing_payloads(spark, sf).select(
        "ticker", F.lit("0").alias("cik"), F.lit("-").alias("company_name"), F.col("block").alias("page"), "arrays"
    )
    rows = payloads.filing_rows(pages, "arrays", "ticker", ["1-URGENT", "2-HIGH", "5-LOW"], limit=20, run_ts=RUN)
    return rows.select("ticker", "accession_number")


def _observation_payloads(spark, sf):
    text = F.when(F.floor("value") % 7 == 0, ".").otherwise(F.col("value").cast("string"))
    point = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), text.alias("value"))
    return (
        standins.market(spark, sf)
        .groupBy("series_code", F.last_day("date").alias("month"))
        .agg(F.collect_list(point).alias("observations"))
        .select("series_code", _json("observations"))
    )


@query("flatten_observations", sql("""
SELECT series_code, CASE series_code WHEN '1-URGENT' THEN 'Urgent orders' ELSE series_code END AS series_name,
       strftime(date, '%Y-%m-%d') AS date, value
FROM market WHERE CAST(floor(value) AS BIGINT) % 7 <> 0 AND date >= DATE '1996-01-01'""", "market"))
def flatten_observations(spark, sf):
    names = literal_frame(spark, [("1-URGENT", "Urgent orders")], "series_code", "series_name")
    points = payloads.observations(
        _observation_payloads(spark, sf), "payload", "series_code", names, dt.date(1996, 1, 1), RUN
    )
    return points.drop("fetched_at")


def _bar_payloads(spark, sf):
    """A map from ticker to its bars of a month, for ten tickers at a time."""
    bar = F.struct(
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T05:00:00Z")).alias("t"),
        F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"),
        F.col("volume").alias("v"), F.when(F.col("volume") > 1, F.col("vwap")).alias("vw"),
    )
    per_ticker = (
        standins.prices(spark, sf)
        .groupBy("ticker", F.last_day("date").alias("month"))
        .agg(F.collect_list(bar).alias("bars"))
    )
    ten = F.floor(F.col("ticker").cast("bigint") / 10).alias("ten")
    return (
        per_ticker.groupBy("month", ten)
        .agg(F.map_from_entries(F.collect_list(F.struct("ticker", "bars"))).alias("bars"))
        .select(_json("bars"))
    )


@query("flatten_bar_map", sql("""
SELECT ticker, strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume,
       CASE WHEN volume > 1 THEN vwap END AS vwap FROM prices""", "prices"))
def flatten_bar_map(spark, sf):
    return payloads.price_bars(_bar_payloads(spark, sf), "payload", RUN).drop("fetched_at")


@query("company_numbers", """
SELECT upper(c_name) AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer""")
def company_numbers(spark, sf):
    entry = F.struct(F.col("c_custkey").alias("cik_str"), F.col("c_name").alias("ticker"))
    pages = (
        parquet(spark, sf, "customer")
        .groupBy(F.floor(F.col("c_custkey") / 1000).alias("page"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey").cast("string"), entry))).alias("m"))
        .select(F.to_json("m").alias("payload"))
    )
    return payloads.company_numbers(pages, "payload")


def _event_messages(spark, sf):
    return parquet(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("series_code"),
        F.col("event_type").alias("series_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "value",
        F.col("props").alias("fetched_at"),
    )


@query("json_publish_roundtrip", """
SELECT CAST(user_id AS VARCHAR) AS series_code, event_type AS series_name, strftime(ts, '%Y-%m-%d') AS date,
       value, props AS fetched_at FROM events""")
def json_publish_roundtrip(spark, sf):
    path = shared_folder(spark, "messages")
    sinks.publish_files(_event_messages(spark, sf), path)
    return messages.decode(messages.file_messages(spark, path), schemas.MARKET_WIRE)


@query("undecodable_messages", """
SELECT event_id FROM events WHERE event_type = 'error'""")
def undecodable_messages(spark, sf):
    """Messages cut off in the middle, told apart from whole ones."""
    events = parquet(spark, sf, "events").select("event_id", "event_type", "value")
    whole = messages.encode(events)
    stump = F.concat(F.regexp_extract("value", r":(\d+),", 1), F.lit("{"))
    cut = F.when(F.col("value").contains('"error"'), stump).otherwise(F.col("value"))
    bad = messages.undecodable(whole.select(cut.alias("value")), events.schema)
    return bad.select(F.regexp_extract("value", r"^(\d+)", 1).cast("bigint").alias("event_id"))


@query("csv_export_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def csv_export_roundtrip(spark, sf):
    rows = parquet(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    path = shared_folder(spark, "csv")
    sinks.csv(rows, path)
    return sinks.read_csv(spark, path, rows.schema)


@query("csv_texts_roundtrip", """
SELECT doc_id, lang, md5(CASE WHEN lang = 'de' THEN '' ELSE '"' || text || chr(10) || ',"' END) AS digest,
       lang = 'fr' AS without FROM documents""")
def csv_texts_roundtrip(spark, sf):
    """Whole texts with quotes and line breaks, empty texts and missing ones."""
    text = F.when(F.col("lang") != "de", F.concat(F.lit('"'), "text", F.lit('\n,"'))).otherwise("")
    rows = parquet(spark, sf, "documents").select("doc_id", "lang", text.alias("text"), F.when(F.col("lang") != "fr", F.lit("x")).alias("note"))
    path = shared_folder(spark, "csv")
    sinks.csv(rows, path)
    back = sinks.read_csv(spark, path, rows.schema)
    return back.select("doc_id", "lang", F.md5(F.col("text").cast("binary")).alias("digest"), F.col("note").isNull().alias("without"))


@query("dual_sink", sql("""
SELECT accession_number, ticker, filed_at, length(document_url) AS n FROM (
  SELECT *, CASE WHEN document_url IS NULL THEN '' ELSE document_url END AS u FROM filings)""", "filings")
    .replace("length(document_url) AS n", "CAST(length(u) AS INTEGER) AS n"))
def dual_sink(spark, sf):
    """Metadata to one table, whole records to documents, read back together."""
    rows = standins.filings(spark, sf).withColumn("full_text", F.coalesce("document_url", F.lit("")))
    table, docs = shared_folder(spark, "table"), shared_folder(spark, "documents")
    sinks.dual(
        rows, schemas.FILING_TABLE,
        lambda df: df.write.parquet(table), lambda df: sinks.collection(df, "json", path=docs),
    )
    texts = spark.read.schema("accession_number string, full_text string").json(docs)
    stored = sinks.stored_table(spark, table, schemas.FILING_TABLE)
    return stored.join(texts, "accession_number").select(
        "accession_number", "ticker", "filed_at", F.length("full_text").alias("n")
    )


def _filing_messages(spark, sf):
    """Order lines as filing messages: repeated keys, some bad dates, some without a key."""
    line = parquet(spark, sf, "lineitem")
    return line.select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        F.col("l_returnflag").alias("form_type"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise("not a date").alias("filed_at"),
        F.lit(None).cast("string").alias("period"),
        F.when(F.col("l_quantity") > 1, F.col("l_orderkey").cast("string")).alias("accession_number"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
    )


@query("clean_filings", """
SELECT accession_number, ticker, form_type, filed_at, form_type = 'R' AS is_material_event, part FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS accession_number, CAST(l_suppkey AS VARCHAR) AS ticker,
         l_returnflag AS form_type, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS filed_at,
         l_partkey AS part, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY strftime(l_shipdate, '%Y-%m-%d'), l_partkey, l_suppkey, l_extendedprice, l_returnflag) AS rn
  FROM lineitem WHERE l_quantity > 1) WHERE rn = 1""")
def clean_filings(spark, sf):
    cleaned = clean.clean_filings(
        _filing_messages(spark, sf), ["fetched_at", "part", F.col("ticker").cast("bigint"), "price", "form_type"], "R"
    )
    return cleaned.select("accession_number", "ticker", "form_type", "filed_at", "is_material_event", "part")


@query("clean_prices", """
SELECT ticker, date, close, volume, fetched FROM (
  SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date, value AS close, event_id AS volume,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS fetched,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn
  FROM events WHERE event_type <> 'error') WHERE rn = 1""")
def clean_prices(spark, sf):
    wire = parquet(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("ticker"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("close"),
        F.col("event_id").alias("volume"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"),
    )
    cleaned = clean.clean_prices(wire, [F.col("volume").desc()])
    fetched = F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched")
    return cleaned.select("ticker", "date", "close", "volume", fetched)


@query("clean_market", """
SELECT CAST(user_id AS VARCHAR) AS series_code, CAST(ts AS DATE) AS date, MIN(value) AS value
FROM events GROUP BY 1, 2""")
def clean_market(spark, sf):
    wire = _event_messages(spark, sf).drop("fetched_at").withColumn("fetched_at", F.lit(None).cast("string"))
    return clean.clean_market(wire, ["value"]).select("series_code", "date", "value")


@query("clean_news", """
SELECT url, title, category, date_only FROM (
  SELECT source || '/' || lang AS url,
         trim(split_part(text, chr(10), 1), ' ') AS title,
         CASE WHEN lang = 'en' THEN 'general' ELSE lang END AS category,
         DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS date_only,
         row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def clean_news(spark, sf):
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod("doc_id", F.lit(28)).cast("int"))
    wire = parquet(spark, sf, "documents").select(
        "doc_id",
        F.concat_ws("/", "source", "lang").alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00Z")).alias("published_at"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("category"),
        F.lit(None).cast("string").alias("fetched_at"),
    )
    return clean.clean_news(wire, ["doc_id"]).select("url", "title", "category", "date_only")


@query("conform_target", sql("""
SELECT ticker, date, CAST(CAST(close AS DECIMAL(12,4)) AS DOUBLE) AS close, volume FROM prices""", "prices"))
def conform_target(spark, sf):
    typed = clean.conform(standins.prices(spark, sf), schemas.PRICE_TABLE)
    return typed.select("ticker", "date", F.col("close").cast("double").alias("close"), "volume")
