"""Keyed merges of one part of a table into another that overlaps it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.catalogue import query
from tapewright.catalogue.standins import EXACT
from tapewright.operators import dedupe, merge, series
from tapewright.session import shared_folder
from tapewright.sinks import store
from tapewright.sources.tables import parquet

# Orders by a range of their key, which a batch of new orders hardly shares with old ones.
KEY_PART = "floor(o_orderkey / 100000)"
STORED = "o_orderstatus IN ('F', 'P')"
BATCH = "o_orderstatus IN ('P', 'O')"


def _orders(spark, sf):
    return parquet(spark, sf, "orders")


def _insert_parts(spark, sf):
    columns = ("o_orderkey", "o_custkey", "o_totalprice")
    stored = _orders(spark, sf).filter(STORED).select(*columns)
    batch = _orders(spark, sf).filter(BATCH).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    return stored, batch


INSERT_SQL = """
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders"""


@query("insert_if_absent", INSERT_SQL)
def insert_if_absent(spark, sf):
    return merge.insert_if_absent(*_insert_parts(spark, sf), ["o_orderkey"])


@query("insert_twice_into_table", INSERT_SQL)
def insert_twice_into_table(spark, sf):
    """The same batch appended twice to a stored table: the second run adds nothing."""
    stored, batch = _insert_parts(spark, sf)
    path = shared_folder(spark, "orders")
    for rows in (stored, batch, batch):
        store.insert_new(spark, path, stored.schema, rows, ["o_orderkey"], KEY_PART)
    return store.read(spark, path, stored.schema)


@query("new_rows", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'""")
def new_rows(spark, sf):
    return merge.new_rows(*_insert_parts(spark, sf), ["o_orderkey"]).select("o_orderkey")


WEEK = "cast(date_trunc('week', date) AS date)"
BARS = """SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date,
  first(value ORDER BY ts, event_id) AS open, MAX(value) AS high, MIN(value) AS low,
  last(value ORDER BY ts, event_id) AS close, COUNT(value) AS volume FROM events WHERE event_type <> '{}' GROUP BY 1, 2"""

UPSERT_SQL = f"""
WITH o AS ({BARS.format('purchase')}), n AS ({BARS.format('view')})
SELECT ticker, date, COALESCE(o.open, n.open) AS open, COALESCE(n.high, o.high) AS high,
       COALESCE(n.low, o.low) AS low, COALESCE(n.close, o.close) AS close, COALESCE(n.volume, o.volume) AS volume
FROM o FULL JOIN n USING (ticker, date)"""


def _bar_parts(spark, sf):
    events = parquet(spark, sf, "events")

    def bars(without: str):
        rows = events.filter(F.col("event_type") != without)
        made = series.bars(rows, "user_id", "ts", "value", ["event_id"], exact=EXACT)
        return made.withColumn("ticker", F.col("ticker").cast("string")).drop("vwap")

    return bars("purchase"), bars("view")


@query("upsert_partial", UPSERT_SQL)
def upsert_partial(spark, sf):
    """New bars replace everything but the stored open."""
    return merge.upsert_prices(*_bar_parts(spark, sf))


@query("upsert_twice_into_table", UPSERT_SQL)
def upsert_twice_into_table(spark, sf):
    """The same on a stored table in parts by week, twice; only the touched weeks are written anew."""
    stored, batch = _bar_parts(spark, sf)
    path = shared_folder(spark, "bars")
    for rows in (stored, batch, batch):
        store.replace_parts(spark, path, stored.schema, rows, WEEK, merge.upsert_prices)
    return store.read(spark, path, stored.schema)


def _digest(column: str):
    return F.md5(F.col(column).cast("binary")).alias("digest")


@query("upsert_doc", """
SELECT 'https://news.example/' || doc_id AS url,
       CASE WHEN NOT b THEN lang WHEN lang = 'fr' THEN NULL ELSE 'new' END AS title,
       CAST(length(COALESCE(c, '')) AS INTEGER) AS content_length, length(COALESCE(c, '')) > 0 AS has_full_content,
       md5(COALESCE(c, '')) AS digest
FROM (SELECT *, CASE WHEN NOT b THEN text WHEN lang = 'de' THEN NULL WHEN lang = 'fr' THEN '' ELSE upper(source) END AS c
      FROM (SELECT *, n_chars < 2000 OR source >= 'src15' AS b FROM documents))""")
def upsert_doc(spark, sf):
    """Articles replaced field by field: a NULL in the new article is stored too."""
    docs = parquet(spark, sf, "documents").withColumn(
        "url", F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string"))
    )
    stored = merge.with_content_fields(
        docs.filter("source < 'src15'").select("url", F.col("lang").alias("title"), F.col("text").alias("content"))
    )
    content = F.when(F.col("lang") == "fr", "").when(F.col("lang") != "de", F.upper("source"))
    batch = docs.filter("n_chars < 2000 OR source >= 'src15'").select(
        "url", F.when(F.col("lang") != "fr", "new").alias("title"), content.alias("content")
    )
    merged = merge.upsert_articles(stored, batch)
    return merged.withColumn("content", F.coalesce("content", F.lit(""))).select(
        "url", "title", "content_length", "has_full_content", _digest("content")
    )


@query("upsert_keep_text", """
SELECT doc_id AS accession_number, CASE WHEN b THEN 'new' ELSE 'old' END AS form_type,
       md5(CASE WHEN NOT b THEN text WHEN lang <> 'fr' THEN upper(source)
                WHEN source < 'src15' THEN text ELSE '' END) AS digest
FROM (SELECT *, n_chars < 2000 OR source >= 'src15' AS b FROM documents)""")
def upsert_keep_text(spark, sf):
    """Filings without new text keep the stored text; new ones start with an empty text."""
    docs = parquet(spark, sf, "documents").withColumnRenamed("doc_id", "accession_number")
    stored = docs.filter("source < 'src15'").select(
        "accession_number", F.lit("old").alias("form_type"), F.col("text").alias("full_text")
    )
    text = F.when(F.col("lang") == "fr", "").otherwise(F.upper("source"))
    batch = docs.filter("n_chars < 2000 OR source >= 'src15'").select(
        "accession_number", F.lit("new").alias("form_type"), text.alias("full_text")
    )
    merged = merge.upsert_filing_texts(stored, batch)
    return merged.select("accession_number", "form_type", _digest("full_text"))


@query("bulk_reset", """
SELECT doc_id, md5(CASE WHEN lang = 'en' AND length(text) > 1000 THEN '' ELSE text END) AS digest FROM documents""")
def bulk_reset(spark, sf):
    docs = parquet(spark, sf, "documents")
    hit = (F.col("lang") == "en") & (F.length("text") > 1000)
    return merge.reset_where(docs, hit, "text").select("doc_id", _digest("text"))


@query("null_key_rejects", """
SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity <= 1 OR l_discount = 0""")
def null_key_rejects(spark, sf):
    rows = parquet(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.when(F.col("l_quantity") > 1, F.col("l_orderkey")).alias("key_one"),
        F.when(F.col("l_discount") != 0, F.col("l_partkey")).alias("key_two"),
    )
    return dedupe.null_key_rejects(rows, ["key_one", "key_two"]).select("l_orderkey", "l_partkey")
