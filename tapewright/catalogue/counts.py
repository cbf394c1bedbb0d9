"""Counts, lists and totals of filings; quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapewright.catalogue import query, standins
from tapewright.catalogue.standins import sql
from tapewright.functions import dates
from tapewright.operators import dedupe, joins, series, summary
from tapewright.plans import reports
from tapewright.sources.tables import all_of, append_pages, bound_query, parquet
from tapewright.streaming import feeds

AS_OF = dt.date(2001, 6, 30)
PERIOD = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))
IN_PERIOD = "filed_at BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"


@query("counts_by_entity_form", sql("""
SELECT ticker, form_type, COUNT(*) AS n FROM filings WHERE sector = 'BUILDING'
GROUP BY 1, 2""", "filings"))
def counts_by_entity_form(spark, sf):
    """Of the tickers of a sector."""
    members = joins.member_filter(
        standins.filing_facts(spark, sf), standins.companies(spark, sf), "ticker", "ticker", "sector", "BUILDING"
    )
    return reports.filings_by_company(members)


@query("filings_by_company", sql("""
SELECT ticker, form_type, COUNT(*) AS n FROM filings GROUP BY 1, 2""", "filings"))
def filings_by_company(spark, sf):
    return reports.filings_by_company(standins.filing_facts(spark, sf))


@query("counts_by_category", sql("SELECT category, COUNT(*) AS n FROM news GROUP BY 1", "news"))
def counts_by_category(spark, sf):
    return reports.by_category(standins.news(spark, sf))


@query("counts_by_form", sql("SELECT form_type, COUNT(*) AS n FROM filings GROUP BY 1", "filings"))
def counts_by_form(spark, sf):
    return reports.by_form(standins.filing_facts(spark, sf))


@query("counts_by_month_form", sql("""
SELECT strftime(filed_at, '%Y-%m') AS month, form_type, COUNT(*) AS n FROM filings GROUP BY 1, 2""", "filings"))
def counts_by_month_form(spark, sf):
    return reports.by_month(standins.filing_facts(spark, sf))


@query("counts_by_year_form", sql("""
SELECT CAST(year(filed_at) AS INTEGER) AS year, form_type, COUNT(*) AS n FROM filings GROUP BY 1, 2""", "filings"))
def counts_by_year_form(spark, sf):
    return reports.by_year(standins.filing_facts(spark, sf))


@query("counts_by_week", sql("""
SELECT strftime(filed_at, '%G-W%V') AS week, ticker, COUNT(*) AS n FROM filings GROUP BY 1, 2""", "filings"))
def counts_by_week(spark, sf):
    return reports.alert_weeks(standins.filing_facts(spark, sf))


@query("counts_by_week_compat", sql("""
SELECT strftime(filed_at, '%Y-W%V') AS week, COUNT(*) AS n FROM filings GROUP BY 1""", "filings"))
def counts_by_week_compat(spark, sf):
    """The label that pairs the calendar year with the ISO week."""
    return series.weekly_counts(standins.filing_facts(spark, sf), "filed_at", compat=True)


@query("counts_by_ticker", sql("SELECT ticker, COUNT(*) AS n FROM filings GROUP BY 1", "filings"))
def counts_by_ticker(spark, sf):
    return reports.by_ticker(standins.filing_facts(spark, sf))


LISTED = """accession_number, ticker, company_name, form_type, filed_at, period,
       is_material_event, document_url"""


@query("filing_explorer", sql(f"""
SELECT {LISTED} FROM filings
WHERE {IN_PERIOD} AND is_material_event AND lower(company_name) LIKE '%customer#0000001%'""", "filings"))
def filing_explorer(spark, sf):
    chosen = reports.filing_selection(
        standins.filings(spark, sf), PERIOD, material_only=True, company="CUSTOMER#0000001"
    )
    return reports.filing_list(chosen, "Ticker A-Z")


@query("filing_explorer_wildcard", sql(f"""
SELECT {LISTED} FROM filings
WHERE {IN_PERIOD} AND form_type = '2-HIGH' AND lower(company_name) LIKE '%customer#%1_%'""", "filings"))
def filing_explorer_wildcard(spark, sf):
    chosen = reports.filing_selection(
        standins.filings(spark, sf), PERIOD, form="2-HIGH", wildcards=True, company="customer#%1_"
    )
    return reports.filing_list(chosen)


@query("filing_totals", sql(f"""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE is_material_event) AS material,
       COUNT(*) FILTER (WHERE form_type = '2-HIGH') AS of_form, COUNT(DISTINCT ticker) AS companies,
       COUNT(document_url) AS with_document
FROM filings WHERE {IN_PERIOD}""", "filings"))
def filing_totals(spark, sf):
    return reports.filing_totals(reports.filing_selection(standins.filing_facts(spark, sf), PERIOD), "2-HIGH")


@query("filing_links", sql("""
SELECT accession_number, ticker, company_name, form_type, filed_at, document_url
FROM filings WHERE document_url IS NOT NULL""", "filings"))
def filing_links(spark, sf):
    return reports.document_links(standins.filings(spark, sf))


@query("company_drilldown", sql("""
SELECT accession_number, form_type, filed_at, period, is_material_event, document_url
FROM filings WHERE ticker = '7'""", "filings"))
def company_drilldown(spark, sf):
    return reports.company_history(standins.filing_facts(spark, sf, "bigint"), 7)


@query("company_yearly", sql("""
SELECT ticker, CAST(year(filed_at) AS INTEGER) AS year, form_type, COUNT(*) AS n
FROM filings GROUP BY 1, 2, 3""", "filings"))
def company_yearly(spark, sf):
    facts = standins.filing_facts(spark, sf)
    return series.label_counts(facts, "ticker", F.year("filed_at").alias("year"), "form_type")


@query("recent_filings", sql("""
SELECT accession_number, ticker, company_name, form_type, filed_at FROM filings
ORDER BY filed_at DESC, accession_number LIMIT 12""", "filings"))
def recent_filings(spark, sf):
    columns = ("accession_number", "ticker", "company_name", "form_type", "filed_at")
    return reports.recent_filings(standins.filings(spark, sf).select(*columns))


@query("alerts", sql("""
SELECT accession_number, ticker, company_name, form_type, filed_at, document_url FROM filings
WHERE sector = 'BUILDING' AND filed_at >= DATE '2001-06-30' - 90 AND form_type = '1-URGENT'""", "filings"))
def alerts(spark, sf):
    """The watch list is a whole sector."""
    fired = feeds.alerts(standins.filings(spark, sf), standins.watched(spark, sf), AS_OF, 90, standins.MATERIAL)
    columns = ("accession_number", "ticker", "company_name", "form_type", "filed_at", "document_url")
    return fired.select(*columns).orderBy(F.col("filed_at").desc(), "accession_number")


@query("alert_weeks", sql("""
SELECT strftime(filed_at, '%G-W%V') AS week, ticker, COUNT(*) AS n FROM filings
WHERE filed_at >= DATE '2001-06-30' - 90 AND sector = 'BUILDING' GROUP BY 1, 2""", "filings"))
def alert_weeks(spark, sf):
    fired = feeds.alerts(standins.filing_facts(spark, sf), standins.watched(spark, sf), AS_OF, 90)
    return reports.alert_weeks(fired)


@query("range_presets", sql("""
SELECT p.preset, COUNT(*) AS n FROM filings
JOIN (VALUES ('Last 30 days', 30), ('Last 90 days', 90), ('Last 1 year', 365), ('Last 5 years', 1825))
  AS p(preset, days) ON filed_at BETWEEN DATE '2001-06-30' - days AND DATE '2001-06-30'
GROUP BY 1""", "filings"))
def range_presets(spark, sf):
    """Filings in each named range, counted in one pass."""
    facts = standins.filing_facts(spark, sf)
    flags = [
        F.when(reports.between("filed_at", dates.named_range(name, AS_OF)), F.lit(name))
        for name in ("Last 30 days", "Last 90 days", "Last 1 year", "Last 5 years")
    ]
    tagged = facts.select(F.explode(F.array_compact(F.array(*flags))).alias("preset"))
    return series.label_counts(tagged, "preset")


@query("volume_summary", sql("""
WITH v AS (SELECT
  (SELECT COUNT(*) FROM market) AS market_rows,
  (SELECT COUNT(DISTINCT series_code) FROM market) AS series_count,
  (SELECT COUNT(*) FROM filings) AS filing_rows,
  (SELECT COUNT(DISTINCT ticker) FROM filings) AS ticker_count,
  (SELECT COUNT(*) FROM news) AS news_rows,
  (SELECT COUNT(*) FROM prices) AS price_rows,
  (SELECT CAST(SUM(length(text)) AS BIGINT) FROM documents) AS text_chars)
SELECT *, market_rows + filing_rows + news_rows + price_rows AS total_rows,
       text_chars / CAST(1048576 AS DOUBLE) AS text_mb,
       text_chars / CAST(1048576 AS DOUBLE) / CAST(1024 AS DOUBLE) AS text_gb,
       least(CAST(100 AS DOUBLE),
             round(text_chars / CAST(1048576 AS DOUBLE) / CAST(1024 AS DOUBLE) * 100, 1)) AS pct_of_limit
FROM v""", "market", "filings", "news", "prices"))
def volume_summary(spark, sf):
    return summary.volume_summary(
        standins.market(spark, sf), standins.filing_facts(spark, sf), standins.news(spark, sf),
        standins.prices(spark, sf), parquet(spark, sf, "documents"), "text",
    )


@query("freshness", sql("""
SELECT 'market' AS check_name, strftime(MAX(CAST(date AS TIMESTAMP)), '%b %d %H:%M UTC') AS newest FROM market
UNION ALL SELECT 'filings', strftime(MAX(fetched_at), '%b %d %H:%M UTC') FROM filings
UNION ALL SELECT 'news', strftime(MAX(published_at), '%b %d %H:%M UTC') FROM news
UNION ALL SELECT 'events', strftime(MAX(ts), '%b %d %H:%M UTC') FROM events
UNION ALL SELECT 'newest filing', strftime(CAST(MAX(filed_at) AS TIMESTAMP), '%b %d %H:%M UTC') FROM filings
UNION ALL SELECT 'future filings', 'No data'""", "market", "filings", "news"))
def freshness(spark, sf):
    facts = standins.filing_facts(spark, sf)
    return summary.freshness([
        ("market", standins.market(spark, sf), "date"),
        ("filings", facts, "fetched_at"),
        ("news", standins.news(spark, sf), "published_at"),
        ("events", parquet(spark, sf, "events"), "ts"),
        ("newest filing", facts, "filed_at"),
        ("future filings", facts.filter("filed_at > DATE '2200-01-01'"), "filed_at"),
    ])


@query("key_violations", sql("SELECT url, COUNT(*) AS n FROM news GROUP BY 1 HAVING COUNT(*) > 1", "news"))
def key_violations(spark, sf):
    return summary.key_violations(standins.news(spark, sf), ["url"])


@query("field_violations", """
SELECT COUNT(*) FILTER (WHERE event_id IS NULL) AS event_id_missing,
       COUNT(*) FILTER (WHERE value IS NULL) AS value_missing,
       COUNT(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS DATE) IS NULL) AS event_type_not_date,
       COUNT(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DECIMAL(4,2)) IS NULL)
         AS "value_not_decimal(4,2)"
FROM events""")
def field_violations(spark, sf):
    return summary.field_violations(
        parquet(spark, sf, "events"), ["event_id", "value"], {"event_type": "date", "value": "decimal(4,2)"}
    )


@query("stage_counts", sql("""
SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE category <> 'N') AS rows_usable,
       COUNT(DISTINCT url) FILTER (WHERE category <> 'N') AS rows_kept,
       COUNT(*) - COUNT(DISTINCT url) FILTER (WHERE category <> 'N') AS rows_dropped
FROM news""", "news"))
def stage_counts(spark, sf):
    return summary.stage_counts(standins.news(spark, sf), F.col("category") != "N", ["url"])


@query("dedupe_natural_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_natural_key(spark, sf):
    columns = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return dedupe.keep_first(parquet(spark, sf, "lineitem").select(*columns), ["l_orderkey", "l_linenumber"])


@query("dedupe_first_seen", """
SELECT doc_id, md5(text) AS digest, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedupe_first_seen(spark, sf):
    """Only a digest of each text travels."""
    rows = parquet(spark, sf, "documents").select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "source"
    )
    return dedupe.keep_first(rows, ["digest"], ["doc_id"])


@query("ordered_distinct", """
SELECT l_returnflag, MIN(l_orderkey) AS first_order FROM lineitem GROUP BY 1""")
def ordered_distinct(spark, sf):
    """Distinct values in the order they first appear."""
    lines = parquet(spark, sf, "lineitem")
    return lines.groupBy("l_returnflag").agg(F.min("l_orderkey").alias("first_order")).orderBy("first_order")


@query("top_n_per_key", sql("""
SELECT ticker, accession_number, filed_at, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY ticker ORDER BY filed_at, accession_number) AS INTEGER) AS rank
  FROM filings) WHERE rank <= 20""", "filings"))
def top_n_per_key(spark, sf):
    facts = standins.filing_facts(spark, sf).select("ticker", "accession_number", "filed_at")
    return dedupe.top_n_per_key(facts, ["ticker"], ["filed_at", "accession_number"], 20)


@query("top_n_per_hot_key", """
SELECT l_returnflag, l_orderkey, l_extendedprice, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_returnflag
    ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey) AS INTEGER) AS rank
  FROM lineitem) WHERE rank <= 1500""")
def top_n_per_hot_key(spark, sf):
    """Three keys hold all rows; each is cut to its first n per salt before its rows meet."""
    lines = parquet(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    order = [F.col("l_extendedprice").desc(), "l_orderkey", "l_partkey", "l_suppkey"]
    top = dedupe.top_n_per_key(lines, ["l_returnflag"], order, 1500)
    return top.drop("l_partkey", "l_suppkey")


@query("union_pages", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
       CAST(CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 0 ELSE 1 END AS INTEGER) AS page FROM orders""")
def union_pages(spark, sf):
    orders = parquet(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    split = F.lit(dt.date(1999, 1, 1))
    return append_pages([orders.filter(F.col("date") >= split), orders.filter(F.col("date") < split)])


@query("bound_sql", """
SELECT c_mktsegment, COUNT(*) AS n FROM customer WHERE c_acctbal >= 1000 AND c_mktsegment <> 'BUILDING' GROUP BY 1""")
def bound_sql(spark, sf):
    return bound_query(
        spark,
        "SELECT c_mktsegment, count(*) AS n FROM {customer} "
        "WHERE c_acctbal >= :least AND c_mktsegment <> :skip GROUP BY 1",
        {"customer": parquet(spark, sf, "customer")}, least=1000, skip="BUILDING",
    )


@query("optional_conditions", sql("""
SELECT accession_number, filed_at FROM filings WHERE form_type IN ('1-URGENT', '5-LOW')
  AND filed_at >= DATE '2001-06-30' - 365""", "filings"))
def optional_conditions(spark, sf):
    """Conditions left out (None) do not restrict."""
    conditions = [
        F.col("form_type").isin("1-URGENT", "5-LOW"), None, dates.since(F.col("filed_at"), AS_OF, 365), None,
    ]
    return standins.filing_facts(spark, sf).filter(all_of(conditions)).select("accession_number", "filed_at")
