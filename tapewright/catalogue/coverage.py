"""Date-window, as-of, interval and dictionary joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapewright.catalogue import query, standins
from tapewright.catalogue.standins import sql
from tapewright.dims import literal_frame
from tapewright.operators import joins
from tapewright.plans import reports
from tapewright.sources.tables import parquet

BANDS = [
    ("1996-03-01", "1996-11-01", "first"),
    ("1998-12-01", "2000-06-01", "second"),
    ("2000-02-01", "2000-04-01", "third"),
]

WINDOW_SQL = """
WITH daily AS (SELECT date_only, COUNT(*) AS n FROM news GROUP BY 1),
days AS (SELECT DISTINCT filed_at FROM filings),
hits AS (
  SELECT filed_at, CAST(SUM(n) AS BIGINT) AS news_count,
         CAST(MIN(abs(date_only - filed_at)) AS INTEGER) AS min_days_apart
  FROM days JOIN daily ON date_only BETWEEN filed_at - {n} AND filed_at + {n} GROUP BY 1),
covered AS (
  SELECT accession_number, ticker, company_name, form_type, filed_at,
         COALESCE(news_count, 0) AS news_count, min_days_apart
  FROM filings LEFT JOIN hits USING (filed_at))
"""


@query("news_window_7d", sql(WINDOW_SQL.format(n=7) + "SELECT * FROM covered", "filings", "news"))
def news_window_7d(spark, sf):
    return reports.coverage(standins.filings(spark, sf), standins.news(spark, sf))


@query(
    "news_window_nd",
    sql(WINDOW_SQL.format(n=2) + "SELECT * EXCLUDE (min_days_apart) FROM covered", "filings", "news"),
)
def news_window_nd(spark, sf):
    return reports.coverage(standins.filings(spark, sf), standins.news(spark, sf), 2).drop("min_days_apart")


@query("news_window_timestamps", sql(WINDOW_SQL.format(n=7) + "SELECT accession_number, news_count, min_days_apart FROM covered", "filings", "news"))
def news_window_timestamps(spark, sf):
    """Both sides at some time of their day: counted by calendar day all the same."""
    filings = standins.filings(spark, sf).withColumn("filed_at", F.expr("timestamp(filed_at) + INTERVAL 10 HOURS"))
    news = standins.news(spark, sf).withColumn("date_only", F.expr("timestamp(date_only) + INTERVAL 9 HOURS"))
    return reports.coverage(filings, news).select("accession_number", "news_count", "min_days_apart")


@query("top_covered_filings", sql(WINDOW_SQL.format(n=7) + """
SELECT * FROM covered WHERE news_count > 0
ORDER BY news_count DESC, filed_at DESC, accession_number LIMIT 50""", "filings", "news"))
def top_covered_filings(spark, sf):
    return reports.top_coverage(
        reports.coverage(standins.filings(spark, sf), standins.news(spark, sf))
    )


@query("news_window_by_company", sql("""
WITH events AS (SELECT DISTINCT ticker, form_type, filed_at FROM filings),
lines AS (SELECT o.o_custkey, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders o ON l_orderkey = o_orderkey)
SELECT ticker, form_type, filed_at, COUNT(d) AS news_count,
       CAST(MIN(abs(d - filed_at)) AS INTEGER) AS min_days_apart
FROM events LEFT JOIN lines ON CAST(o_custkey AS VARCHAR) = ticker AND d BETWEEN filed_at - 14 AND filed_at + 14
GROUP BY 1, 2, 3""", "filings"))
def news_window_by_company(spark, sf):
    """News about the same company only, one row per company, form and day."""
    own = parquet(spark, sf, "lineitem").join(
        parquet(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    about = own.select(
        F.col("o_custkey").cast("string").alias("ticker"), F.to_date("l_shipdate").alias("date_only")
    )
    return reports.coverage(
        standins.filing_facts(spark, sf), about, 14, on=["ticker"], by=["ticker", "form_type", "filed_at"]
    )


@query("asof_nearest_value", sql("""
WITH line AS (SELECT date, value FROM market WHERE series_code = '5-LOW'),
days AS (SELECT DISTINCT filed_at AS date, ticker, form_type FROM filings
         WHERE form_type IN ('1-URGENT', '2-HIGH')),
d AS (SELECT DISTINCT date FROM days),
b AS (SELECT d.date, p.date AS pd, p.value AS pv FROM d ASOF LEFT JOIN line p ON d.date >= p.date),
f AS (SELECT d.date, p.date AS fd, p.value AS fv FROM d ASOF LEFT JOIN line p ON d.date <= p.date),
hit AS (
  SELECT date, CASE WHEN fd IS NULL OR date - pd <= fd - date THEN pd ELSE fd END AS matched_date,
         CASE WHEN fd IS NULL OR date - pd <= fd - date THEN pv ELSE fv END AS value
  FROM b JOIN f USING (date))
SELECT * FROM days LEFT JOIN hit USING (date)""", "filings", "market"))
def asof_nearest_value(spark, sf):
    return reports.filing_markers(
        standins.market(spark, sf), standins.filing_facts(spark, sf), "5-LOW", ("1-URGENT", "2-HIGH")
    )


@query("asof_timestamps", sql("""
WITH line AS (SELECT date, value FROM market WHERE series_code = '5-LOW'),
days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
hit AS (SELECT o_orderkey, date AS matched_date, value FROM days ASOF LEFT JOIN line ON days.d >= line.date)
SELECT * FROM hit""", "market"))
def asof_timestamps(spark, sf):
    """Orders and points at some time of their day, matched by calendar day."""
    orders = parquet(spark, sf, "orders").select("o_orderkey", F.expr("timestamp(to_date(o_orderdate)) + INTERVAL 1 HOUR").alias("at"))
    line = standins.market(spark, sf).filter("series_code = '5-LOW'").select(
        F.expr("timestamp(date) + INTERVAL 20 HOURS").alias("date"), "value")
    return joins.asof_join(orders, line, "at", "date", ["value"], direction="backward").drop("at")


@query("asof_price_by_ticker", sql("""
WITH wanted AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date
                FROM events WHERE event_type = 'purchase'),
line AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS pd, MAX(value) AS top_value
         FROM events WHERE event_type <> 'purchase' GROUP BY 1, 2)
SELECT w.ticker, w.date, CASE WHEN w.date - pd <= 3 THEN pd END AS matched_date,
       CASE WHEN w.date - pd <= 3 THEN top_value END AS top_value
FROM wanted w ASOF LEFT JOIN line p ON w.ticker = p.ticker AND w.date >= p.pd"""))
def asof_price_by_ticker(spark, sf):
    """Backward as-of per ticker, at most three days back."""
    events = parquet(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("ticker"), F.to_date("ts").alias("date"), "event_type", "value"
    )
    wanted = events.filter("event_type = 'purchase'").select("ticker", "date").distinct()
    line = (
        events.filter("event_type <> 'purchase'")
        .groupBy("ticker", "date")
        .agg(F.max("value").alias("top_value"))
    )
    return joins.asof_join(
        wanted, line, "date", "date", ["top_value"], by=["ticker"], direction="backward", tolerance=3
    )


@query("interval_tag", """
WITH bands(s, e, band) AS (VALUES (DATE '1996-03-01', DATE '1996-11-01', 'first'),
  (DATE '1998-12-01', DATE '2000-06-01', 'second'), (DATE '2000-02-01', DATE '2000-04-01', 'third'))
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, band
FROM orders LEFT JOIN bands ON CAST(o_orderdate AS DATE) BETWEEN s AND e""")
def interval_tag(spark, sf):
    days = parquet(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return joins.interval_tag(days, "date", BANDS)


@query("lookup_padded_key", """
SELECT o_orderkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik
FROM orders JOIN customer ON 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') = c_name""")
def lookup_padded_key(spark, sf):
    """Company names looked up without regard to case."""
    named = parquet(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("name")
    )
    return joins.padded_lookup(named, parquet(spark, sf, "customer"), "name", "c_name", "c_custkey").drop("name")


@query("name_lookup_default", """
SELECT series_code, COALESCE(series_name, series_code) AS series_name, COUNT(*) AS n
FROM (SELECT l_returnflag AS series_code FROM lineitem)
LEFT JOIN (VALUES ('A', 'Accepted'), ('R', 'Returned')) AS names(series_code, series_name) USING (series_code)
GROUP BY 1, 2""")
def name_lookup_default(spark, sf):
    names = literal_frame(
        spark, [("A", "Accepted"), ("R", "Returned")], "series_code", "series_name"
    )
    rows = parquet(spark, sf, "lineitem").select(F.col("l_returnflag").alias("series_code"))
    named = joins.name_lookup(rows, names, "series_code", "series_name")
    return named.groupBy("series_code", "series_name").agg(F.count(F.lit(1)).alias("n"))


@query("sector_filter", sql("""
SELECT accession_number, ticker, filed_at FROM filings WHERE sector = 'BUILDING'""", "filings"))
def sector_filter(spark, sf):
    """Nothing picked: the whole sector."""
    found = joins.member_filter(
        standins.filing_facts(spark, sf), standins.companies(spark, sf), "ticker", "ticker", "sector", "BUILDING"
    )
    return found.select("accession_number", "ticker", "filed_at")


@query("first_members", """
SELECT c_mktsegment, c_custkey, c_name FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn FROM customer) WHERE rn <= 5""")
def first_members(spark, sf):
    members = parquet(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_name")
    return joins.first_members(members, "c_mktsegment", "c_custkey")
