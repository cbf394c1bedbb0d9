"""The supplied tables in the shape of the four feeds, in Spark and as SQL.

filings  orders with their customer      key accession_number (the order key)
news     order lines by ship date        key url, with real duplicates
market   mean order price per priority and day (whole cents)
prices   daily bars of event values per user
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewright.operators import series
from tapewright.sources.tables import parquet

CODES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
COLUMNS = dict(zip(CODES, ["urgent", "high", "medium", "unspecified", "low"]))
MATERIAL = "1-URGENT"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# The type in which the means of the stand-ins are added up, in Spark as in SQL.
EXACT = "decimal(18,6)"
ALL_TIME = (dt.date(1990, 1, 1), dt.date(2030, 1, 1))


def filing_facts(spark: SparkSession, sf: str, key: str = "string") -> DataFrame:
    """Filings without the company's own fields (no join); the key's stored type lets filters reach the scan."""
    day = F.to_date("o_orderdate")
    return parquet(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("accession_number"),
        F.col("o_custkey").cast(key).alias("ticker"),
        F.col("o_orderpriority").alias("form_type"),
        day.alias("filed_at"),
        F.date_sub(day, 30).alias("period"),
        (F.col("o_orderpriority") == MATERIAL).alias("is_material_event"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.concat(F.lit("https://filings.example/"), F.col("o_orderkey").cast("string")),
        ).alias("document_url"),
        F.col("o_orderdate").alias("fetched_at"),
    )


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return parquet(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
    )


def watched(spark: SparkSession, sf: str) -> DataFrame:
    """The companies of one sector as a watch list."""
    return companies(spark, sf).filter("sector = 'BUILDING'").select("ticker")


def filings(spark: SparkSession, sf: str) -> DataFrame:
    return filing_facts(spark, sf).join(companies(spark, sf), "ticker")


def news(spark: SparkSession, sf: str) -> DataFrame:
    return parquet(spark, sf, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("url"),
        F.col("l_returnflag").alias("category"),
        F.col("l_shipdate").alias("published_at"),
        F.to_date("l_shipdate").alias("date_only"),
    )


def market(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return (
        parquet(spark, sf, "orders")
        .withColumn("_cents", cents)
        .groupBy(F.col("o_orderpriority").alias("series_code"), F.to_date("o_orderdate").alias("date"))
        .agg(F.expr("sum(_cents) div count(1)").alias("_mean"))
        .select(
            "series_code",
            F.concat(F.lit("Series "), F.col("series_code")).alias("series_name"),
            "date",
            (F.col("_mean").cast("double") / 100).alias("value"),
        )
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    bars = series.bars(parquet(spark, sf, "events"), "user_id", "ts", "value", ["event_id"], exact=EXACT)
    return bars.withColumn("ticker", F.col("ticker").cast("string"))


def type_prices(spark: SparkSession, sf: str) -> DataFrame:
    """The same per event type: five tickers hold all rows."""
    return series.bars(parquet(spark, sf, "events"), "event_type", "ts", "value", ["event_id"], exact=EXACT)


VIEWS = {
    "filings": """
        SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, CAST(o_custkey AS VARCHAR) AS ticker,
               c_name AS company_name, c_mktsegment AS sector, o_orderpriority AS form_type,
               CAST(o_orderdate AS DATE) AS filed_at, CAST(o_orderdate AS DATE) - 30 AS period,
               o_orderpriority = '1-URGENT' AS is_material_event,
               CASE WHEN o_orderstatus <> 'P' THEN 'https://filings.example/' || o_orderkey END AS document_url,
               o_orderdate AS fetched_at
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "news": """
        SELECT l_orderkey || '-' || l_linenumber AS url, l_returnflag AS category,
               l_shipdate AS published_at, CAST(l_shipdate AS DATE) AS date_only
        FROM lineitem""",
    "market": """
        SELECT o_orderpriority AS series_code, 'Series ' || o_orderpriority AS series_name,
               CAST(o_orderdate AS DATE) AS date,
               CAST(CAST(SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // COUNT(*) AS DOUBLE)
                 / CAST(100 AS DOUBLE) AS value
        FROM orders GROUP BY 1, 2, 3""",
    "prices": """
        SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS date,
               first(value ORDER BY ts, event_id) AS open, MAX(value) AS high, MIN(value) AS low,
               last(value ORDER BY ts, event_id) AS close, COUNT(value) AS volume,
               CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / COUNT(value) AS vwap
        FROM events GROUP BY 1, 2""",
    "type_prices": """
        SELECT event_type AS ticker, CAST(ts AS DATE) AS date, last(value ORDER BY ts, event_id) AS close,
               COUNT(value) AS volume
        FROM events GROUP BY 1, 2""",
}


def sql(body: str, *views: str) -> str:
    """The body with the named stand-ins (and any of its own) as common table expressions."""
    parts = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views)
    body = body.strip()
    own = body.upper().startswith("WITH ")
    if not parts:
        return body
    return f"WITH {parts}" + (f",\n{body[5:]}" if own else f"\n{body}")
