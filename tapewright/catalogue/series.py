"""Time series: snapshots, means, changes, bars, correlations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tapewright import dims
from tapewright.catalogue import query, standins
from tapewright.catalogue.coverage import BANDS
from tapewright.catalogue.standins import ALL_TIME, CODES, COLUMNS, EVENT_TYPES, EXACT, sql
from tapewright.operators import correlation, series
from tapewright.operators.dedupe import nth_per_key
from tapewright.plans import reports
from tapewright.sources.tables import parquet

PERIOD = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))
IN_PERIOD = "date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"
LINE = "OVER (PARTITION BY series_code ORDER BY date"
MEAN = """CASE WHEN COUNT(value) OVER w = {n} THEN
  CAST(SUM(CAST(value AS DECIMAL(18,6))) OVER w AS DOUBLE) / {n} END"""


@query("latest_prev_change", sql("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY series_code ORDER BY date DESC) AS rn FROM market),
b AS (SELECT series_code, MAX(value) FILTER (WHERE rn = 1) AS latest, MAX(date) FILTER (WHERE rn = 1) AS latest_date,
             MAX(value) FILTER (WHERE rn = 2) AS prev, MAX(date) FILTER (WHERE rn = 2) AS prev_date
      FROM r WHERE rn <= 2 GROUP BY 1)
SELECT *, latest - prev AS change, (latest - prev) / abs(prev) * 100 AS pct,
       CASE WHEN latest > prev THEN 'up' WHEN latest < prev THEN 'down' ELSE 'flat' END AS direction,
       CASE series_code WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low' ELSE series_code END AS label,
       CASE series_code WHEN '1-URGENT' THEN '%' ELSE '' END AS unit
FROM b""", "market"))
def latest_prev_change(spark, sf):
    return reports.macro_snapshot(
        standins.market(spark, sf), CODES, {"1-URGENT": "Urgent", "5-LOW": "Low"}, {"1-URGENT": "%"}
    )


@query("second_latest", sql("""
SELECT series_code, date, value FROM (
  SELECT *, row_number() OVER (PARTITION BY series_code ORDER BY date DESC) AS rn FROM market) WHERE rn = 2""", "market"))
def second_latest(spark, sf):
    rows = standins.market(spark, sf).select("series_code", "date", "value")
    return nth_per_key(rows, ["series_code"], [F.col("date").desc()], 2)


@query("rolling_mean_50", sql(f"""
SELECT series_code, date, value, {MEAN.format(n=50)} AS rolling_mean FROM market
WINDOW w AS (PARTITION BY series_code ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""", "market"))
def rolling_mean_50(spark, sf):
    rows = standins.market(spark, sf).select("series_code", "date", "value")
    return series.rolling_mean(rows, ["series_code"], "date", "value", 50, exact=EXACT)


@query("index_with_mean_50", sql(f"""
SELECT series_code, date, value, {MEAN.format(n=50)} AS rolling_mean FROM market WHERE series_code = '1-URGENT'
WINDOW w AS (PARTITION BY series_code ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""", "market"))
def index_with_mean_50(spark, sf):
    return reports.index_with_mean(standins.market(spark, sf), "1-URGENT", exact=EXACT)


@query("pct_change", sql(f"""
WITH l AS (SELECT series_code, date, value, lag(value) {LINE}) AS p FROM market)
SELECT series_code, date, value, CASE WHEN p <> 0 THEN (value / p - 1) * 100 END AS pct_change FROM l""", "market"))
def pct_change(spark, sf):
    rows = standins.market(spark, sf).select("series_code", "date", "value")
    return series.pct_change(rows, ["series_code"], "date", "value")


@query("pct_change_filled", sql(f"""
WITH days AS (SELECT DISTINCT date FROM market), codes AS (SELECT DISTINCT series_code FROM market),
g AS (SELECT series_code, date, value FROM days CROSS JOIN codes LEFT JOIN market USING (series_code, date)),
k AS (SELECT *, last_value(value IGNORE NULLS) {LINE} ROWS UNBOUNDED PRECEDING) AS known FROM g),
l AS (SELECT *, lag(known) {LINE}) AS p FROM k)
SELECT series_code, date, value, CASE WHEN p <> 0 THEN (known / p - 1) * 100 END AS pct_change FROM l""", "market"))
def pct_change_filled(spark, sf):
    """Days without a value carry the last one forward."""
    wide = series.pivot_mean(standins.market(spark, sf), "date", "series_code", "value", {c: c for c in CODES}, EXACT)
    grid = wide.unpivot(["date"], CODES, "series_code", "value")
    return series.pct_change(grid, ["series_code"], "date", "value")


@query("rebase_100", sql(f"""
SELECT series_code, date, value, value / first_value(value) {LINE}) * 100 AS rebased
FROM market WHERE {IN_PERIOD}""", "market"))
def rebase_100(spark, sf):
    rows = reports.indicator(standins.market(spark, sf), CODES, PERIOD)
    return series.rebase(rows, ["series_code"], "date", "value", ieee=True)


@query("period_stats", sql(f"""
SELECT series_code, arg_min(value, date) AS first_value, arg_max(value, date) AS last_value,
       MAX(value) AS high, MIN(value) AS low, COUNT(*) AS n,
       arg_max(value, date) - arg_min(value, date) AS change,
       (arg_max(value, date) - arg_min(value, date)) / abs(arg_min(value, date)) * 100 AS pct
FROM market WHERE {IN_PERIOD} GROUP BY 1""", "market"))
def period_stats(spark, sf):
    rows = reports.indicator(standins.market(spark, sf), CODES, PERIOD)
    return series.period_stats(rows, ["series_code"], "date", "value")


@query("histogram_50", sql("""
WITH b AS (SELECT series_code, MIN(value) AS lo, MAX(value) AS hi FROM market GROUP BY 1),
p AS (SELECT series_code, lo, hi,
        CAST(CASE WHEN hi > lo THEN least(floor((value - lo) * 50 / (hi - lo)), 49) ELSE 0 END AS INTEGER) AS bin
      FROM market JOIN b USING (series_code))
SELECT series_code, bin, lo + bin * ((hi - lo) / 50) AS bin_start, COUNT(*) AS n
FROM p GROUP BY 1, 2, 3""", "market"))
def histogram_50(spark, sf):
    rows = standins.market(spark, sf).select("series_code", "value")
    return series.histogram(rows, "series_code", "value")


@query("price_histogram", """
WITH b AS (SELECT l_returnflag, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem GROUP BY 1),
p AS (SELECT l_returnflag, lo, hi,
        CAST(least(floor((l_extendedprice - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin
      FROM lineitem JOIN b USING (l_returnflag))
SELECT l_returnflag, bin, lo + bin * ((hi - lo) / 50) AS bin_start, COUNT(*) AS n FROM p GROUP BY 1, 2, 3""")
def price_histogram(spark, sf):
    """Three keys hold all rows."""
    return series.histogram(
        parquet(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", members=["A", "N", "R"]
    )


@query("indicator_lines", sql(f"""
WITH r AS (SELECT series_code, date, value, {MEAN.format(n=20)} AS rolling_mean,
      lag(value) {LINE}) AS p, first_value(value) {LINE}) AS f
    FROM market WHERE {IN_PERIOD} AND series_code IN ('1-URGENT', '2-HIGH')
    WINDOW w AS (PARTITION BY series_code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
bands(s, e, band) AS (VALUES (DATE '1996-03-01', DATE '1996-11-01', 'first'),
  (DATE '1998-12-01', DATE '2000-06-01', 'second'), (DATE '2000-02-01', DATE '2000-04-01', 'third'))
SELECT series_code, date, value, rolling_mean, CASE WHEN p <> 0 THEN (value / p - 1) * 100 END AS pct_change,
       value / f * 100 AS rebased, band
FROM r LEFT JOIN bands ON date BETWEEN s AND e""", "market"))
def indicator_lines(spark, sf):
    return reports.indicator_lines(standins.market(spark, sf), CODES[:2], PERIOD, 20, BANDS, EXACT)


@query("indicator_list", sql("SELECT DISTINCT series_code, series_name FROM market", "market"))
def indicator_list(spark, sf):
    return reports.indicator_list(standins.market(spark, sf))


@query("newest_points", sql("""
SELECT series_code, date, value FROM market WHERE series_code = '3-MEDIUM' ORDER BY date DESC LIMIT 500""", "market"))
def newest_points(spark, sf):
    return reports.newest_points(standins.market(spark, sf), "3-MEDIUM", ALL_TIME)


@query("month_end", sql("""
SELECT series_code, last_day(date) AS month_end, arg_max(value, date) AS value FROM market GROUP BY 1, 2""", "market"))
def month_end(spark, sf):
    return series.month_end(standins.market(spark, sf), ["series_code"], "date", "value")


@query("ohlcv_bars", sql("SELECT * FROM prices", "prices"))
def ohlcv_bars(spark, sf):
    return standins.prices(spark, sf)


@query("price_table", sql("""
SELECT * FROM prices WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""", "prices"))
def price_table(spark, sf):
    period = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    return reports.price_table(standins.prices(spark, sf), [], period)


@query("price_view", sql("""
SELECT ticker, date, value / first_value(value) OVER (PARTITION BY ticker ORDER BY date) * 100 AS value
FROM (SELECT ticker, date, close AS value FROM prices
      WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')""", "prices"))
def price_view(spark, sf):
    period = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    return reports.price_view(standins.prices(spark, sf), [], period, "close", True)


@query("price_view_volume", sql("SELECT ticker, date, CAST(volume AS DOUBLE) AS value FROM type_prices", "type_prices"))
def price_view_volume(spark, sf):
    return reports.price_view(standins.type_prices(spark, sf), EVENT_TYPES, ALL_TIME, "volume")


@query("price_changes", sql("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM prices),
b AS (SELECT ticker, MAX(close) FILTER (WHERE rn = 1) AS latest, MAX(date) FILTER (WHERE rn = 1) AS latest_date,
             COALESCE(MAX(close) FILTER (WHERE rn = 2), MAX(close) FILTER (WHERE rn = 1)) AS prev,
             MAX(date) FILTER (WHERE rn = 2) AS prev_date
      FROM r GROUP BY 1)
SELECT *, latest - prev AS change, CASE WHEN prev <> 0 THEN (latest - prev) / abs(prev) * 100 END AS pct,
       CASE WHEN latest >= prev THEN 'up' ELSE 'down' END AS direction
FROM b""", "prices"))
def price_changes(spark, sf):
    return reports.price_changes(standins.prices(spark, sf), [], ALL_TIME)


@query("avg_volume_rank", sql("""
SELECT ticker, CAST(SUM(volume) AS DOUBLE) / COUNT(volume) AS avg_volume FROM prices GROUP BY 1""", "prices"))
def avg_volume_rank(spark, sf):
    return series.mean_rank(standins.prices(spark, sf), "ticker", "volume", "avg_volume")


PAIR_SQL = """
SELECT x.k AS a, y.k AS b, COUNT(*) AS n, round(corr(x.v, y.v), 6) AS corr
FROM ret x JOIN ret y ON x.d = y.d AND x.k < y.k GROUP BY 1, 2"""


@query("return_corr", """
WITH c AS (SELECT event_type AS k, CAST(ts AS DATE) AS d, last(value ORDER BY ts, event_id) AS v FROM events GROUP BY 1, 2),
g AS (SELECT k, d, v FROM (SELECT DISTINCT d FROM c) CROSS JOIN (SELECT DISTINCT k FROM c) LEFT JOIN c USING (k, d)),
f AS (SELECT k, d, last_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS v FROM g),
r AS (SELECT k, d, (v / NULLIF(lag(v) OVER (PARTITION BY k ORDER BY d), 0) - 1) * 100 AS v FROM f),
ret AS (SELECT * FROM r WHERE d IN (SELECT d FROM r GROUP BY 1 HAVING COUNT(v) = 5))
""" + PAIR_SQL)
def return_corr(spark, sf):
    corr = correlation.return_corr(standins.type_prices(spark, sf), "ticker", "date", "close", EVENT_TYPES, EXACT)
    return corr.withColumn("corr", F.round("corr", 6))


@query("price_correlation", sql("""
WITH c AS (SELECT ticker AS k, date AS d, close AS v FROM type_prices
           WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'),
g AS (SELECT k, d, v FROM (SELECT DISTINCT d FROM c) CROSS JOIN (SELECT DISTINCT k FROM c) LEFT JOIN c USING (k, d)),
f AS (SELECT k, d, last_value(v IGNORE NULLS) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS v FROM g),
r AS (SELECT k, d, (v / NULLIF(lag(v) OVER (PARTITION BY k ORDER BY d), 0) - 1) * 100 AS v FROM f),
ret AS (SELECT * FROM r WHERE d IN (SELECT d FROM r GROUP BY 1 HAVING COUNT(v) = 5))
""" + PAIR_SQL, "type_prices"))
def price_correlation(spark, sf):
    period = (dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    corr = reports.price_correlation(standins.type_prices(spark, sf), EVENT_TYPES, period, EXACT)
    return corr.withColumn("corr", F.round("corr", 6))


@query("monthly_corr", sql("""
WITH m AS (SELECT series_code AS k, last_day(date) AS d, arg_max(value, date) AS v FROM market GROUP BY 1, 2),
ret AS (SELECT * FROM m WHERE d IN (SELECT d FROM m GROUP BY 1 HAVING COUNT(v) >= 3))
""" + PAIR_SQL, "market"))
def monthly_corr(spark, sf):
    corr = reports.macro_correlation(standins.market(spark, sf), CODES, ALL_TIME, exact=EXACT)
    return corr.withColumn("corr", F.round("corr", 6))


WIDE = ", ".join(f"AVG(value) FILTER (WHERE series_code = '{c}') AS {n}" for c, n in COLUMNS.items())


@query("pivot_daily", sql(f"SELECT date, {WIDE} FROM market GROUP BY 1", "market"))
def pivot_daily(spark, sf):
    return series.pivot_mean(standins.market(spark, sf), "date", "series_code", "value", COLUMNS, EXACT)


FILLED = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE 1 END" for n in COLUMNS.values())


@query("drop_sparse_rows", sql(
    f"WITH wide AS (SELECT date, {WIDE} FROM market GROUP BY 1) SELECT * FROM wide WHERE {FILLED} >= 3", "market"
))
def drop_sparse_rows(spark, sf):
    return series.drop_sparse(pivot_daily(spark, sf), list(COLUMNS.values()), 3)


@query("tiny_and_huge_values", """
SELECT event_type AS series_code, CAST(ts AS DATE) AS date,
       CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / COUNT(value) > 0 AS positive,
       MIN(value) / 1e7 AS least, round(AVG(value * 1e9) / 1e9, 3) AS huge
FROM events WHERE value > 0 GROUP BY 1, 2""")
def tiny_and_huge_values(spark, sf):
    """Means keep values far below 1e-6 and far above 1e12."""
    events = parquet(spark, sf, "events").filter("value > 0").select(
        F.col("event_type").alias("series_code"), F.to_date("ts").alias("date"), "value")
    keys = ["series_code"]
    tiny = series.one_per_day(events.withColumn("value", F.col("value") / 1e7), keys, "date", "value")
    huge = series.one_per_day(events.withColumn("value", F.col("value") * 1e9), keys, "date", "value")
    least = events.groupBy(*keys, "date").agg((F.min("value") / 1e7).alias("least"))
    both = tiny.withColumnRenamed("value", "tiny").join(huge.withColumnRenamed("value", "huge"), [*keys, "date"])
    return both.join(least, [*keys, "date"]).select(
        *keys, "date", (F.col("tiny") > 0).alias("positive"), "least", F.round(F.col("huge") / 1e9, 3).alias("huge"))


# The stand-ins' series under the codes of the overview, and their tickers under those of the listed sectors.
SNAPSHOT = dict(zip(CODES, dims.SNAPSHOT_LABELS))


@query("macro_overview", sql(f"""
WITH m AS (SELECT CASE series_code {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in SNAPSHOT.items())} END AS series_code, date, value FROM market),
r AS (SELECT *, row_number() OVER (PARTITION BY series_code ORDER BY date DESC) AS rn FROM m),
b AS (SELECT series_code, MAX(value) FILTER (WHERE rn = 1) AS latest, MAX(value) FILTER (WHERE rn = 2) AS prev FROM r WHERE rn <= 2 GROUP BY 1)
SELECT series_code, CASE series_code {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in dims.SNAPSHOT_LABELS.items())} END AS label,
  CASE series_code {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in dims.SNAPSHOT_UNITS.items())} END AS unit, latest, prev, latest - prev AS change FROM b""", "market"))
def macro_overview(spark, sf):
    coded = standins.market(spark, sf).replace(SNAPSHOT, subset=["series_code"])
    return reports.macro_overview(coded).select("series_code", "label", "unit", "latest", "prev", "change")


@query("recession_lines", sql(f"""
WITH b AS (SELECT * FROM (VALUES {", ".join(f"(DATE '{a}', DATE '{b}', '{c}')" for a, b, c in dims.RECESSIONS)}) t(f, t, recession))
SELECT series_code, date, value, recession FROM market LEFT JOIN b ON date BETWEEN f AND t WHERE date >= DATE '2000-01-01'""", "market"))
def recession_lines(spark, sf):
    return reports.recession_lines(standins.market(spark, sf), CODES, (dims.SERIES_START, ALL_TIME[1]))


@query("sector_volume", sql(f"""
WITH s AS (SELECT unnest({dims.SECTORS["All"]!r}) AS ticker, unnest(range({len(dims.SECTORS["All"])})) AS i),
p AS (SELECT s.ticker, volume FROM prices JOIN s ON CAST(prices.ticker AS BIGINT) % {len(dims.SECTORS["All"])} = i)
SELECT ticker, SUM(volume)::BIGINT AS volume, COUNT(*) AS bars FROM p WHERE ticker IN {tuple(dims.SECTORS["Finance"])!r} GROUP BY 1""", "prices"))
def sector_volume(spark, sf):
    """Bars of the finance sector; the stand-ins' tickers are dealt to the listed ones."""
    listed = F.array(*[F.lit(t) for t in dims.SECTORS["All"]])
    place = (F.col("ticker").cast("bigint") % len(dims.SECTORS["All"])).cast("int")
    bars = standins.prices(spark, sf).withColumn("ticker", F.get(listed, place))
    return reports.sector_prices(bars, "Finance").groupBy("ticker").agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("bars"))
