"""Event-time windows and the join of two streams, with state that Spark keeps and clears by watermarks.

A row may come as late as ``delay`` behind the newest time seen; a later one
is not counted.  A window says its last word when the watermark has passed it.
A quiet feed is moved on by heartbeats: rows that carry a time and no key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Groups into which the rows of a day are dealt, so that no day's state is in one task.
SALTS = 16


def heartbeat(like: DataFrame, time: str, at: str) -> DataFrame:
    """One row of a feed that only moves its clock: ``time``, all else NULL."""
    return like.sparkSession.range(1).select(*[
        (F.lit(at).cast(f.dataType) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name) for f in like.schema])


def _clocked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    return stream.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", delay)


def _beyond_the_clock(rows: DataFrame, key: str) -> DataFrame:
    """Without heartbeats.  The condition names the time, or Spark would apply it before it reads the clock."""
    return rows.filter(F.when(F.col("_at").isNotNull(), F.col(key)).isNotNull())


def day_counts(stream: DataFrame, time: str, key: str, delay: str) -> DataFrame:
    """``day, n`` of every day the watermark has passed; rows are added up inside the map tasks."""
    days = _clocked(stream, time, delay).groupBy(F.window("_at", "1 day")).agg(F.count(key).alias("n"))
    return days.select(F.col("window.start").cast("date").alias("day"), "n", F.window_time("window").alias("_day_at"))


def near_days(
    filings: DataFrame, news: DataFrame, filed_at: str, published_at: str, key: str, news_key: str,
    n_days: int = 7, delay: str = "30 days",
) -> DataFrame:
    """``key, day, n, days_apart``: for every filing the days within ``n_days`` of it that have news.

    Both sides are streams and both are kept as state: a filing waits on each
    of its 2N+1 days, a day with the number of its news.  They meet when their
    day is equal, whichever came first, also in a later run.  The range of
    times beside that equality lets Spark drop state the watermarks have passed.
    No pair of a filing and an article is formed.  Days are salted, since all
    filings of a fortnight meet under the same day.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    days = day_counts(news, published_at, news_key, delay).filter("n > 0").withColumn("_salt", salts)
    day = F.col("_at").cast("date")
    waiting = _beyond_the_clock(_clocked(filings, filed_at, delay), key).select(
        key, F.col("_at").alias("_filed"), day.alias("_filed_day"), F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int").alias("_its_salt"),
        F.explode(F.sequence(F.date_sub(day, n_days), F.date_add(day, n_days))).alias("_near"))
    reach = F.expr(f"INTERVAL {n_days + 2} DAYS")
    met = waiting.join(days, (
        (F.col("_near") == F.col("day")) & (F.col("_its_salt") == F.col("_salt"))
        & (F.col("_day_at") >= F.col("_filed") - reach) & (F.col("_day_at") <= F.col("_filed") + reach)))
    return met.select(key, "day", "n", F.abs(F.datediff("day", "_filed_day")).alias("days_apart"))


def coverage(filings: DataFrame, met: DataFrame, key: str, count: str = "news_count", gap: str = "min_days_apart") -> DataFrame:
    """The stored filings with what ``near_days`` has found so far; 0 and NULL where that is nothing.

    A filing or a batch that came twice counts once.
    """
    found = met.dropDuplicates([key, "day"]).groupBy(key).agg(F.sum("n").alias(count), F.min("days_apart").alias(gap))
    return filings.join(found, key, "left").withColumn(count, F.coalesce(count, F.lit(0).cast("bigint")))


def near_filed_days(
    filings: DataFrame, news: DataFrame, filed_at: str, published_at: str, key: str, news_key: str,
    n_days: int = 7, delay: str = "30 days",
) -> DataFrame:
    """``filed_day, day, n, days_apart``: for every day with filings the days within ``n_days`` of it that have news.

    As ``near_days``, but what waits is the day of the filings, not each of them:
    both sides are added up by day inside the map tasks before they are state, so
    the state is 2N+1 rows per calendar day however many filings there are.
    ``day_coverage`` gives the stored filings what their day has found.
    """
    days = day_counts(news, published_at, news_key, delay).filter("n > 0")
    near = F.explode(F.sequence(F.date_sub("day", n_days), F.date_add("day", n_days)))
    waiting = day_counts(filings, filed_at, key, delay).filter("n > 0").select(
        F.col("day").alias("filed_day"), F.col("_day_at").alias("_filed"), near.alias("_near"))
    reach = F.expr(f"INTERVAL {n_days + 2} DAYS")
    met = waiting.join(days, (
        (F.col("_near") == F.col("day")) & (F.col("_day_at") >= F.col("_filed") - reach) & (F.col("_day_at") <= F.col("_filed") + reach)))
    return met.select("filed_day", "day", "n", F.abs(F.datediff("day", "filed_day")).alias("days_apart"))


def day_coverage(filings: DataFrame, met: DataFrame, filed_at: str, count: str = "news_count", gap: str = "min_days_apart") -> DataFrame:
    """The stored filings with what ``near_filed_days`` has found so far for their day; 0 and NULL where that is nothing.

    At most one row per calendar day is broadcast.  A filing that came behind
    the watermark has what its day has, if others of that day came in time.
    """
    found = met.dropDuplicates(["filed_day", "day"]).groupBy("filed_day").agg(F.sum("n").alias(count), F.min("days_apart").alias(gap))
    covered = filings.withColumn("filed_day", F.to_date(filed_at)).join(F.broadcast(found), "filed_day", "left")
    return covered.select(*filings.columns, F.coalesce(count, F.lit(0).cast("bigint")).alias(count), gap)


def bursts(stream: DataFrame, time: str, by: str, at_least: int, days: int = 7, delay: str = "30 days") -> DataFrame:
    """``by, day, n``: the days on which a ticker reaches ``at_least`` rows in the ``days`` up to that day.

    One alert for each time it gets there: on the day before, its ``days`` had
    fewer.  Both counts come from one sliding window of a day more, less its
    first or its last day, so a window's state says everything, is added up
    inside the map tasks, and speaks once, when the watermark has passed it.
    """
    day = F.col("_at").cast("date")
    spans = _beyond_the_clock(_clocked(stream, time, delay), by).withColumn("_day", day).groupBy(
        F.window("_at", f"{days + 1} days", "1 day"), by).agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("_day") == F.col("window.start").cast("date")).alias("_first"),
        F.count_if(F.col("_day") == F.date_sub(F.col("window.end").cast("date"), 1)).alias("_last"))
    now, before = F.col("_all") - F.col("_first"), F.col("_all") - F.col("_last")
    return spans.filter((now >= at_least) & (before < at_least)).select(
        by, F.date_sub(F.col("window.end").cast("date"), 1).alias("day"), now.alias("n"))


def weeks(stream: DataFrame, time: str, by: str, delay: str = "30 days") -> DataFrame:
    """``week_start, by, n`` of every week (from Monday) that the watermark has passed."""
    # The epoch was a Thursday.
    seen = _beyond_the_clock(_clocked(stream, time, delay), by)
    spans = seen.groupBy(F.window("_at", "7 days", "7 days", "4 days"), by).agg(F.count(F.lit(1)).alias("n"))
    return spans.select(F.col("window.start").cast("date").alias("week_start"), by, "n")
