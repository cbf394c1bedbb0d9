"""Pearson correlation matrices of many series.

Values stay in long rows: no plan has a column or an expression per series.
Members are dealt into blocks; for each pair of blocks and slice of dates a
task lays the values out as two matrices and adds up their products.  Nothing
is ever emitted per pair and date.  The sums are doubles, so the last digits of
a correlation depend on how dates were dealt to slices.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapewright.dims import literal_frame
from tapewright.operators import series

# Members per block, and slices of dates.
BLOCK, SLICES = 64, 16
SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")


def _sums(k: int):
    """Pair sums of two blocks of members over the dates on which both have a value."""

    def matrix(days: np.ndarray, count: int, members: np.ndarray, values: np.ndarray, block: int) -> np.ndarray:
        width = min(BLOCK, k - block * BLOCK)
        out = np.full((count, width), np.nan)
        mine = members // BLOCK == block
        out[days[mine], members[mine] - block * BLOCK] = values[mine]
        return out

    def per_group(rows: pa.Table) -> pa.Table:
        first, second = rows.column("_bi")[0].as_py(), rows.column("_bj")[0].as_py()
        members, values = rows.column("_m").to_numpy(), rows.column("_v").to_numpy()
        dates, days = np.unique(rows.column("_i").to_numpy(zero_copy_only=False), return_inverse=True)
        x, y = (matrix(days, len(dates), members, values, b) for b in (first, second))
        here, there = ~np.isnan(x), ~np.isnan(y)
        x, y, here, there = np.where(here, x, 0), np.where(there, y, 0), here.astype(float), there.astype(float)
        found = {
            "n": here.T @ there, "sa": x.T @ there, "sb": here.T @ y,
            "saa": (x * x).T @ there, "sbb": here.T @ (y * y), "sab": x.T @ y,
        }
        a, b = (g.ravel() for g in np.meshgrid(first * BLOCK + np.arange(x.shape[1]), second * BLOCK + np.arange(y.shape[1]), indexing="ij"))
        keep = (a < b) & (found["n"].ravel() > 0)
        columns = {"a": a[keep], "b": b[keep]} | {c: v.ravel()[keep] for c, v in found.items()}
        columns["n"] = columns["n"].astype("int64")
        return pa.table(columns)

    return per_group


def pairwise(rows: DataFrame, index: str, member: str, value: str, names: Sequence[str]) -> DataFrame:
    """(a, b, n, corr) for every pair of members, over the index values at which both have a value.

    ``member`` holds the places of the members in ``names``; a member has at
    most one row per index value.  NULL for a constant series or fewer than two
    common values.
    """
    k = len(names)
    if k < 2:
        raise ValueError("a correlation needs two series")
    block, other = F.floor(F.col("_m") / BLOCK), F.col("_other")
    long = rows.filter(F.col(value).isNotNull()).select(
        F.col(member).cast("bigint").alias("_m"), F.col(value).cast("double").alias("_v"),
        F.col(index).cast("string").alias("_i"))
    dealt = long.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((k - 1) // BLOCK).cast("bigint")))).select(
        "_m", "_v", "_i", F.least(block, other).alias("_bi"), F.greatest(block, other).alias("_bj"),
        F.pmod(F.xxhash64("_i"), F.lit(SLICES)).alias("_slice"))
    sums = dealt.groupBy("_bi", "_bj", "_slice").applyInArrow(
        _sums(k), "a bigint, b bigint, n bigint, sa double, sb double, saa double, sbb double, sab double"
    ).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in SUMS])
    spark = rows.sparkSession
    pairs = spark.range(k - 1).select(
        F.col("id").alias("a"), F.explode(F.sequence(F.col("id") + 1, F.lit(k - 1).cast("bigint"))).alias("b"))
    n = F.col("n")
    # Rounding leaves a constant series a spread of almost, not exactly, 0.
    spread_a = n * F.col("saa") - F.col("sa") ** 2
    spread_b = n * F.col("sbb") - F.col("sb") ** 2
    varies = (spread_a > n * F.col("saa") * 1e-12) & (spread_b > n * F.col("sbb") * 1e-12)
    top = n * F.col("sab") - F.col("sa") * F.col("sb")
    corr = top / F.sqrt(spread_a) / F.sqrt(spread_b)
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr))
    shown = [literal_frame(spark, list(enumerate(names)), side, f"_{side}") for side in ("a", "b")]
    return pairs.join(sums, ["a", "b"], "left").join(shown[0], "a").join(shown[1], "b").select(
        F.col("_a").alias("a"), F.col("_b").alias("b"), F.coalesce(n, F.lit(0)).alias("n"),
        F.when((n > 1) & varies, bounded).alias("corr"))


def _numbered(df: DataFrame, key: str, day: str, value: str, members: Sequence[str]) -> DataFrame:
    """The rows of the members, each by its place among them."""
    places = literal_frame(df.sparkSession, list(enumerate(members)), "_m", "_key")
    return df.select(F.col(key).alias("_key"), day, value).join(places, "_key").drop("_key")


def _centred(df: DataFrame, value: str) -> DataFrame:
    """Values less their member's mean: same correlations, no cancellation in the sums."""
    mean = F.avg(value).over(Window.partitionBy("_m"))
    return df.withColumn(value, F.col(value) - mean)


def _on_days_with(df: DataFrame, day: str, value: str, at_least: int) -> DataFrame:
    """Rows of the days on which at least so many members have a value."""
    there = F.count(value).over(Window.partitionBy(day))
    return df.withColumn("_there", there).filter(F.col("_there") >= at_least).drop("_there")


def return_corr(
    df: DataFrame, key: str, day: str, value: str, members: Sequence[str], exact: str | None = None
) -> DataFrame:
    """Correlation of daily returns over the dates on which every member has one.

    A missing day carries the last value forward (a return of 0).
    """
    daily = series.one_per_day(_numbered(df, key, day, value, members), ["_m"], day, value, exact)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(len(members) - 1).cast("bigint"))).alias("_m")
    # A row for every day and member, with a NULL where there is no value.
    grid = daily.select(day).distinct().select(day, every).join(daily, [day, "_m"], "left")
    returns = series.pct_change(grid, ["_m"], day, value, "_return")
    complete = _on_days_with(_centred(returns, "_return"), day, "_return", len(members))
    return pairwise(complete, day, "_m", "_return", members)


def monthly_corr(
    df: DataFrame, key: str, day: str, value: str, members: Sequence[str], at_least: int = 3,
    exact: str | None = None,
) -> DataFrame:
    """Correlation of month-end values, over months in which enough series have one.

    Each pair uses the months both have.
    """
    daily = series.one_per_day(_numbered(df, key, day, value, members), ["_m"], day, value, exact)
    monthly = series.month_end(daily, ["_m"], day, value)
    kept = _on_days_with(_centred(monthly, value), "month_end", value, at_least)
    return pairwise(kept, "month_end", "_m", value, members)
