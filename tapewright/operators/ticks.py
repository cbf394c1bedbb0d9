"""Lines of rows finer than a day: as-of join, rolling mean and change where one key's line spans many tasks.

Rows are dealt to tasks by ranges of key and time, so a key with a third of all
rows is cut into many ranges.  Ordered windows run inside a range; what a range
needs from those before it (the last known point, the last few rows) is worked
out from one row per key and range and carried on.  Only keys that span ranges
carry anything: at most two rows per range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewright.functions import numbers
from tapewright.session import shared_folder

_RANGE = "_range"


def _cut(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows in ranges of key and order.  Stored, so that every reader sees the same ranges."""
    path = shared_folder(rows.sparkSession, "line")
    ranged = rows.repartitionByRange(*by, *order).withColumn(_RANGE, F.spark_partition_id())
    ranged.write.parquet(path)
    return rows.sparkSession.read.schema(ranged.schema).parquet(path)


def _of_key(by: Sequence[str]):
    return Window.partitionBy(*(by or [F.lit(0)]))


def _carried(ranged: DataFrame, by: Sequence[str], value: Column, at: Column, forth: bool = True) -> DataFrame:
    """``_carried``: per range and key the last value (the first, looking back) of the ranges before it (after it).

    Keys within one range are left out: what is left is two rows per range at most, and is broadcast.
    """
    best = F.max_by if forth else F.min_by
    known = ranged.groupBy(_RANGE, *by).agg(best(value, F.when(value.isNotNull(), at)).alias("_own"))
    line = _of_key(by).orderBy(F.asc(_RANGE) if forth else F.desc(_RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    found = known.withColumns({"_carried": F.last("_own", True).over(line), "_ranges": F.count(F.lit(1)).over(_of_key(by))})
    return F.broadcast(found.filter("_ranges > 1").select(_RANGE, *by, "_carried"))


def _usable(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def asof_join(
    left: DataFrame, points: DataFrame, left_at: str, points_at: str, values: Sequence[str], by: Sequence[str] = (),
    direction: str = "backward", tolerance: float | None = None, last_by: Sequence[str] | None = None, matched: str = "matched_at",
) -> DataFrame:
    """Add the values of the point nearest in time to each left row, to the microsecond.

    ``direction`` is backward, forward or nearest; a point at the row's own
    instant counts in all of them, and at equal distance the earlier one wins.
    Of several points at an instant the last in ``last_by`` (default: the
    values) counts.  ``tolerance`` limits the distance in seconds.  Rows
    without a time or key stay, with NULLs.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction!r}")
    clock = F.struct(*(last_by or values))
    numbered = [f"_v{i}" for i in range(len(values))]
    # Without a NULL key or time.  One row per key and instant, added up inside the map tasks.
    known = points.filter(_usable(points, [*by, points_at])).groupBy(*by, F.unix_micros(F.col(points_at).cast("timestamp")).alias("_at")).agg(
        F.max_by(F.struct(*[F.col(v).alias(n) for v, n in zip(values, numbered)]), clock).alias("_values"))
    point = F.struct("_at", "_values")
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    usable = _usable(left, [*by, left_at])
    wanted = left.filter(usable).select(*by, F.unix_micros(F.col(left_at).cast("timestamp")).alias("_at"), F.lit(1).alias("_kind"), row.alias("_row"))
    both = known.select(*by, "_at", F.lit(0).alias("_kind"), point.alias("_point")).unionByName(wanted, allowMissingColumns=True)
    ranged = _cut(both, by, ["_at"])

    def seen(forth: bool) -> Column:
        # Points come before rows of their instant, whichever way the line is read.
        line = Window.partitionBy(_RANGE, *by).orderBy(F.asc("_at") if forth else F.desc("_at"), "_kind")
        return F.last("_point", True).over(line.rowsBetween(Window.unboundedPreceding, 0))

    found = ranged
    for name, forth in (("_before", True), ("_after", False)):
        if direction in ("nearest", "backward" if forth else "forward"):
            carried = _carried(ranged, by, F.col("_point"), F.col("_at"), forth)
            found = found.withColumn(name, seen(forth)).join(carried, [_RANGE, *by], "left")
            found = found.withColumn(name, F.coalesce(name, "_carried")).drop("_carried")
    hit = {
        "backward": lambda: F.col("_before"),
        "forward": lambda: F.col("_after"),
        "nearest": lambda: F.when(
            F.col("_after").isNull() | (F.col("_at") - F.col("_before._at") <= F.col("_after._at") - F.col("_at")), F.col("_before")
        ).otherwise(F.col("_after")),
    }[direction]()
    found = found.filter("_kind = 1").withColumn("_hit", hit)
    if tolerance is not None:
        near = F.abs(F.col("_hit._at") - F.col("_at")) <= int(tolerance * 1_000_000)
        found = found.withColumn("_hit", F.when(near, F.col("_hit")))
    found = found.select("_row.*", F.timestamp_micros("_hit._at").alias(matched), *[F.col(f"_hit._values.{n}").alias(v) for n, v in zip(numbered, values)])
    return found.unionByName(left.filter(~usable), allowMissingColumns=True)


def rolling_mean(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, width: int, name: str = "rolling_mean", exact: str | None = None,
) -> DataFrame:
    """Mean of the last ``width`` rows of a key; NULL before that many, or with a NULL among them.

    A range also gets the ``width - 1`` rows before it, however many ranges those lie in.
    ``order`` must tell the rows of a key apart.
    """
    if width < 1:
        raise ValueError("a mean needs a row")
    ranged = _cut(df, by, order)
    line = Window.partitionBy(_RANGE, *by).orderBy(*order)
    sizes = ranged.groupBy(_RANGE, *by).agg(F.count(F.lit(1)).alias("_n"))
    upto = _of_key(by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    edges = sizes.withColumns({"_start": F.coalesce(F.sum("_n").over(upto), F.lit(0).cast("bigint")), "_ranges": F.count(F.lit(1)).over(_of_key(by))})
    edges = edges.filter("_ranges > 1").select(_RANGE, *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_n", "_start")
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    own = ranged.withColumn("_place", F.row_number().over(line)).join(
        F.broadcast(edges.withColumnRenamed(_RANGE, "_own")), reduce(and_, same, F.col(_RANGE) == F.col("_own")))
    tails = own.filter(F.col("_place") > F.col("_n") - (width - 1)).withColumn("_place", F.col("_start") + F.col("_place"))
    tails = tails.drop("_own", "_n", "_start", _RANGE, *[f"_by{i}" for i in range(len(by))])
    # Places count from 1 over all ranges of the key; a range begins after its start.
    needed = (F.col("_place") <= F.col("_start")) & (F.col("_place") > F.col("_start") - (width - 1))
    ahead = tails.join(F.broadcast(edges), reduce(and_, same, needed)).select(*ranged.columns, F.lit(True).alias("_ahead"))
    rows = ranged.withColumn("_ahead", F.lit(False)).unionByName(ahead)
    frame = line.rowsBetween(-(width - 1), 0)
    total = F.sum(F.col(value).cast(exact) if exact else F.col(value)).over(frame).cast("double")
    mean = F.when(F.count(value).over(frame) == width, total / width)
    return rows.withColumn(name, mean).filter("NOT _ahead").drop("_ahead", _RANGE)


def pct_change(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str = "pct_change") -> DataFrame:
    """Change in percent of the row before; the last known value is carried over NULLs first, across ranges too.

    The first known value of a key and a value of 0 before give NULL.  ``order`` must tell the rows of a key apart,
    and no key is NULL.
    """
    ranged = _cut(df, by, order)
    carried = _carried(ranged, by, F.col(value), F.struct(*order))
    line = Window.partitionBy(_RANGE, *by).orderBy(*order)
    so_far = F.last(value, True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(value, True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranged.withColumns({"_now": so_far, "_then": before}).join(carried, [_RANGE, *by], "left")
    change = numbers.pct_change(F.coalesce("_now", "_carried"), F.coalesce("_then", "_carried"))
    return rows.withColumn(name, change).select(*df.columns, name)
