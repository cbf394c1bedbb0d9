"""Date-window, as-of, interval and dictionary joins, all as equi-joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapewright.functions import dates, strings
from tapewright.operators.dedupe import top_n_per_key


def date_window_count(
    left: DataFrame,
    right: DataFrame,
    left_day: str,
    right_day: str,
    n_days: int = 7,
    on: Sequence[str] = (),
    by: Sequence[str] | None = None,
    count: str = "news_count",
    gap: str = "min_days_apart",
    weight: str | None = None,
) -> DataFrame:
    """Per left row: how many right rows lie within ``n_days``, and how near the nearest is.

    Days may be dates or timestamps: they are compared by calendar day.  0 and
    NULL where there is none.  ``on`` adds equality keys; ``by`` first
    reduces the left side to distinct rows of those columns.  ``weight`` is the
    number of rows a right row stands for, when it holds counts already.

    The right side is counted per day before anything else, and no pair of a
    left and a right row is ever formed.  Without ``on`` each day's count is
    spread over the 2N+1 days it can reach; that table holds at most one row
    per calendar day, so it is broadcast and the left side needs no exchange.
    With ``on`` the days of each key, at most one row per calendar day, pass
    through a window of 2N+1 days.
    """
    if by is not None:
        left = left.select(*by).distinct()
    rows = F.col(weight) if weight else F.lit(1)
    columns, left = left.columns, left.withColumn("_left_day", F.to_date(left_day))
    right = right.withColumn("_day", F.to_date(right_day)).filter("_day IS NOT NULL").select(
        *on, "_day", rows.cast("bigint").alias("_n")
    )
    if on:
        near = _near_by_key(left, right, "_left_day", n_days, on, count, gap)
    else:
        near = F.broadcast(_near_by_day(right, "_left_day", n_days, count, gap))
    found = F.coalesce(F.col(count), F.lit(0).cast("bigint")).alias(count)
    return left.join(near, [*on, "_left_day"], "left").select(*columns, found, gap)


def _near_by_day(right: DataFrame, day: str, n_days: int, count: str, gap: str) -> DataFrame:
    daily = right.groupBy("_day").agg(F.sum("_n").alias("_n"))
    reach = F.explode(F.sequence(F.date_sub("_day", n_days), F.date_add("_day", n_days)))
    return (
        daily.select("_n", "_day", reach.alias(day))
        .groupBy(day)
        .agg(
            F.sum("_n").alias(count),
            F.min(dates.day_gap(F.col(day), F.col("_day"))).alias(gap),
        )
    )


def _near_by_key(
    left: DataFrame, right: DataFrame, day: str, n_days: int, on: Sequence[str], count: str, gap: str
) -> DataFrame:
    wanted = left.filter(F.col(day).isNotNull()).select(
        *on, F.col(day).alias("_day"), F.lit(None).cast("bigint").alias("_n")
    )
    calendar = right.unionByName(wanted).groupBy(*on, "_day").agg(F.sum("_n").alias("_n"))
    line = Window.partitionBy(*on).orderBy(F.unix_date("_day"))
    seen = F.when(F.col("_n").isNotNull(), F.col("_day"))
    before = F.datediff("_day", F.last(seen, True).over(line.rangeBetween(-n_days, 0)))
    after = F.datediff(F.first(seen, True).over(line.rangeBetween(0, n_days)), "_day")
    return calendar.select(
        *on,
        F.col("_day").alias(day),
        F.sum("_n").over(line.rangeBetween(-n_days, n_days)).alias(count),
        F.least(before, after).alias(gap),
    )


def asof_join(
    left: DataFrame,
    series: DataFrame,
    left_day: str,
    series_day: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    direction: str = "nearest",
    tolerance: int | None = None,
    last_by: Sequence[str] | None = None,
    matched: str = "matched_date",
) -> DataFrame:
    """Add the series values of the observation nearest to each left row's day.

    Days may be dates or timestamps: they are compared by calendar day.  At
    equal distance the earlier one wins.  Of several observations on a day
    the last in ``last_by`` (default: the values) counts.  A NULL value on the
    matched day stays NULL.  ``direction`` may also be backward or forward,
    and ``tolerance`` limits the distance in days.

    Both sides are reduced to one row per key and day, together and in one
    exchange, before the ordered window: no group is longer than the calendar.
    The left rows themselves are only looked up by day.
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    order = list(last_by or values)
    clock = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    columns, left = left.columns, left.withColumn("_left_day", F.to_date(left_day))
    points = series.withColumn("_day", F.to_date(series_day)).filter("_day IS NOT NULL").select(
        *by, "_day", F.lit(1).alias("_known"), F.lit(None).cast("int").alias("_wanted"),
        clock.alias("_clock"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)],
    )
    wanted = left.filter("_left_day IS NOT NULL").select(
        *by, F.col("_left_day").alias("_day"), F.lit(1).alias("_wanted")
    )
    numbered = [f"_v{i}" for i in range(len(values))]
    calendar = (
        points.unionByName(wanted, allowMissingColumns=True)
        .groupBy(*by, "_day")
        .agg(
            F.max("_known").alias("_known"),
            F.max("_wanted").alias("_wanted"),
            *[F.max_by(v, "_clock").alias(v) for v in numbered],
        )
        .withColumn("_point", F.when(F.col("_known") == 1, F.struct(F.col("_day").alias("day"), *numbered)))
    )
    # Both look back along their order: a frame open to the end costs the square of its rows.
    forth, back = (Window.partitionBy(*by).orderBy(o) for o in (F.asc("_day"), F.desc("_day")))
    before, after = (
        F.last("_point", True).over(line.rowsBetween(Window.unboundedPreceding, 0)) for line in (forth, back)
    )
    chosen = {
        "backward": F.col("_before"),
        "forward": F.col("_after"),
        "nearest": F.when(
            F.col("_after").isNull()
            | (F.datediff("_day", F.col("_before.day")) <= F.datediff(F.col("_after.day"), "_day")),
            F.col("_before"),
        ).otherwise(F.col("_after")),
    }[direction]
    found = (
        calendar.withColumns({"_before": before, "_after": after})
        .filter("_wanted = 1")
        .withColumn("_hit", chosen)
    )
    if tolerance is not None:
        near = dates.day_gap(F.col("_day"), F.col("_hit.day")) <= tolerance
        found = found.withColumn("_hit", F.when(near, F.col("_hit")))
    found = found.select(
        *by,
        F.col("_day").alias("_left_day"),
        F.col("_hit.day").alias(matched),
        *[F.col(f"_hit.{n}").alias(v) for n, v in zip(numbered, values)],
    )
    if not by:
        found = F.broadcast(found)  # at most one row per calendar day
    return left.join(found, [*by, "_left_day"], "left").select(*columns, matched, *values)


def interval_tag(
    df: DataFrame,
    day: str,
    bands: Sequence[tuple[str, str, str]],
    label: str = "band",
) -> DataFrame:
    """Label each row with the interval (start, end, label; ends included) its day is in.

    A row inside several intervals appears once for each; outside all of them
    the label is NULL.  The handful of literal intervals needs no join.
    """
    literal = [
        F.struct(
            F.lit(dt.date.fromisoformat(start)).alias("start"),
            F.lit(dt.date.fromisoformat(end)).alias("end"),
            F.lit(name).alias("name"),
        )
        for start, end, name in bands
    ]
    inside = F.filter(F.array(*literal), lambda b: F.col(day).between(b["start"], b["end"]))
    return df.withColumn(label, F.explode_outer(F.transform(inside, lambda b: b["name"])))


# Levels of calendar nodes; a node is as long as eight of the level below.
LEVELS = 11


def _nodes(first: Column, last: Column) -> Column:
    """The fewest nodes that make up the positions from first to last: at each level those beside the next level's."""
    start, end, going, found = first, last + 1, F.lit(True), []

    def run(a: Column, b: Column, level: int) -> Column:
        nodes = F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(level).alias("level"), x.alias("node")))
        return F.when(going & (a < b), nodes).otherwise(F.array().cast("array<struct<level:int,node:bigint>>"))

    for level in range(LEVELS):
        up, down = F.shiftright(start + 7, 3), F.shiftright(end, 3)
        higher = (up < down) if level < LEVELS - 1 else F.lit(False)
        found.append(run(start, F.when(higher, F.shiftleft(up, 3)).otherwise(end), level))
        found.append(F.when(higher, run(F.shiftleft(down, 3), end, level)).otherwise(F.array().cast("array<struct<level:int,node:bigint>>")))
        start, end, going = up, down, going & higher
    return F.concat(*found)


def interval_join(
    df: DataFrame, intervals: DataFrame, at: str, start: str, end: str, labels: Sequence[str], how: str = "left",
) -> DataFrame:
    """Each row with the labels of every interval its day or instant is in, ends included.

    A row in several intervals appears once for each; with ``how="left"`` one in
    none keeps NULLs.  An interval without a start or an end is open there.
    Times are dates or timestamps, on both sides alike.

    An interval is dealt to a few calendar nodes, each eight times as long as
    those of the level below, that make it up exactly: at most 14 per level,
    however long it is.  The distinct times of the rows look for their node at
    each level, so the join is on equality, a row meets an interval once, and no
    pair is looked at that is not a match (to the second).  The rows themselves
    are joined by time last, all rows of a time for one interval after the other;
    those in none are added.
    """
    day = df.schema[at].dataType.typeName() == "date"

    def place(c: Column) -> Column:
        return (F.unix_date(c) if day else F.unix_seconds(c.cast("timestamp"))).cast("bigint")

    ends = ("0001-01-01", "9999-12-31")
    first, last = (F.coalesce(F.col(c), F.lit(e).cast("date" if day else "timestamp")) for c, e in zip((start, end), ends))
    dealt = intervals.select(
        F.col(start).alias("_start"), F.col(end).alias("_end"), F.struct(*labels).alias("_labels"), place(first).alias("_first"), place(last).alias("_last"))
    dealt = dealt.filter("_first <= _last").select("_start", "_end", "_labels", F.inline(_nodes(F.col("_first"), F.col("_last"))))
    times = df.select(F.col(at).alias("_time")).filter("_time IS NOT NULL").distinct()
    nodes = [F.struct(F.lit(i).alias("level"), F.shiftright(place(F.col("_time")), 3 * i).alias("node")) for i in range(LEVELS)]
    met = times.select("_time", F.inline(F.array(*nodes))).join(dealt, ["level", "node"])
    within = F.coalesce(F.col("_time") >= F.col("_start"), F.lit(True)) & F.coalesce(F.col("_time") <= F.col("_end"), F.lit(True))
    found = met.filter(within).select("_time", "_labels")
    # Sorted by time, and each interval streams past the rows of a time: what is written repeats closely and packs well.
    inside = found.join(df.hint("merge"), F.col("_time") == F.col(at)).select(*df.columns, "_labels.*")
    if how == "inner":
        return inside
    outside = df.join(found.select(F.col("_time").alias("_met")).distinct(), F.col(at) == F.col("_met"), "left_anti")
    return inside.unionByName(outside, allowMissingColumns=True)


def interval_totals(
    df: DataFrame, intervals: DataFrame, at: str, start: str, end: str, totals: dict[str, tuple[str, str]], how: str = "inner",
) -> DataFrame:
    """Each row with totals over the intervals its instant is in, ends included; rows in none go, or keep NULLs (``left``).

    ``totals`` names each total: a function (``count``, ``sum``, ``min`` or ``max``) and its column of ``intervals``.
    An interval without a start or an end is open there.

    No pair of a row and an interval is formed.  The seconds that lie whole in an
    interval are dealt to calendar nodes as in ``interval_join`` and added up per
    node, so what meets the rows is at most one row per node, however many
    intervals there are.  Only in the two seconds in which an interval begins and
    ends are times compared, its distinct ends with the distinct times of that second.
    """

    def place(c: Column) -> Column:
        return F.unix_seconds(c).cast("bigint")

    def added(again: bool = False) -> list[Column]:
        # Counts of counts are sums.
        return [getattr(F, "sum" if again and f == "count" else f)(name if again else column).alias(name) for name, (f, column) in totals.items()]

    first, last = (F.coalesce(F.col(c).cast("timestamp"), F.lit(e).cast("timestamp")) for c, e in ((start, "0001-01-01"), (end, "9999-12-31")))
    values = list(dict.fromkeys(c for _, c in totals.values()))
    known = intervals.select(*values, first.alias("_start"), last.alias("_end")).filter("_start <= _end").withColumns(
        {"_first": place(F.col("_start")), "_last": place(F.col("_end"))})
    nodes = known.select(*values, F.inline(_nodes(F.col("_first") + 1, F.col("_last") - 1))).groupBy("level", "node").agg(*added())
    edges = F.array_distinct(F.array("_first", "_last"))
    ends = known.select(*values, "_start", "_end", "_first", "_last", F.explode(edges).alias("_second")).select(
        *values, "_second", F.when(F.col("_first") == F.col("_second"), F.col("_start")).alias("_from"),
        F.when(F.col("_last") == F.col("_second"), F.col("_end")).alias("_to")).groupBy("_second", "_from", "_to").agg(*added())
    times = df.select(F.col(at).cast("timestamp").alias("_time")).filter("_time IS NOT NULL").distinct().withColumn("_second", place(F.col("_time")))
    levels = F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright("_second", 3 * i).alias("node")) for i in range(LEVELS)])
    seconds = times.select("_second").distinct().select("_second", F.inline(levels))
    whole = seconds.join(nodes, ["level", "node"]).groupBy("_second").agg(*added(True))
    within = F.coalesce(F.col("_time") >= F.col("_from"), F.lit(True)) & F.coalesce(F.col("_time") <= F.col("_to"), F.lit(True))
    parts = times.join(ends, "_second").filter(within).unionByName(times.join(whole, "_second"), allowMissingColumns=True)
    found = parts.groupBy("_time").agg(*added(True))
    return df.join(found, F.col(at).cast("timestamp") == F.col("_time"), how).select(*df.columns, *totals)


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, how: str = "inner") -> DataFrame:
    """Join a dictionary on its key without regard to case.

    The dictionary has one row per key.  Spark broadcasts it when it is small
    enough and otherwise splits hot keys of ``df`` at run time.
    """
    right = dim.withColumn("_key", F.upper(F.col(dim_key or key))).drop(dim_key or key)
    return (
        df.withColumn("_key", F.upper(F.col(key))).join(right, "_key", how).drop("_key")
    )


def padded_lookup(df: DataFrame, companies: DataFrame, key: str, company_key: str, number: str, width: int = 10) -> DataFrame:
    """Company number of each row, padded with zeros; rows without one are left out."""
    dim = companies.select(company_key, strings.zero_pad(F.col(number), width).alias("cik"))
    return lookup(df, dim, key, company_key)


def name_lookup(df: DataFrame, dim: DataFrame, code: str, name: str) -> DataFrame:
    """Add the name of each code; a code without a name is its own name."""
    joined = df.join(dim.select(code, name), code, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.col(code)))


def member_filter(
    df: DataFrame, groups: DataFrame, key: str, group_key: str, group: str, wanted: str,
    picked: Sequence[str] = (),
) -> DataFrame:
    """Rows whose key belongs to the wanted group, or to the picked members of it.

    Nothing picked means the whole group.
    """
    pool = groups.filter(F.col(group) == wanted).select(F.col(group_key).alias(key))
    if picked:
        pool = pool.filter(F.col(key).isin(list(picked)))
    return df.join(pool, key, "left_semi")


def first_members(groups: DataFrame, group: str, ordinal: str, k: int = 5) -> DataFrame:
    """The first ``k`` members of each group, the default pick of a list."""
    return top_n_per_key(groups, [group], [ordinal], k, "_rank").drop("_rank")
