"""Rows per key: first, n-th, top n.

Each is ``row_number`` with a bound on the rank.  Spark applies a small bound
inside every map task before the exchange (WindowGroupLimit), so a key that
holds a third of all rows still sends at most n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

SALTS = 1024
# Columns that hold whole texts: orders compare a digest of them, and only after everything else.
TEXTS = ("content", "full_text", "html", "text")


def _columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def salt(columns: Sequence[str], n: int) -> Column:
    """A number below ``n`` that splits any group, also one of identical rows.

    It depends on the row and on the task that reads it, so copies in one task
    share it, copies in different tasks do not, and a repeated task repeats it.
    """
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(n))


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*_columns(order))
    return df.withColumn(name, F.row_number().over(window))


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key: the first in ``order``.

    By default the order is of all other columns, load time and short ones
    before digests of whole texts.  The survivor depends on the data alone,
    never on which task came first.
    """
    if order:
        return with_rank(df, keys, order, "_rank").filter("_rank = 1").drop("_rank")
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    short, digests = _default_order(df.columns, keys)
    ranked = with_rank(df.withColumns(digests), keys, [*short, *digests], "_rank")
    return ranked.filter("_rank = 1").drop("_rank", *digests)


def _default_order(columns: Sequence[str], keys: Sequence[str]) -> tuple[list[str], dict[str, Column]]:
    """Short columns, load time first, and digests of those that hold whole texts."""
    others = [c for c in columns if c not in keys]
    short = sorted((c for c in others if c not in TEXTS), key=lambda c: c != "fetched_at")
    return short, {f"_digest{i}": F.md5(F.col(c).cast("binary")) for i, c in enumerate(c for c in others if c in TEXTS)}


# Where a row of a folder of Parquet files is.
PLACE = ("_file", "_row")


def placed(stored: DataFrame) -> DataFrame:
    """Rows of Parquet files with the place each has."""
    return stored.withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})


def later_copies(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Places of the ``placed`` rows that ``keep_first`` would leave out: of texts only digests cross the exchange."""
    short, digests = _default_order([c for c in rows.columns if c not in PLACE], keys)
    narrow = rows.select(*keys, *PLACE, *short, *[c.alias(n) for n, c in digests.items()])
    return with_rank(narrow, keys, [*short, *digests, *PLACE], "_rank").filter("_rank > 1").select(*PLACE)


def without_places(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The ``placed`` rows at no such place; few places are broadcast, so no text is exchanged."""
    return rows.join(places, list(PLACE), "left_anti").drop(*PLACE)


def nth_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int
) -> DataFrame:
    return with_rank(df, keys, order, "_rank").filter(F.col("_rank") == n).drop("_rank")


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows per key with their rank.

    A salted round cuts every key to its first ``n`` rows per salt before the
    rows of a key meet: hot keys are split whatever ``n`` is.
    """
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    salted = df.withColumn("_salt", salt(plain, SALTS))
    rounds = with_rank(salted, [*keys, "_salt"], order, rank)
    first = rounds.filter(F.col(rank) <= n).drop("_salt", rank)
    return with_rank(first, keys, order, rank).filter(F.col(rank) <= n)


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def null_key_rejects(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a keyed table cannot hold: a part of the key is NULL."""
    bad = F.lit(False)
    for key in keys:
        bad = bad | F.col(key).isNull()
    return df.filter(bad)
