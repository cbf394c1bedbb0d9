"""Stored tables and document collections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    split: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """A relational table; ``split`` = (column, lower, upper, tasks) reads it in parallel."""
    if split is None:
        return spark.read.jdbc(url, table, properties=properties)
    column, lower, upper, tasks = split
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=tasks, properties=properties,
    )


def bound_query(spark: SparkSession, sql: str, views: dict[str, DataFrame], **args) -> DataFrame:
    """SQL over the given frames with named parameters (``:name``)."""
    return spark.sql(sql, args=args or None, **views)


def all_of(conditions: Sequence[Column | None]) -> Column:
    """Every condition that was given; true when none was."""
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def documents(
    df: DataFrame, columns: Sequence[str], equal: dict | None = None,
    newest_by: Sequence[str] = (), limit: int | None = None,
) -> DataFrame:
    """Documents with the given field values: some of their fields, newest first."""
    found = df.filter(all_of([F.col(k) == v for k, v in (equal or {}).items()]))
    found = found.select(*columns)
    if newest_by:
        first, *rest = newest_by
        found = found.orderBy(F.col(first).desc(), *rest)
    return found if limit is None else found.limit(limit)


def append_pages(pages: Sequence[DataFrame], ordinal: str = "page") -> DataFrame:
    """Results of several requests one after the other, with the number of each."""
    numbered = [p.withColumn(ordinal, F.lit(i)) for i, p in enumerate(pages)]
    return reduce(DataFrame.unionByName, numbered)
