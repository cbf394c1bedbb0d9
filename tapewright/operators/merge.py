"""Keyed merges: what a table holds after a batch.

Rows with a NULL key belong in ``dedupe.null_key_rejects``.  Batches are
reduced to one row per key first, so both join sides have unique keys and the
exchange on the key is even.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tapewright.functions import strings
from tapewright.operators.dedupe import keep_first, without_null_keys

Order = Sequence[str | Column] | None


def _batch(batch: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    return keep_first(without_null_keys(batch, keys), keys, order)


def new_rows(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Order = None) -> DataFrame:
    """Rows of the batch whose key is not stored yet: all that insert-if-absent appends.

    Of the stored table only the key columns are read, and first cut down to
    the keys of the batch: a small batch is broadcast to it, and the large
    table is never exchanged.
    """
    fresh = _batch(batch, keys, order)
    known = stored.select(*keys).join(fresh.select(*keys), list(keys), "left_semi")
    return fresh.join(known, list(keys), "left_anti")


def insert_if_absent(stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Order = None) -> DataFrame:
    return stored.unionByName(new_rows(stored, batch, keys, order).select(*stored.columns))


def upsert(
    stored: DataFrame, batch: DataFrame, keys: Sequence[str], order: Order = None,
    keep: Sequence[str] = (), keep_if_blank: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys and overwrite known ones.

    For a known key the columns in ``keep`` stay as stored, and those in
    ``keep_if_blank`` stay when the new text is empty (a blank insert stores
    the empty text).  Every other column takes the new value, a NULL included.
    """
    old = stored.withColumn("_old", F.lit(True)).alias("o")
    new = _batch(batch, keys, order).withColumn("_new", F.lit(True)).alias("n")
    both = old.join(new, list(keys), "full")

    def merged(c: str) -> Column:
        if c in keys:
            return F.col(c)
        was, now = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c in keep:
            return F.when(F.col("_old"), was).otherwise(now)
        if c in keep_if_blank:
            filled = F.when(strings.is_blank(now), strings.or_default(was, "")).otherwise(now)
            return F.when(F.col("_new"), filled).otherwise(was)
        return F.when(F.col("_new"), now).otherwise(was)

    return both.select(*[merged(c).alias(c) for c in stored.columns])


def upsert_prices(stored: DataFrame, batch: DataFrame, order: Order = None) -> DataFrame:
    """A new bar replaces everything but the stored open."""
    return upsert(stored, batch, ["ticker", "date"], order, keep=["open"])


def with_content_fields(articles: DataFrame, content: str = "content") -> DataFrame:
    return articles.withColumns({
        "content_length": F.length(strings.or_default(F.col(content), "")),
        "has_full_content": ~strings.is_blank(F.col(content)),
    })


def upsert_articles(stored: DataFrame, batch: DataFrame, key: str = "url", order: Order = None) -> DataFrame:
    """Articles with a key, stored with their content length and whether there is content."""
    usable = batch.filter(~strings.is_blank(F.col(key)))
    return upsert(stored, with_content_fields(usable), [key], order)


def upsert_filing_texts(
    stored: DataFrame, batch: DataFrame, key: str = "accession_number", text: str = "full_text",
    order: Order = None,
) -> DataFrame:
    """A filing without new text keeps the text it has."""
    usable = batch.filter(~strings.is_blank(F.col(key).cast("string")))
    return upsert(stored, usable, [key], order, keep_if_blank=[text])


def reset_where(df: DataFrame, condition: Column, column: str, value="") -> DataFrame:
    """Set one column wherever the condition holds."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column)))
