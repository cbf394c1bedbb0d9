"""From wire records to clean rows: drop unusable, type, dedupe on the natural key.

The first two steps look at one row at a time and serve batch and stream
alike; the ``clean_*`` functions add the batch dedupe.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tapewright.dims import MATERIAL_FORM, TAG_DEFAULT
from tapewright.functions import dates, strings
from tapewright.operators.dedupe import keep_first, without_null_keys
from tapewright.schemas import NATURAL_KEY

Order = Sequence[str | Column] | None


def usable_news(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["url", "title"])


def type_news(df: DataFrame) -> DataFrame:
    published = dates.to_ts(F.col("published_at"))
    return df.withColumns({
        "title": F.trim(F.col("title")),
        "published_at": published,
        "date_only": dates.to_day(published),
        "category": strings.or_default(F.col("category"), TAG_DEFAULT),
        "fetched_at": dates.to_ts(F.col("fetched_at")),
    })


def clean_news(df: DataFrame, order: Order = None) -> DataFrame:
    return type_news(keep_first(usable_news(df), NATURAL_KEY["news"], order))


def is_material(form: Column, material_form: str = MATERIAL_FORM) -> Column:
    """True for exactly that form (an amendment is another form); NULL counts as false."""
    return F.coalesce(form == material_form, F.lit(False))


def usable_filings(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["accession_number"])


def type_filings(df: DataFrame, material_form: str = MATERIAL_FORM) -> DataFrame:
    return df.withColumns({
        "filed_at": dates.to_day(F.col("filed_at")),
        "period": dates.to_day(F.col("period")),
        "is_material_event": is_material(F.col("form_type"), material_form),
        "fetched_at": dates.to_ts(F.col("fetched_at")),
    })


def clean_filings(df: DataFrame, order: Order = None, material_form: str = MATERIAL_FORM) -> DataFrame:
    return type_filings(keep_first(usable_filings(df), NATURAL_KEY["filings"], order), material_form)


def type_daily(df: DataFrame) -> DataFrame:
    """Typed day and load time; a day that is none becomes NULL."""
    return df.withColumns({
        "date": dates.to_day(F.col("date")),
        "fetched_at": dates.to_ts(F.col("fetched_at")),
    })


def usable_market(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["value"])


def type_market(df: DataFrame) -> DataFrame:
    return type_daily(df)


def clean_market(df: DataFrame, order: Order = None) -> DataFrame:
    # Typed first: two spellings of one day are the same key.
    return keep_first(without_null_keys(type_market(usable_market(df)), NATURAL_KEY["market"]), NATURAL_KEY["market"], order)


def usable_prices(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["close"])


def type_prices(df: DataFrame) -> DataFrame:
    return type_daily(df)


def clean_prices(df: DataFrame, order: Order = None) -> DataFrame:
    return keep_first(without_null_keys(type_prices(usable_prices(df)), NATURAL_KEY["prices"]), NATURAL_KEY["prices"], order)


def _lacking(df: DataFrame, schema: T.StructType) -> Column:
    """Whether a row has no value of the right type in a column that the schema requires."""
    required = [f for f in schema if not f.nullable]
    return reduce(or_, [
        F.col(f.name).try_cast(f.dataType).isNull() if f.name in df.columns else F.lit(True) for f in required
    ], F.lit(False))


def conform(df: DataFrame, schema: T.StructType, clip: dict[str, int] | None = None) -> DataFrame:
    """Columns and types of a target table, texts in ``clip`` cut to so many characters.

    Rows without a required value are left out: they are ``nonconforming``.
    """

    def column(f: T.StructField) -> Column:
        typed = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        chars = (clip or {}).get(f.name)
        return (typed if chars is None else strings.clip(typed, chars)).alias(f.name)

    return df.filter(~_lacking(df, schema)).select(*[column(f) for f in schema])


def nonconforming(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that ``conform`` leaves out, as they came."""
    return df.filter(_lacking(df, schema))
