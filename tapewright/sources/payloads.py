"""Nested feed payloads, one JSON text per row, flattened to wire records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tapewright import schemas
from tapewright.dims import FORM_TYPES, MATERIAL_FORM, TAG_RULES_V2
from tapewright.functions import dates, strings
from tapewright.functions.text import tag_by_rules
from tapewright.operators.clean import is_material
from tapewright.operators.dedupe import keep_first, top_n_per_key
from tapewright.operators.joins import name_lookup

MISSING = "."


def load_stamp(run_ts: dt.datetime | None = None) -> Column:
    return F.lit(run_ts) if run_ts else F.current_timestamp()


def _parsed(df: DataFrame, payload: str, schema: T.DataType) -> DataFrame:
    return df.withColumn(payload, F.from_json(payload, schema))


def articles(
    df: DataFrame, payload: str, query: str, run_ts: dt.datetime | None = None,
    rules: Sequence[tuple[str, Sequence[str]]] = TAG_RULES_V2, carry: Sequence[str] = (),
) -> DataFrame:
    """News records of article pages; the category is tagged from the title.

    ``carry`` names columns of the page to keep; ``pos`` is the place on it.
    """
    a = F.col("_a")
    return (
        _parsed(df, payload, schemas.ARTICLES_PAYLOAD)
        .select(query, *carry, F.posexplode(f"{payload}.articles").alias("pos", "_a"))
        .select(
            a["source"]["name"].alias("source_name"),
            a["title"].alias("title"),
            a["description"].alias("description"),
            a["url"].alias("url"),
            a["publishedAt"].alias("published_at"),
            a["content"].alias("content"),
            F.col(query).alias("search_query"),
            tag_by_rules(a["title"], rules).alias("category"),
            load_stamp(run_ts).alias("fetched_at"),
            *carry,
            "pos",
        )
        .filter(~strings.is_blank(F.col("url")))
    )


def first_seen(found: DataFrame, phrases: DataFrame, order: Sequence[str] = ("pos",)) -> DataFrame:
    """One record per url: the first in order of the search phrases, then of ``order``."""
    ranked = found.join(phrases, "search_query")
    return keep_first(ranked, ["url"], ["ordinal", *order]).drop("ordinal", *order)


def filing_rows(
    pages: DataFrame, arrays: str, entity: str, forms: Sequence[str] = tuple(FORM_TYPES),
    limit: int | None = None, material_form: str = MATERIAL_FORM, run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Filing records of pages of parallel arrays (columns: entity, cik, company_name, page).

    Positions an array is too short for, or missing for, are NULL.  ``limit`` keeps the first
    filings of each entity in page and position order.
    """
    names = schemas.FILING_ARRAYS.fieldNames()
    present = [F.coalesce(F.col(f"{arrays}.{n}"), F.array().cast("array<string>")).alias(n) for n in names]
    zipped = F.arrays_zip(*present)
    rows = (
        pages.select(entity, "cik", "company_name", "page", F.posexplode(zipped).alias("pos", "_f"))
        .filter(F.col("_f.form").isin(list(forms)))
        .select(
            entity, "company_name", "cik",
            F.col("_f.form").alias("form_type"),
            F.col("_f.filingDate").alias("filed_at"),
            F.col("_f.reportDate").alias("period"),
            F.col("_f.accessionNumber").alias("accession_number"),
            strings.archive_url(
                F.col("cik"), F.col("_f.accessionNumber"), F.col("_f.primaryDocument")
            ).alias("document_url"),
            load_stamp(run_ts).alias("fetched_at"),
            "page", "pos",
        )
        .withColumn("is_material_event", is_material(F.col("form_type"), material_form))
    )
    if limit is not None:
        rows = top_n_per_key(rows, [entity], ["page", "pos"], limit, "_rank").drop("_rank")
    return rows


def filing_pages(df: DataFrame, payload: str, entity: str, older: DataFrame | None = None) -> DataFrame:
    """Pages of arrays per entity: page 0 is in the payload, older pages join by file name.

    ``older`` has the columns ``name`` and ``arrays`` (JSON text).
    """
    parsed = _parsed(df, payload, schemas.FILING_PAYLOAD)
    company = F.col(f"{payload}.name").alias("company_name")
    recent = parsed.select(
        entity, "cik", company, F.lit(0).alias("page"), F.col(f"{payload}.filings.recent").alias("arrays")
    )
    if older is None:
        return recent
    listed = parsed.select(
        entity, "cik", company, F.posexplode(f"{payload}.filings.files").alias("page", "_file")
    ).select(entity, "cik", "company_name", (F.col("page") + 1).alias("page"), F.col("_file.name").alias("name"))
    files = _parsed(older, "arrays", schemas.FILING_ARRAYS)
    return recent.unionByName(listed.join(files, "name").drop("name"))


def observations(
    df: DataFrame, payload: str, code: str, names: DataFrame | None = None,
    start: dt.date | None = None, run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Macro points; missing ones are dropped, a series without a name is named by its code."""
    o = F.col("_o")
    points = (
        _parsed(df, payload, schemas.OBSERVATIONS_PAYLOAD)
        .select(F.col(code).alias("series_code"), F.explode(f"{payload}.observations").alias("_o"))
        .filter(o["value"] != MISSING)
        .select(
            "series_code",
            o["date"].alias("date"),
            o["value"].try_cast("double").alias("value"),
            load_stamp(run_ts).alias("fetched_at"),
        )
    )
    if start is not None:
        points = points.filter(dates.to_day(F.col("date")) >= F.lit(start))
    if names is None:
        return points.withColumn("series_name", F.col("series_code"))
    return name_lookup(points, names, "series_code", "series_name")


def price_bars(df: DataFrame, payload: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """Bars of a map from ticker to bar list; the day is the first ten characters of the time."""
    b = F.col("_b")
    return (
        _parsed(df, payload, schemas.BARS_PAYLOAD)
        .select(F.explode(f"{payload}.bars").alias("ticker", "_bars"))
        .select("ticker", F.explode("_bars").alias("_b"))
        .select(
            "ticker",
            F.substring(b["t"], 1, 10).alias("date"),
            b["o"].alias("open"), b["h"].alias("high"), b["l"].alias("low"), b["c"].alias("close"),
            b["v"].alias("volume"), b["vw"].alias("vwap"),
            load_stamp(run_ts).alias("fetched_at"),
        )
    )


def company_numbers(df: DataFrame, payload: str) -> DataFrame:
    """(ticker, cik) of a company dictionary, upper case and padded."""
    e = F.col("_e")
    return (
        _parsed(df, payload, schemas.COMPANY_DICTIONARY)
        .select(F.explode(F.map_values(payload)).alias("_e"))
        .select(F.upper(e["ticker"]).alias("ticker"), strings.zero_pad(e["cik_str"]).alias("cik"))
    )
