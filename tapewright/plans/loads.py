"""One run of each feed: messages decoded, screened, cleaned, and merged into its tables.

Every run may be repeated: the tables are the same afterwards.  The feeds do
not depend on each other.  A run returns what became of its messages and keeps
those it could not use, with the reason, as a table of rejects.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tapewright import schemas, sinks
from tapewright.operators import clean, dedupe, merge, summary
from tapewright.schemas import NATURAL_KEY
from tapewright.session import shared_folder
from tapewright.sinks import store

# Parts of a table whose key says nothing about time.  The number stays the same for the life of a table.
PARTS = 32


@dataclasses.dataclass(frozen=True)
class Feed:
    """Wire record, fields without which a record is no use, typed columns, target table, and the part of a key."""

    wire: T.StructType
    needs: tuple[str, ...]
    typed: Callable[[DataFrame], DataFrame]
    table: T.StructType
    part: str


MONTH = "date_format(date, 'yyyy-MM')"
FEEDS = {
    "news": Feed(schemas.NEWS_WIRE, ("url", "title"), clean.type_news, schemas.NEWS_TABLE, f"pmod(xxhash64(url), {PARTS})"),
    "filings": Feed(
        schemas.FILING_WIRE, ("accession_number",), clean.type_filings, schemas.FILING_TABLE,
        f"pmod(xxhash64(accession_number), {PARTS})"),
    "market": Feed(schemas.MARKET_WIRE, ("value",), clean.type_market, schemas.MARKET_TABLE, MONTH),
    "prices": Feed(schemas.PRICE_WIRE, ("close",), clean.type_prices, schemas.PRICE_TABLE, MONTH),
}


@dataclasses.dataclass(frozen=True)
class Run:
    """What became of a run's messages; ``rejects`` is a Parquet folder of (value, reason)."""

    messages: int
    kept: int
    rejected: dict[str, int]
    rejects: str

    @property
    def usable(self) -> int:
        return self.messages - sum(self.rejected.values())


def relaxed(schema: T.StructType) -> T.StructType:
    """The schema as files hold it: every column may be NULL."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _missing(columns) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns], F.lit(False))


def screened(messages: DataFrame, feed: str) -> DataFrame:
    """Typed records beside their message and the ``reason`` for which each cannot be used (NULL if it can).

    ``undecodable``: no field could be read.  ``incomplete``: a needed field is
    missing.  ``no_key``: the natural key is.  ``nonconforming``: a value that
    the target table requires has the wrong type.
    """
    spec = FEEDS[feed]
    names = [f.name for f in spec.wire]
    wire = messages.select(F.col("value").cast("string").alias("_value"), F.from_json(F.col("value").cast("string"), spec.wire).alias("_data"))
    wire = wire.select("_value", *[F.col(f"_data.{n}").alias(n) for n in names])
    unread = ~reduce(or_, [F.col(n).isNotNull() for n in names])
    marked = wire.withColumns({"_unread": unread, "_incomplete": _missing(spec.needs)})
    typed = spec.typed(marked)
    reason = (
        F.when(F.col("_unread"), "undecodable").when(F.col("_incomplete"), "incomplete")
        .when(_missing(NATURAL_KEY[feed]), "no_key").when(clean._lacking(typed, spec.table), "nonconforming"))
    return typed.withColumn("reason", reason).drop("_unread", "_incomplete")


def _run(
    spark: SparkSession, messages: DataFrame, feed: str, rejects: str | None, sink: Callable[[DataFrame], None],
) -> Run:
    """Stage the screened messages once, keep the rejects, and hand the clean rows on."""
    stage = shared_folder(spark, feed)
    rows = screened(messages, feed)
    rows.write.parquet(stage)
    stored = dedupe.placed(spark.read.schema(relaxed(rows.schema)).parquet(stage))
    counts = {r["reason"]: r["count"] for r in stored.groupBy("reason").count().collect()}
    rejects = rejects or shared_folder(spark, f"{feed}-rejects")
    stored.filter("reason IS NOT NULL").select(F.col("_value").alias("value"), "reason").write.mode("append").parquet(rejects)
    clean_rows, dropped, copies = first_stored(spark, stored, feed)
    sink(clean_rows)
    usable = counts.get(None, 0)
    run = Run(sum(counts.values()), usable - copies, {k: v for k, v in counts.items() if k}, rejects)
    store.release(spark, stage)
    store.release(spark, dropped)
    return run


def first_stored(spark: SparkSession, stored: DataFrame, feed: str) -> tuple[DataFrame, str, int]:
    """The usable rows of a stage (``placed``), one per natural key, beside a folder with the places of the copies left out, and their number.

    The stage is not written once more: whoever uses the rows reads it without the copies.
    """
    usable, dropped = stored.filter("reason IS NULL").drop("_value", "reason"), shared_folder(spark, f"{feed}-copies")
    watched, watch = summary.observed(dedupe.later_copies(usable, NATURAL_KEY[feed]), "copies")
    watched.write.parquet(dropped)
    places = spark.read.schema(watched.schema).parquet(dropped)
    return dedupe.without_places(usable, places), dropped, watch.get["rows"]


def _insert(spark: SparkSession, rows: DataFrame, path: str, feed: str) -> None:
    spec = FEEDS[feed]
    table = clean.conform(rows, spec.table, clip=sinks.CLIPPED)
    store.insert_new(spark, path, relaxed(spec.table), table, NATURAL_KEY[feed], spec.part)


def table(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """The stored rows of a feed."""
    return store.read(spark, path, relaxed(FEEDS[feed].table))


def load_market(spark: SparkSession, messages: DataFrame, path: str, rejects: str | None = None) -> Run:
    return _run(spark, messages, "market", rejects, lambda rows: _insert(spark, rows, path, "market"))


def upsert_bars(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Upserted by month; the stored open stays."""
    spec = FEEDS["prices"]
    bars = clean.conform(rows, spec.table)
    store.replace_parts(spark, path, relaxed(spec.table), bars, spec.part, merge.upsert_prices)


def load_prices(spark: SparkSession, messages: DataFrame, path: str, rejects: str | None = None) -> Run:
    return _run(spark, messages, "prices", rejects, lambda rows: upsert_bars(spark, rows, path))


def article_schema() -> T.StructType:
    typed = {"published_at": T.TimestampType(), "fetched_at": T.TimestampType()}
    return T.StructType([
        *[T.StructField(f.name, typed.get(f.name, f.dataType)) for f in schemas.NEWS_WIRE], T.StructField("date_only", T.DateType()),
        T.StructField("content_length", T.IntegerType()), T.StructField("has_full_content", T.BooleanType())])


def filing_schema() -> T.StructType:
    typed = {"filed_at": T.DateType(), "period": T.DateType(), "fetched_at": T.TimestampType()}
    return T.StructType([T.StructField(f.name, typed.get(f.name, f.dataType)) for f in schemas.FILING_WIRE])


def articles(spark: SparkSession, path: str) -> DataFrame:
    """Whole articles: the newest version of each."""
    return store.documents(spark, path, article_schema(), "url")


def filing_texts(spark: SparkSession, path: str) -> DataFrame:
    """Filings with the newest text each ever had; ``text_chars`` follows the text."""
    found = store.documents(spark, path, filing_schema(), "accession_number", ["full_text"])
    return found.withColumn("text_chars", F.length("full_text").cast("bigint"))


# Key, fields and last step of the feeds whose whole records are documents.
DOCUMENTS = {
    "news": ("url", article_schema, merge.with_content_fields),
    "filings": ("accession_number", filing_schema, lambda rows: rows),
}


def keep_documents(spark: SparkSession, rows: DataFrame, path: str, feed: str, run: str | None = None, unique: bool = False) -> None:
    key, schema, ready = DOCUMENTS[feed]
    store.append_documents(spark, path, schema(), ready(rows), key, run=run, unique=unique)


def keep_both(
    spark: SparkSession, rows: DataFrame, feed: str, path: str, documents: str | None = None, run: str | None = None,
) -> None:
    """Clean rows of a feed, one per natural key, to its table and, where it has them, whole records to the documents."""
    if feed == "prices":
        upsert_bars(spark, rows, path)
    else:
        _insert(spark, rows, path, feed)
    if documents is not None:
        keep_documents(spark, rows, documents, feed, run, unique=True)


def load_news(spark: SparkSession, messages: DataFrame, path: str, documents: str, rejects: str | None = None) -> Run:
    """Metadata to the table, whole articles to the documents."""
    return _run(spark, messages, "news", rejects, lambda rows: keep_both(spark, rows, "news", path, documents))


def load_filings(spark: SparkSession, messages: DataFrame, path: str, documents: str, rejects: str | None = None) -> Run:
    """Metadata to the table, texts to the documents (an empty text keeps the stored one)."""
    return _run(spark, messages, "filings", rejects, lambda rows: keep_both(spark, rows, "filings", path, documents))
