"""Structured Streaming jobs over the feeds.

Every job drains what is there (``availableNow``) and keeps its progress in a
checkpoint folder, so the next run, or a run after a lost executor or driver,
goes on where this one stopped.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tapewright.functions import dates
from tapewright.operators import joins
from tapewright.operators.dedupe import placed, salt
from tapewright.plans import loads
from tapewright.session import shared_folder
from tapewright.sinks import store

SALTS = 16


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "text",
    files_per_trigger: int | None = None, pattern: str | None = None,
) -> DataFrame:
    """Rows of a growing folder."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int = 500_000) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
        .select("value")
    )


def _drain(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    _drain(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)


def to_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    _drain(stream.writeStream.foreachBatch(each).outputMode(mode), checkpoint)


def _clocked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermark on ``time``; a time without zone is taken in the session's zone."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def dedupe(
    stream: DataFrame, keys: Sequence[str], time: str, delay: str, spread: bool = True
) -> DataFrame:
    """One row per key within the watermark, also across runs.

    ``delay`` is how late a row may come: one that is later by ``time`` is
    dropped, and a copy that comes later is a new row.  Which of the copies
    stays is whichever came first.  ``ingest`` has neither limit.

    With ``spread`` the rows of a key are first deduped in salted groups, so a
    hot key does not end up whole in one state partition.
    """
    marked = _clocked(stream, time, delay)
    if spread:
        salted = marked.withColumn("_salt", salt(stream.columns, SALTS))
        marked = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


REJECTS = T.StructType([
    T.StructField("value", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("batch_id", T.LongType())])


def ingest(
    stream: DataFrame, feed: str, path: str, checkpoint: str, documents: str | None = None, rejects: str | None = None,
) -> None:
    """Clean rows of a feed, once per natural key, in a keyed table (``loads.table`` reads it).

    Each micro-batch is screened and cleaned as in batch and inserted where its
    keys are absent.  Nothing depends on a clock: a row is kept however late it
    comes, also one without a load time, and a copy of a stored key adds
    nothing whenever it comes.  News and filings also keep their whole records
    in ``documents``, and what could not be used is kept in ``rejects`` with
    the reason (``rejected`` reads it).

    A batch that is replayed adds nothing to any of the three: keys are there
    already, a document log has the batch by its name, and rejects of a batch
    replace themselves.
    """
    if documents is not None and feed not in loads.DOCUMENTS:
        raise ValueError(f"{feed} has no documents")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, stage = loads.screened(batch, feed), shared_folder(spark, feed)
        rows.write.parquet(stage)
        stored = placed(spark.read.schema(loads.relaxed(rows.schema)).parquet(stage))
        if rejects is not None:
            refused = stored.filter("reason IS NOT NULL").select(
                F.col("_value").alias("value"), "reason", F.lit(batch_id).cast("bigint").alias("batch_id"))
            _replace_batch(refused, rejects)
        unique, dropped, _ = loads.first_stored(spark, stored, feed)
        run = f"{hashlib.md5(checkpoint.encode()).hexdigest()[:8]}-{batch_id}"
        loads.keep_both(spark, unique, feed, path, documents, run)
        store.release(spark, stage)
        store.release(spark, dropped)

    to_batches(stream, each, checkpoint)


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """What a streamed feed could not use, with the reason."""
    return spark.read.schema(REJECTS).parquet(path)


def _replace_batch(rows: DataFrame, path: str) -> None:
    """Rows of one micro-batch (``batch_id``) in a folder of their own, which a replay replaces."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def merge_into(
    spark: SparkSession, stream: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], part: str,
    checkpoint: str,
) -> None:
    """Insert-if-absent per micro-batch; a batch replayed after a failure adds nothing."""
    to_batches(
        stream, lambda batch, _: store.insert_new(batch.sparkSession, path, schema, batch, keys, part), checkpoint
    )


def upsert_into(
    spark: SparkSession, stream: DataFrame, path: str, schema: T.StructType, part: str,
    merged: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str,
) -> None:
    """Keyed upsert per micro-batch into the parts the batch touches."""
    to_batches(
        stream, lambda batch, _: store.replace_parts(batch.sparkSession, path, schema, batch, part, merged), checkpoint
    )


DAILY_COUNTS = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("n", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def _count_batches(stream: DataFrame, groups: dict[str, Column], path: str, checkpoint: str) -> None:
    """Rows per group of a stream, as one small set of partial counts per micro-batch.

    A replayed batch replaces its own folder, so nothing is counted twice and
    no late row is lost; the counts of all batches add up.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        counts = (
            batch.groupBy(*[c.alias(name) for name, c in groups.items()])
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        )
        _replace_batch(counts, path)

    to_batches(stream, each, checkpoint)


def count_days(stream: DataFrame, day: str, path: str, checkpoint: str) -> None:
    """Rows per day of a stream."""
    _count_batches(stream.filter(F.col(day).isNotNull()), {"day": F.col(day)}, path, checkpoint)


def count_weeks(stream: DataFrame, time: str, key: str, path: str, checkpoint: str) -> None:
    """Rows per week (from Monday) and key of a stream; ``week_counts`` adds them up."""
    week = F.date_trunc("week", F.col(time)).cast("date")
    _count_batches(stream.filter(F.col(time).isNotNull()), {"week_start": week, key: F.col(key)}, path, checkpoint)


def week_counts(spark: SparkSession, key: str, path: str) -> DataFrame:
    """All rows so far per week and key, open weeks and late rows included."""
    return spark.read.parquet(path).groupBy("week_start", key).agg(F.sum("n").alias("n"))


def window_counts(
    spark: SparkSession, filings: DataFrame, filed_at: str, counts_path: str, n_days: int = 7
) -> DataFrame:
    """News around each filing from the streamed daily counts (0 where there is none)."""
    counts = spark.read.schema(DAILY_COUNTS).parquet(counts_path)
    return joins.date_window_count(
        filings, counts, filed_at, "day", n_days, weight="n"
    )


def alerts(
    stream: DataFrame, watch: Sequence[str] | DataFrame, as_of: dt.date, days: int, form: str | None = None,
    ticker: str = "ticker", filed_at: str = "filed_at", form_type: str = "form_type",
) -> DataFrame:
    """Filings of watched tickers in the look-back period (batch or stream).

    ``watch`` is a list, or a frame with the ticker column when it is long.
    """
    hit = dates.since(F.col(filed_at), as_of, days)
    if form is not None:
        hit = hit & (F.col(form_type) == form)
    if isinstance(watch, DataFrame):
        return stream.filter(hit).join(watch.select(ticker), ticker, "left_semi")
    return stream.filter(hit & F.col(ticker).isin(list(watch)))
