"""Writers: relational, documents, messages, files, and keyed Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tapewright.dims import TITLE_CHARS
from tapewright.operators import summary
from tapewright.operators.clean import conform
from tapewright.session import shared_folder
from tapewright.sinks import store
from tapewright.sources.messages import encode

JDBC_BATCH = 500
# Any text survives: quotes are doubled, and what is read back may have line breaks inside.
CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "nullValue": "\\N", "emptyValue": "",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


# Columns of the relational tables that hold a part of a longer text.
CLIPPED = {"title": TITLE_CHARS}


def relational(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    df.write.jdbc(url, table, mode=mode, properties={"batchsize": str(JDBC_BATCH), **properties})


def collection(df: DataFrame, fmt: str, mode: str = "append", **options: str) -> None:
    """Documents in whatever format the class path offers (a connector, JSON, Parquet)."""
    df.write.format(fmt).mode(mode).options(**options).save()


def publish_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON message per line."""
    encode(df).write.mode(mode).text(path)


def publish_topic(df: DataFrame, servers: str, topic: str) -> None:
    encode(df).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).option("quoteAll", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV).csv(path)


def dual(
    df: DataFrame, table_schema: T.StructType,
    to_table: Callable[[DataFrame], None], to_documents: Callable[[DataFrame], None],
) -> int:
    """Typed columns to a table and whole records to documents; returns the row count.

    The cleaned frame is computed once, into a staged table in the shared
    folder: a lost executor costs neither sink a second pass over the sources,
    and the typed sink reads only its own columns.  Both sinks write at once;
    the staged table goes when they are done.  Only the typed table has its
    texts cut to their columns' lengths.
    """
    spark, stage = df.sparkSession, shared_folder(df.sparkSession, "stage")
    watched, watch = summary.observed(df, "dual")
    watched.write.parquet(stage)
    kept = stored_table(spark, stage, df.schema)
    to_table(conform(kept, table_schema, clip=CLIPPED))
    to_documents(kept)
    store.release(spark, stage)
    return watch.get["rows"]


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
