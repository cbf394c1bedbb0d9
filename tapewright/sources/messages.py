"""Messages of a topic: bounded reads, and decoding of JSON values."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def topic_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds now (needs the Kafka connector on the class path)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
        .select("value")
    )


def file_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same from files with one JSON message per line."""
    return spark.read.text(path)


def _decoded(messages: DataFrame, schema: T.StructType) -> DataFrame:
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data"), "value")


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns; a malformed message becomes a row of NULLs."""
    return _decoded(messages, schema).select("data.*")


def undecodable(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages of which no field could be read."""
    empty = reduce(and_, [F.col(f"data.{f.name}").isNull() for f in schema])
    return _decoded(messages, schema).filter(F.col("data").isNull() | empty).select("value")


def encode(df: DataFrame) -> DataFrame:
    """One JSON message per row."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
