"""Small helpers of the operators in this folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tapewright.session import shared_folder
from tapewright.sinks.store import release

# A word is a run of anything but these six characters.
SPACES = r"[\x20\x09-\x0D]+"

ROW = "_row"

# Rows that go to Python at once: whole texts are long, and a task holds a batch on either side.
ROWS_AT_ONCE = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
BYTES_AT_ONCE = ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
# Rows that are read at once: 4,096 texts, in arrays that double, take tens of MB in every task.
ROWS_READ = ("spark.sql.parquet.columnarReaderBatchSize", "512")


def small_batches(spark: SparkSession) -> SparkSession:
    """The session with batches that fit tables of whole texts."""
    spark.conf.set(*ROWS_AT_ONCE)
    spark.conf.set(*BYTES_AT_ONCE)
    return spark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def boxed(df: DataFrame, empty: str | None = None, **columns: Column) -> DataFrame:
    """The whole row in one struct beside named columns, so that no input name can clash.

    A string column ``empty`` is NULL there, for a long text that goes beside the row.
    """
    row = [F.lit(None).cast("string").alias(c) if c == empty else F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
    return df.select(F.struct(*row).alias(ROW), *[c.alias(n) for n, c in columns.items()])


def unboxed(df: DataFrame, added: Sequence[str]) -> DataFrame:
    """The input's columns and the added ones; an input column of an added name gives way."""
    taken = {a.lower() for a in added}
    kept = [f for f in df.schema[ROW].dataType.fieldNames() if f.lower() not in taken]
    return df.select(*[F.col(ROW).getField(f).alias(f) for f in kept], *added)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe from lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(relaxed(df.schema)).parquet(path)


def relaxed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def map_batches(
    df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | T.StructType
) -> DataFrame:
    """``each`` on every Arrow batch of the frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := each(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def sample_of(df: DataFrame, rows: int, seed: int = 0) -> DataFrame:
    """About ``rows`` rows (all of a smaller frame), spread over the whole of it."""
    total = df.count()
    return df if total <= rows else df.sample(False, rows / total, seed)


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def seeded(*parts: object) -> int:
    """A number that depends on the parts alone, alike in every process."""
    return int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()[:8], "little")


def replaced(df: DataFrame, name: str, before: DataFrame | None = None) -> DataFrame:
    """Like ``written``; then the table ``before``, of which nothing reads any more, is removed."""
    after = written(df, name)
    if before is not None:
        forget(before)
    return after


def forget(df: DataFrame) -> None:
    """Remove the folder of a table that ``written`` or ``bucketed`` made and nothing reads any more."""
    spark = df.sparkSession
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        release(spark, folder)


def bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """A table in the shared folder, bucketed: what is joined to it by that column moves, the table does not."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    # More buckets than tasks, so that few tasks get the parts of several.
    buckets = min(100_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.bucketBy(buckets, by).option("path", shared_folder(spark, name)).saveAsTable(table)
    return spark.table(table)


def placed(df: DataFrame) -> DataFrame:
    """The whole rows beside ``part, pos``, the task that read them and their number in it, bucketed by part."""
    at = F.monotonically_increasing_id()
    rows = boxed(df).select(ROW, F.shiftright(at, 33).cast("int").alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("pos"))
    return bucketed(rows, "rows", "part")


def selected(rows: DataFrame, every: DataFrame, chosen: DataFrame) -> DataFrame:
    """Of ``placed`` rows those chosen, as they were.  ``every`` and ``chosen`` hold ``part, pos``.

    What is chosen of a part comes to it as a bit per row, so the rows stay where they are.
    """
    bit = F.expr("shiftleft(1L, cast(pos % 64 AS int))")
    marks = every.select("part", "pos", F.lit(0).cast("bigint").alias("bit")).union(chosen.select("part", "pos", bit.alias("bit")))
    words = marks.groupBy("part", F.expr("pos div 64").alias("w")).agg(F.bit_or("bit").alias("bits"))
    bits = words.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("w", "bits")))["bits"].alias("bits"))
    is_on = F.getbit(F.get("bits", F.expr("pos div 64").cast("int")), (F.col("pos") % 64).cast("int")) == 1
    return unboxed(rows.join(bits, "part").filter(is_on), [])
