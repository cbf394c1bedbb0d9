"""Whole texts in compressed blocks, stored so that later passes read them where they lie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tapewright.llm.common import bucketed

# Bytes of text and rows in a block; a longer text is a block of its own.
BYTES = 1 << 20
ROWS = 4096


def compressed(data: bytes) -> bytes:
    """Compressed data in memory of its own size; the library's result keeps as much as it was given, and more, for as long as it is held."""
    return bytes(memoryview(zstandard.compress(data, 1)))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of one type, compressed byte by byte of their places."""
    flat = np.ascontiguousarray(numbers)
    planes = np.ascontiguousarray(flat.view(np.uint8).reshape(len(flat), flat.itemsize).T) if len(flat) else flat
    return compressed(planes.tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)


def stored(docs: DataFrame, text: str, **carried: Column) -> DataFrame:
    """``part, seq``, the carried columns as arrays, and a block's ``texts``.

    ``part`` is the task that read the rows, ``seq`` its block.  The table is
    bucketed by part, so what other passes find out for a part is joined to it
    without another exchange of texts.  A NULL text counts as empty.
    """
    rows = docs.select(*[c.alias(n) for n, c in carried.items()], F.col(text).cast("binary").alias("_text"))
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()),
        *[T.StructField(n, T.ArrayType(rows.schema[n].dataType)) for n in carried],
        T.StructField("sizes", T.BinaryType()), T.StructField("texts", T.BinaryType())])

    names, columns = list(carried), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            texts = [t or b"" for t in whole.column("_text").to_pylist()]
            lists = [pa.ListArray.from_arrays([0, len(whole)], whole.column(n).combine_chunks()) for n in names]
            sizes = packed(np.array([len(t) for t in texts], np.int64))
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), *lists, pa.array([sizes], pa.binary()),
                 pa.array([zstandard.compress(b"".join(texts), 1)], pa.binary())], columns)

        for batch in batches:
            ends = np.cumsum([len(t.as_py() or b"") for t in batch.column("_text")])
            start = 0
            while start < batch.num_rows:
                done = int(ends[start - 1]) if start else 0
                # As many rows as the block still takes, one at least in an empty block.
                take = int(np.searchsorted(ends, done + BYTES - size, "right")) - start
                take = min(max(take, 0 if held else 1), ROWS - sum(b.num_rows for b in held), batch.num_rows - start)
                if take:
                    held.append(batch.slice(start, take))
                    size += int(ends[start + take - 1]) - done
                    start += take
                if start < batch.num_rows or size >= BYTES or sum(b.num_rows for b in held) == ROWS:
                    yield flush()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield flush()

    return bucketed(rows.mapInArrow(run, schema), "blocks", "part")


def texts_of(sizes: bytes, texts: bytes) -> list[bytes]:
    ends = np.cumsum(unpacked(sizes, "<i8")).tolist()
    whole = zstandard.decompress(texts)
    return [whole[s:e] for s, e in zip([0, *ends], ends)]
