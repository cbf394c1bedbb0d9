"""Cost-balanced packing of documents into token sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tapewright.llm import tokens

# Documents whose ends are packed together.  A block wastes less than one sequence.
BLOCK = 4096
# Pieces that leave a task at once: a batch of them is a megabyte at most.
PIECES = 256
# Attention costs 4dL per token where the rest of a layer costs 24dd: L / 6d of it.
WIDTH = 1024


def assign(lengths: np.ndarray, capacity: int, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for documents shorter than a sequence.

    Descending documents go to the sequence of the lowest cost so far (linear
    plus quadratic in each piece's length) that has room.  There are just
    enough sequences for all tokens, so a document that fits nowhere whole is
    cut: it fills the cheapest open sequences one after the other.
    """
    count = -(-int(lengths.sum()) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity)
    placed = []
    for document in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[document])
        while left:
            fits = np.where(room >= left, cost, np.inf)
            sequence = int(fits.argmin())
            if np.isinf(fits[sequence]):
                sequence = int(np.where(room > 0, cost, np.inf).argmin())
            taken = min(left, int(room[sequence]))
            placed.append((int(document), start, taken, sequence, capacity - int(room[sequence])))
            cost[sequence] += taken + quadratic * taken * taken
            room[sequence] -= taken
            start, left = start + taken, left - taken
    return placed


def pack(
    docs: DataFrame, capacity: int = 1024, path: str | None = None, end: int = tokens.END,
    block: int = BLOCK, width: int = WIDTH, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence.

    A document is its ids and ``end``.  Whole runs of ``capacity`` ids are a
    sequence each; the rest of a document is packed with the rests of the
    other documents in its block.  A task packs what it reads, so nothing is
    exchanged.  Whole runs leave it as they come and ``PIECES`` at a time, so
    the rests of a block are all it holds, however long documents are.  ``ids``
    has the ids as unsigned little-endian 32-bit numbers.

    A NULL text counts as empty: one piece of the single id ``end``.  Every row
    is packed, also rows with equal, repeated or NULL keys; other columns are
    not looked at.  An empty table gives no rows.  Sequence numbers are unique
    within one run, not the same from one layout of the input to another.
    """
    quadratic = 1 / (6 * width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        used = 0
        # Of the documents of a block: key, number of ids, and the ids after the last whole run.
        rests: list[tuple[int | None, int, np.ndarray]] = []
        made: list[tuple[int | None, int, int, bytes, int, int, int]] = []

        def flush() -> pa.RecordBatch:
            key, start, length, ids, doc_tokens, sequence, offset = zip(*made)
            made.clear()
            n = np.array(length, "i8")
            return pa.record_batch({
                "doc_id": pa.array(key, pa.int64()),
                "start": np.array(start, "i8"),
                "length": n,
                "ids": pa.array(ids, pa.binary()),
                "doc_tokens": np.array(doc_tokens, "i8"),
                "sequence_id": base + np.array(sequence, "i8"),
                "offset": np.array(offset, "i8"),
                "cost": n + quadratic * n * n,
            })

        def whole(one: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal used
            rest = len(ids) % capacity
            for s in range(0, len(ids) - rest, capacity):
                made.append((one, s, capacity, ids[s:s + capacity].tobytes(), len(ids), used, 0))
                used += 1
                if len(made) == PIECES:
                    yield flush()
            rests.append((one, len(ids), ids[len(ids) - rest:].copy()))

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal used
            last = used
            for d, s, n, sequence, offset in assign(np.array([len(r) for _, _, r in rests]), capacity, quadratic):
                one, total, rest = rests[d]
                made.append((one, total - len(rest) + s, n, rest[s:s + n].tobytes(), total, used + sequence, offset))
                last = max(last, used + sequence + 1)
                if len(made) == PIECES:
                    yield flush()
            used = last
            rests.clear()

        for batch in batches:
            for one, string in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from whole(one, np.append(tokens.encode_added(string.as_py(), path), np.uint32(end)).astype("<u4"))
                if len(rests) == block:
                    yield from packed()
        yield from packed()
        if made:
            yield flush()

    return docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, cost double",
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves: one row per sequence, with its documents in order.

    A sequence has at most ``capacity`` pieces, so no group grows with the data.
    """
    piece = F.struct("offset", "doc_id", "start", "length", "ids")
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces")).select(
        "sequence_id",
        F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("pieces", lambda p: F.struct(p["doc_id"], p["start"], p["length"])).alias("pieces"),
    )
