"""Chat formatting on token level: segments encoded apart, reserved ids between them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from tapewright.llm import tokens
from tapewright.llm.common import written

# Control strings and their reserved ids, which lie after those of the vocabulary and its end of text.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
START, SEP, END = range(50257, 50260)
LOSS_ROLE = "assistant"


def escaped(text: str) -> str:
    """One backslash more between ``<`` and ``|``: no control string is left, and the way back is exact."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def turn_ids(role: str | None, text: str | None, path: str | None = None) -> tuple[np.ndarray, int, int]:
    """Ids of one turn, where its text starts among them, and how many are text.

    The segments' lengths add up to their places; no id of a segment can be a
    reserved one, whatever its text says.
    """
    segments = [np.array([START], "<u4"), tokens.encode(escaped(role or ""), path), np.array([SEP], "<u4"),
                tokens.encode(escaped(text or ""), path), np.array([END], "<u4")]
    places = np.cumsum([0, *map(len, segments)])
    return np.concatenate(segments), int(places[3]), len(segments[3])


def _encoded(turns: DataFrame, path: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [turn_ids(r.as_py(), t.as_py(), path) for r, t in zip(batch.column("role"), batch.column("text"))]
            loss = np.array([r.as_py() == LOSS_ROLE for r in batch.column("role")])
            yield pa.record_batch({
                "conv_id": batch.column("conv_id"), "turn": batch.column("turn"), "tie": batch.column("tie"),
                "ids": pa.array([ids.tobytes() for ids, _, _ in done], pa.binary()),
                "n_ids": pa.array([len(ids) for ids, _, _ in done], pa.int64()),
                "mask_start": pa.array([s for _, s, _ in done], pa.int64()),
                "mask_length": pa.array(np.where(loss, [n for _, _, n in done], 0), pa.int64()),
            })

    return turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"),
        F.xxhash64("role", "text").alias("tie"),
    ).mapInArrow(run, "conv_id bigint, turn bigint, tie bigint, ids binary, n_ids bigint, mask_start bigint, mask_length bigint")


def _prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and start of each turn within its conversation, as far as this task has it."""
    task = TaskContext.get().partitionId()
    last, place, start = object(), 0, 0
    for batch in batches:
        places, starts = [], []
        for conv, n in zip(batch.column("conv_id").to_pylist(), batch.column("n_ids").to_pylist()):
            if conv != last:
                last, place, start = conv, 0, 0
            places.append(place)
            starts.append(start)
            place, start = place + 1, start + n
        yield pa.record_batch(
            [*batch.columns, pa.array(places, pa.int64()), pa.array(starts, pa.int64()), pa.array([task] * batch.num_rows, pa.int64())],
            [*batch.schema.names, "place", "start", "task"])


def assemble(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """One row per turn: ``conv_id, place, turn, ids, start, length, mask_start, mask_length``.

    The ids of a conversation are those of its turns one after the other;
    ``start`` is where a turn begins among them, the mask is where its loss
    counts (of length 0 unless the assistant speaks).  Turns are sorted across
    tasks and each task adds up its own lengths; what earlier tasks have of the
    same conversation is added after, so no task needs to hold a conversation.

    A NULL role or text is empty; a NULL conversation is one of its own, a NULL
    turn comes first.  Rows of the same turn follow each other by a hash of
    role and text, repeated rows stay.  Other columns are not looked at, and an
    empty table gives no rows.
    """
    order = ["conv_id", "turn", "tie"]
    sorted_ = _encoded(conversations, path).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*sorted_.schema, *[T.StructField(c, T.LongType()) for c in ("place", "start", "task")]])
    local = written(sorted_.mapInArrow(_prefix, schema), "turns")
    # Only a conversation that reaches over several tasks has anything to carry: less than one per task.
    parts = local.groupBy("conv_id", "task").agg(F.sum("n_ids").alias("n"), F.count(F.lit(1)).alias("turns"))
    over = Window.partitionBy("conv_id").orderBy("task")
    carried = parts.withColumns({
        "more": F.sum("n").over(over) - F.col("n"), "past": F.sum("turns").over(over) - F.col("turns"),
    }).filter("past > 0").select(F.col("conv_id").alias("c"), F.col("task").alias("k"), "more", "past")
    met = local.join(written(carried, "carried"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("task") == F.col("k")), "left")
    start = F.col("start") + F.coalesce("more", F.lit(0))
    return met.select(
        "conv_id", (F.col("place") + F.coalesce("past", F.lit(0))).alias("place"), "turn", "ids", start.alias("start"),
        F.col("n_ids").alias("length"), (start + F.col("mask_start")).alias("mask_start"), "mask_length")


def parsed(ids: np.ndarray, path: str | None = None) -> tuple[str, str]:
    """Role and text of one turn's ids, still escaped."""
    sep = int(np.flatnonzero(ids == SEP)[0])
    if ids[0] != START or ids[-1] != END:
        raise ValueError("a turn lies between its start and its end")
    decode = tokens.byte_pairs(path).decode_bytes
    return decode(ids[1:sep].tolist()).decode(), decode(ids[sep + 1:-1].tolist()).decode()


def digests(assembled: DataFrame, path: str | None = None) -> DataFrame:
    """What the ids of each conversation say when they are read back.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    A digest needs the turns in order, so those of a conversation pass through
    one task, turn by turn; it holds one Arrow batch, not the conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []

        def row() -> pa.RecordBatch:
            conv, n, turns, chars, loss, formatted = state
            return pa.record_batch({
                "conv_id": pa.array([conv], pa.int64()), "n_turns": pa.array([n], pa.int64()),
                "turns_sha256": [turns.hexdigest()], "loss_chars": pa.array([chars], pa.int64()),
                "loss_sha256": [loss.hexdigest()], "formatted_chars": pa.array([formatted], pa.int64())})

        for batch in batches:
            ready = []
            for conv, raw, start, at, length in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "ids", "start", "mask_start", "mask_length")]):
                if state and state[0] != conv:
                    ready.append(row())
                    state.clear()
                if not state:
                    state += [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(raw, "<u4")
                role, text = parsed(ids, path)
                state[1] += 1
                state[2].update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
                under = ids[at - start:at - start + length].tolist()
                masked = unescaped(tokens.byte_pairs(path).decode_bytes(under).decode())
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += len(role) + len(text) + sum(map(len, CONTROLS))
            yield from ready
        if state:
            yield row()

    return assembled.select("conv_id", "place", "ids", "start", "mask_start", "mask_length").repartition("conv_id").sortWithinPartitions(
        "conv_id", "place",
    ).mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
