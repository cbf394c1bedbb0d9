import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from awkward import awkward, docs, none  # noqa: F401
from hypothesis import given, settings, strategies as st

from tapewright.llm import packing, tokens


def check(rows, texts, capacity):
    """Every id of every document lies in one piece, and sequences have no gaps and little padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 0 < r["length"] <= capacity and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for key, expected in texts.items():
        wanted = sorted(np.append(tokens.encode(t), 0).astype("<u4").tobytes() for t in expected)
        total += sum(len(w) // 4 for w in wanted)
        if len(expected) == 1:
            pieces = sorted(by_doc[key], key=lambda r: r["start"])
            assert b"".join(bytes(p["ids"]) for p in pieces) == wanted[0]
            assert [p["start"] for p in pieces] == np.cumsum([0, *[p["length"] for p in pieces[:-1]]]).tolist()
            assert {p["doc_tokens"] for p in pieces} == {len(wanted[0]) // 4}
        assert sum(p["length"] for p in by_doc[key]) == sum(len(w) // 4 for w in wanted)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return total, len(by_sequence)


def test_awkward_documents_in_two_tasks(docs):  # noqa: F811
    texts = defaultdict(list)
    for row in awkward():
        texts[row[0]].append(row[1])
    rows = packing.pack(docs.repartition(2), capacity=128, block=5).collect()
    total, sequences = check(rows, texts, 128)
    # Less than one sequence of padding per block and task.
    assert sequences <= -(-total // 128) + 2 * (len(awkward()) // 5 + 1)


def test_sequences_hold_the_pieces(docs):  # noqa: F811
    packed = packing.pack(docs, capacity=64)
    ids = {r["sequence_id"]: b"" for r in packed.collect()}
    for r in sorted(packed.collect(), key=lambda r: r["offset"]):
        ids[r["sequence_id"]] += bytes(r["ids"])
    got = packing.sequences(packed).collect()
    assert {r["sequence_id"]: zlib.crc32(bytes(r["ids"])) for r in got} == {k: zlib.crc32(v) for k, v in ids.items()}


def test_no_rows(none):  # noqa: F811
    assert packing.pack(none).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), min_size=1, max_size=60))
def test_assignment(lengths):
    placed = packing.assign(np.array(lengths), 32, 1 / 64)
    room = defaultdict(int)
    for document, start, length, sequence, offset in placed:
        assert offset == room[sequence] and length > 0
        room[sequence] += length
    assert max(room.values()) <= 32 and len(room) <= -(-sum(lengths) // 32)
    for d, n in enumerate(lengths):
        assert sum(p[2] for p in placed if p[0] == d) == n


def test_equal_costs_are_spread():
    """Descending documents go to the cheapest sequence with room."""
    placed = packing.assign(np.array([10, 9, 2, 1, 5, 5]), 16, 0.0)
    loads = defaultdict(int)
    for _, _, length, sequence, _ in placed:
        loads[sequence] += length
    assert sorted(loads.values()) == [16, 16]


@pytest.mark.parametrize("text", ["a<|endoftext|>b", " " * 500_000 + "x", "é😀\n\n  x"])
def test_ids_are_those_of_the_tokenizer(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    assert tokens.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


class Frame:
    """Stands in for a frame: hands out the function that a task runs."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_a_task_holds_only_the_rests_of_documents(spark, monkeypatch):
    """Whole runs leave as they come and in small batches, not with the end of a block of 4,096 documents."""
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    read = []

    def batches():
        for i in range(40):
            read.append(i)
            yield pa.record_batch({"doc_id": pa.array([i]), "text": pa.array(["word " * 20_000])})

    run = packing.pack(Frame(), capacity=64)
    out, seen = [], []
    for batch in run(batches()):
        out.append(batch)
        seen.append(len(read))
    assert seen[0] == 1 and max(b.num_rows for b in out) <= packing.PIECES
    # Nothing is lost, and every document is cut without a gap.
    rows = pa.Table.from_batches(out).to_pylist()
    texts = {i: ["word " * 20_000] for i in range(40)}
    total, sequences = check(rows, texts, 64)
    assert sequences == -(-total // 64)


def test_the_second_tokenizer_is_loaded_for_added_tokens_only():
    tokens._whole.cache_clear()
    tokens.encode_added("ordinary text")
    assert tokens._whole.cache_info().currsize == 0
    assert 50256 in tokens.encode_added("a<|endoftext|>b") and tokens._whole.cache_info().currsize == 1
