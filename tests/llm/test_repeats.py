import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from awkward import awkward, docs, none  # noqa: F401

from tapewright.llm import blocks, repeats

SCHEMA = "doc_id bigint, text string"


def slow(rows, length=50):
    """Every string of every text, in plain Python."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in rows:
        k = float("inf") if i is None else i
        for p in range(len(t) - length + 1):
            s = t[p:p + length]
            first[s] = min(first.get(s, float("inf")), k)
    out = []
    for i, t in rows:
        k = float("inf") if i is None else i
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < k:
                gone[p:p + length] = b"\1" * length
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in repeats.removed(frame).collect()), key=str)


def test_awkward_documents(docs):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward() if len(r[1] or "") < 20_000]
    assert got(docs.filter("length(text) < 20000 OR text IS NULL")) == slow(rows)


def test_long_runs_of_one_character(spark):
    rows = [(3, "x" * 9_000), (1, "x" * 4_000 + "y"), (2, "ab" * 2_000), (4, "a" + "ab" * 100), (5, "\0" * 300), (6, "\0" * 70 + "z"), (7, "z" + "\0" * 55)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == slow(rows)


def test_no_rows(none):  # noqa: F811
    assert got(none) == []
    assert repeats.repeats(none).collect() == []


def passages(rng, n):
    """Documents made of passages that others share, of copies, near copies and edges of all lengths around 50."""
    words = [f"w{rng.randrange(300)}" for _ in range(3000)]
    shared = [" ".join(words[i:i + rng.choice([5, 12, 30, 80])]) for i in rng.sample(range(2900), 25)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.15 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.4 and rows:
            text = list(rng.choice(rows)[1] or "")
            for _ in range(rng.randrange(4)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice("xyz\0é")
            text = "".join(text)
        else:
            text = "".join(rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choice("abcdef ") for _ in range(rng.randrange(90))) for _ in range(rng.randrange(8)))
        rows.append((rng.choice([i, i, i, max(0, i - 3), None]), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 64)
    monkeypatch.setattr(blocks, "ROWS", 13)
    rows = passages(random.Random(seed), 150)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == slow(rows)


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "TOGETHER", 1)
    monkeypatch.setattr(repeats, "SORTED", 1)
    monkeypatch.setitem(repeats.__dict__, "GROUP", 1000)
    rows = passages(random.Random(9), 60)
    assert got(spark.createDataFrame(rows, SCHEMA)) == slow(rows)


def test_all_occurrences_of_maximal_repeats(spark):
    rng = random.Random(3)
    rows = passages(rng, 80)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    texts = {}
    for i, t in rows:
        texts.setdefault(t.encode(), i)
    found = repeats.repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert found
    places = defaultdict(set)
    for r in found:
        places[bytes(r["repeat"])].add((r["doc_id"], r["start"]))
        assert len(r["repeat"]) == r["size"] >= 50
    for repeat, its in places.items():
        # Every occurrence in every text that stands for its copies, not only neighbours in the suffix array.
        every = {(i, p) for t, i in texts.items() for p in range(len(t) - len(repeat) + 1) if t[p:p + len(repeat)] == repeat}
        assert its == every and len({i for i, _ in its}) > 1
        assert {r["first"] for r in found if bytes(r["repeat"]) == repeat} == {min(i for i, _ in its)}


def test_tree_gives_nested_repeats():
    # banana-like: suffixes in order with their common prefixes
    table = sorted(["xab", "xabc", "xabd", "yab"])
    sizes = [len(s) for s in table]
    common = [3, 3, 0, 0]
    out = set(repeats.tree(sizes, common, [1, 2, 3, 4], [9, 2, 3, 4], [-1] * 4, 2))
    assert out == {(3, 0, 2, 1)}
    assert list(repeats.tree([3, 4], [3, 0], [1, 2], [1, 2], [7, 7], 2)) == []  # one byte before all of them
    assert list(repeats.tree([3, 4], [3, 0], [1, 2], [1, 2], [7, 8], 2)) == [(3, 0, 1, 1)]
    nested = list(repeats.tree([4, 4, 3], [4, 2, 0], [5, 6, 1], [5, 6, 1], [-1, -1, -1], 2))
    assert sorted(nested) == [(2, 0, 2, 1), (4, 0, 1, 5)]


@pytest.mark.parametrize("at_once", [1, 700, 1 << 20])
def test_equal_strings_have_equal_anchors(monkeypatch, at_once):
    monkeypatch.setattr(repeats, "AT_ONCE", at_once)
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (5000, 0, 49, 50, 51, 300)]
    where, strings = {}, 0
    found = repeats.anchored(texts)
    for i, h, place, first, last in zip(*(found[n].tolist() for n in ("text", "hash", "place", "first", "last"))):
        for p in range(first, last + 1):
            assert 0 <= place - p <= 30
            assert where.setdefault(texts[i][p:p + 50], (h, place - p)) == (h, place - p)
            strings += 1
    assert strings == sum(max(0, len(t) - 49) for t in texts)


def _rows_of_blocks(n, texts):
    """Blocks of one part, each with some texts, as they come to a task."""
    for seq in range(n):
        its = texts(seq)
        yield {"part": 3, "seq": seq, "keys": [100 * seq + i for i in range(len(its))], "ours": list(range(len(its))),
               "sizes": blocks.packed(np.array([len(t) for t in its], np.int64)), "texts": blocks.compressed(b"".join(its))}


def test_grams_are_dealt_by_bundles_not_by_blocks():
    """Blocks times groups would grow with the square of the table."""
    rng = np.random.default_rng(5)
    common = bytes(rng.integers(97, 123, 80, dtype=np.uint8))
    rows = list(_rows_of_blocks(2 * repeats.BUNDLE, lambda seq: [bytes(rng.integers(97, 123, 900, dtype=np.uint8)) + common for _ in range(4)]))
    batches = pa.Table.from_pylist(rows).cast(pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("keys", pa.list_(pa.int64())), ("ours", pa.list_(pa.int32())), ("sizes", pa.binary()), ("texts", pa.binary())])).to_batches(5)
    dealt = pa.Table.from_batches(repeats._gathered(10, 50)(iter(batches)))
    assert dealt.num_rows == 2 * 10 and set(dealt.column("bundle").to_pylist()) == {0, 1}
    met = pa.Table.from_batches(repeats._shared(iter(dealt.sort_by("grp").to_batches(3))))
    # What the texts share is told to both bundles, and nothing else.
    of = [np.concatenate([np.frombuffer(r["shared"], "<u4") for r in met.to_pylist() if r["bundle"] == b]) for b in (0, 1)]
    inside = set((repeats.anchored([common])["hash"] & np.uint64(0xFFFFFFFF)).tolist())
    assert inside and inside <= set(of[0].tolist()) == set(of[1].tolist()) and len(of[0]) < 20


def test_nested_repeats_come_as_one_stretch():
    """Ten texts that agree for ever longer: each loses one stretch of its segment, however many repeats make it up."""
    whole = bytes(np.random.default_rng(6).integers(97, 123, 80, dtype=np.uint8))
    segments = [whole[:n] + bytes([65 + i]) * (80 - n) for i, n in enumerate(range(52, 72, 2))] + [whole]
    n = len(segments)
    table = pa.table({
        "gram": pa.array([7] * n), "segment": pa.array(segments), "least": pa.array(range(n), pa.int64()), "most": pa.array(range(n), pa.int64()),
        "part": pa.array([0] * n, pa.int32()), "seq": pa.array([0] * n, pa.int32()), "places": pa.array([np.array([i, 0], "<i4").tobytes() for i in range(n)])})
    out = pa.Table.from_batches(repeats._grouped(50, False)(iter(table.to_batches()))).to_pylist()
    assert sorted((int(np.frombuffer(r["places"], "<i4")[0]), r["start"], r["size"]) for r in out) == [
        (i, 0, min(50 + 2 * i, 70)) for i in range(1, n)]
