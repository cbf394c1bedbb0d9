import random
import re
import sys
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from awkward import awkward, docs, none  # noqa: F401

from tapewright.llm import blocks, phrases


def slow(rows, least, longest=5, first=2000):
    """All counts of all phrases in plain Python."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(frame, **more):
    return sorted(tuple(r) for r in phrases.collocations(frame, **more).collect())


def test_awkward_documents(docs):  # noqa: F811
    for least in (2, 100):
        assert got(docs, least=least) == slow([(r[1], r[2]) for r in awkward()], least)


def test_no_rows(none):  # noqa: F811
    assert got(none) == []


def test_against_plain_counts(spark):
    rng = random.Random(2)
    words = ["a", "b", "C", "é", "日本", "new", "york", "\x01x", "d\x1f", "it's"]
    rows = []
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", ".", "\n", " New York City "]) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "en", "en", None, "de", "und"])))
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for least, first in ((3, 2000), (20, 2000), (20, 7)):
        assert got(frame, least=least, first=first) == slow(rows, least, first=first)


def test_ranges_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(" ".join(rng.choice("abcdefg") for _ in range(80)), "en") for _ in range(60)]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(phrases, "RANGE", 100)
    monkeypatch.setattr(blocks, "ROWS", 7)
    assert got(frame, least=5) == slow(rows, 5)


def test_automata_unite_prune_and_compose():
    rng = random.Random(1)
    whole, parts = Counter(), []
    for _ in range(4):
        own = Counter(tuple(rng.randrange(4) for _ in range(rng.choice([2, 3, 5]))) for _ in range(200))
        whole += own
        rows = np.array([list(p) + [-1] * (5 - len(p)) for p in sorted(own)])
        parts.append(phrases.Automaton.of_sorted(rows, np.array([own[p] for p in sorted(own)])))
    through = Counter()
    for p, n in whole.items():
        through.update({p[:i]: n for i in range(1, len(p) + 1)})
    one = phrases.Automaton.union([phrases.Automaton.unpack(p.pack()) for p in parts])
    asked = [list(p) for p in through] + [[9], [0, 9], [9, 0]]
    assert one.compose(asked) == [through[tuple(p)] for p in asked]
    kept = one.pruned(20)
    assert {tuple(p) for t in range(1, 5) for p in kept.paths(t).tolist()} == {p for p, n in through.items() if len(p) > 1 and n >= 20}


def test_packed_numbers_take_memory_of_their_own_size():
    numbers = np.repeat(np.arange(4000), 32)
    tracemalloc.start()
    held = [blocks.packed(numbers) for _ in range(20)]
    taken = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert (blocks.unpacked(held[0], "<i8") == numbers).all()
    assert taken < 2 * sum(map(sys.getsizeof, held)) < 20 * numbers.nbytes / 4


def test_automata_that_stay_apart_are_united_a_few_times(monkeypatch):
    """200 automata of two ranges, no sequence twice but one: the arcs of a range pass what a task holds."""
    monkeypatch.setattr(phrases, "HELD", 16)
    calls, union = [], phrases.Automaton.union
    monkeypatch.setattr(phrases.Automaton, "union", lambda parts: calls.append(len(parts)) or union(parts))
    rows = []
    for r in range(2):
        for i in range(100):
            sorted_rows = np.array([[0, 1, -1], [r + 1, i, 0], [r + 1, i, 1]], np.int64)
            rows.append((r, "en", phrases.Automaton.of_sorted(sorted_rows, np.array([1, i + 1, 1])).pack()))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.list_(pa.binary())))]
    out = pa.Table.from_batches(phrases._united(50)(iter(pa.table(columns, ["range", "lang", "automaton"]).to_batches(7))))
    assert out.column("range").to_pylist() == [0, 1]
    for r, data in enumerate(out.column("automaton").to_pylist()):
        whole = phrases.Automaton.unpack(data)
        asked = [[0, 1], [r + 1, 60], [r + 1, 60, 0], [r + 1, 60, 1], [r + 1, 20, 0]]
        assert whole.compose(asked) == [100, 62, 61, 0, 0]
    assert len(calls) < 16


def test_blocks_keep_every_text(docs, spark, monkeypatch):  # noqa: F811
    monkeypatch.setattr(blocks, "BYTES", 50_000)
    from pyspark.sql import functions as F
    held = blocks.stored(docs, "text", ids=F.col("doc_id"))
    out = [(i, t) for r in held.collect() for i, t in zip(r["ids"], blocks.texts_of(r["sizes"], r["texts"]))]
    assert sorted(out, key=str) == sorted(((r[0], (r[1] or "").encode()) for r in awkward()), key=str)
    assert len({(r["part"], r["seq"]) for r in held.collect()}) == held.count() > 2


def test_a_frequent_pair_is_spread_over_ranges(spark, monkeypatch):
    """Half of all pairs are one pair: its sequences gather in no range, and all counts stay exact."""
    monkeypatch.setattr(phrases, "RANGE", 100)
    monkeypatch.setattr(blocks, "ROWS", 7)
    rng = random.Random(8)
    rows = [(" ".join(rng.choice(["of the", "of the", "the of", rng.choice("abcdefgh")]) for _ in range(60)) + rng.choice([".", " of the"]), "en") for _ in range(60)]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for least in (5, 60):
        assert got(frame, least=least) == slow(rows, least)
    first, second, third = np.array([1] * 1000), np.array([2] * 1000), np.arange(1000)
    dealt = phrases.Dealt(64, np.array([2, 1]), np.array([3200, 100_000]))  # RANGE is 100
    assert set(dealt.spread(first, second)) == {32} and np.bincount(dealt.ranges_of(first, second, third)).max() < 100
    assert set(phrases.Dealt(64, [2], [3200]).ranges_of(first, second, third)) == set(phrases.range_of(first, second, 64))


def test_small_automata_are_packed_as_one():
    one = phrases.Automaton.of_sorted(np.array([[0, 1, -1], [0, 2, 2 ** 40]], np.int64), np.array([2 ** 33, 3]))
    assert len(one.pack()) == 1 and len(one.pack()[0]) < 130
    back = phrases.Automaton.unpack(one.pack())
    assert all((x == y).all() for a, b in zip(one.levels, back.levels) for x, y in zip(a, b))


def test_first_words_that_lead_nowhere_are_pruned():
    rows = np.array([[w, 3, -1] for w in range(50)], np.int64)
    kept = phrases.Automaton.of_sorted(rows, np.where(np.arange(50) == 7, 100, 1)).pruned(100)
    assert kept.arcs() == 2 and kept.compose([[7, 3], [8, 3], [7, 4]]) == [100, 0, 0]
