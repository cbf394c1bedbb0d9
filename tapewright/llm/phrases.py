"""Collocations from the exact counts of all phrases, added up in weighted acyclic automata."""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tapewright.llm import blocks
from tapewright.llm.common import forget, written

LONGEST = 5
LEAST = 100
FIRST = 2000
# Words of the whole table for one range of prefixes.
RANGE = 1 << 20
# Words a task counts before it passes its counts on, and a quarter of the arcs it holds before it unites them.
HELD = 1 << 18
# Words of a shard.
SHARD = 1 << 20
# Automata of a part that leave a task at once.
ROWS_BACK = 32

# A-Z in lower case, what ends a piece, and the tab as a space.
ENDS = b".,;:!?\n\x0b\x0c\r"
SPELLING = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"\n" * len(ENDS) + b" ")


def words_of(texts: Sequence[bytes]) -> list[bytes]:
    """The words of all texts; a line feed between pieces."""
    return list(filter(None, b"\n".join(texts).translate(SPELLING).replace(b"\n", b" \n ").split(b" ")))


def range_of(first: np.ndarray, second: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a prefix of two words.  Ranges are even, however frequent a first word is."""
    mixed = (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(30)) % np.uint64(ranges)).astype(np.int64)


class Dealt:
    """How sequences are dealt to ranges: by their first two words, or by three where both are very frequent.

    ``ids`` and ``f`` are the words with a count of ``RANGE`` or more, at most as
    many as there are ranges.  A pair of them may be as frequent as the rarer
    one, so its sequences are spread by the third word over as many ranges as
    that could fill, and the weight of the pair itself is the sum over them.
    """

    def __init__(self, ranges: int, ids: np.ndarray, f: np.ndarray):
        order = np.argsort(ids)
        self.each = RANGE
        self.ranges, self.ids, self.f = ranges, np.asarray(ids, np.int64)[order], np.asarray(f, np.int64)[order]

    def spread(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """How many ranges more than one the sequences of a pair go to."""
        if not len(self.ids):
            return np.zeros(len(first), np.int64)
        at = [np.minimum(np.searchsorted(self.ids, x), len(self.ids) - 1) for x in (first, second)]
        f1, f2 = (np.where(self.ids[i] == x, self.f[i], 0) for i, x in zip(at, (first, second)))
        return np.minimum(f1, f2) // self.each

    def ranges_of(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
        """The range of sequences; ``third`` is -1 where there is none."""
        out, more = range_of(first, second, self.ranges), self.spread(first, second)
        hot = np.flatnonzero(more)
        out[hot] = (out[hot] + range_of(third[hot], second[hot], 1 << 31) % (more[hot] + 1)) % self.ranges
        return out


class Automaton:
    """A weighted acyclic automaton of word sequences.

    ``levels[t]`` has the arcs that read the word after t others, in order:
    the arc before each, its label, and the weight of all sequences through
    it, which is the count of the phrase that leads there.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def of_sorted(cls, rows: np.ndarray, weights: np.ndarray) -> Automaton:
        """From sorted sequences (a column per word, -1 after the end): an arc begins where a prefix differs from the one before."""
        upto = np.concatenate([[0], np.cumsum(weights)])
        begins = np.zeros(len(rows), bool)
        begins[:1] = True
        levels, before = [], np.zeros(len(rows), np.int64)
        for word in rows.T:
            begins = begins.copy()
            begins[1:] |= word[1:] != word[:-1]
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], len(rows))
            real = word[starts] >= 0
            levels.append((before[starts[real]], word[starts[real]], upto[ends[real]] - upto[starts[real]]))
            arcs = begins & (word >= 0)
            before = np.cumsum(arcs) - 1
        return cls(levels)

    @classmethod
    def union(cls, parts: Sequence[Automaton]) -> Automaton:
        """All sequences of the parts with their weights added: level by level, arcs with the same prefix and label are one."""
        levels, states = [], [np.zeros(1, np.int64)] * len(parts)
        for t in range(max(len(p.levels) for p in parts)):
            own = [p.levels[t] for p in parts]
            source = np.concatenate([s[before] for s, (before, _, _) in zip(states, own)])
            label = np.concatenate([x[1] for x in own])
            weight = np.concatenate([x[2] for x in own])
            order = np.lexsort((label, source))
            source, label, weight = source[order], label[order], weight[order]
            new = np.ones(len(order), bool)
            new[1:] = (source[1:] != source[:-1]) | (label[1:] != label[:-1])
            starts = np.flatnonzero(new)
            levels.append((source[starts], label[starts], np.add.reduceat(weight, starts) if len(starts) else weight))
            at = np.empty(len(order), np.int64)
            at[order] = np.cumsum(new) - 1
            states = np.split(at, np.cumsum([len(x[1]) for x in own])[:-1])
        return cls(levels)

    def pairs_spread(self, dealt: Dealt | None) -> np.ndarray:
        """Which arcs of second words are of pairs whose weight is spread over ranges."""
        before, label, _ = self.levels[1]
        return dealt.spread(self.levels[0][1][before], label) > 0 if dealt else np.zeros(len(label), bool)

    def pruned(self, least: int, dealt: Dealt | None = None) -> Automaton:
        """Without arcs of less weight.  No arc has more than the one before it, except that a first word, and some pairs, are spread over ranges."""
        levels, kept = [], None
        for t, (before, label, weight) in enumerate(self.levels):
            enough = weight >= least
            if t == 1:
                enough |= self.pairs_spread(dealt)
            keep = np.ones(len(label), bool) if t == 0 else enough & (kept[before] >= 0)
            levels.append((before[keep] if kept is None else kept[before[keep]], label[keep], weight[keep]))
            kept = np.where(keep, np.cumsum(keep) - 1, -1)
        # A first word that nothing follows any more leads nowhere.  Every range has most words as first ones.
        (before, label, weight), (after, *rest) = levels[:2]
        firsts, after = np.unique(after, return_inverse=True)
        return Automaton([(before[firsts], label[firsts], weight[firsts]), (after, *rest), *levels[2:]])

    def paths(self, t: int) -> np.ndarray:
        """The words that lead through each arc of a level, one row each."""
        at, columns = np.arange(len(self.levels[t][1])), []
        for before, label, _ in reversed(self.levels[:t + 1]):
            columns.append(label[at])
            at = before[at]
        return np.stack(columns[::-1], axis=1)

    def compose(self, phrases: list[list[int]]) -> list[int]:
        """The weights of phrases: each is read along the arcs; 0 for one that leaves them."""
        arcs = [dict(zip(zip(b.tolist(), x.tolist()), range(len(x)))) for b, x, _ in self.levels]
        out = []
        for phrase in phrases:
            at = 0
            for t, word in enumerate(phrase):
                at = arcs[t].get((at if t else 0, word), -1) if at >= 0 else -1
            out.append(int(self.levels[len(phrase) - 1][2][at]) if at >= 0 else 0)
        return out

    def arcs(self) -> int:
        return sum(len(x) for _, x, _ in self.levels)

    def pack(self) -> list[bytes]:
        """All columns compressed as one, each in as few bytes a number as it needs."""
        columns = [x for before, label, weight in self.levels for x in (np.diff(before, prepend=0), label, weight)]
        sizes = [next((n for n in (1, 2, 4) if -(1 << 8 * n - 1) <= x.min() and x.max() < 1 << 8 * n - 1), 8) if len(x) else 1 for x in columns]
        head = np.array([len(columns), *itertools.chain(*((len(x), n) for x, n in zip(columns, sizes)))], "<u4")
        planes = [x.astype(f"<i{n}").view(np.uint8).reshape(len(x), n).T.tobytes() for x, n in zip(columns, sizes)]
        return [blocks.compressed(b"".join([head.tobytes(), *planes]))]

    @classmethod
    def unpack(cls, data: list[bytes]) -> Automaton:
        whole = np.frombuffer(zstandard.decompress(data[0]), np.uint8)
        n = int(whole[:4].view("<u4")[0])
        head = whole[4:4 + 8 * n].view("<u4").tolist()
        columns, at = [], 4 + 8 * n
        for length, size in zip(head[::2], head[1::2]):
            planes = whole[at:at + length * size].reshape(size, length)
            columns.append(np.ascontiguousarray(planes.T).view(f"<i{size}").reshape(-1).astype(np.int64))
            at += length * size
        return cls([(np.cumsum(columns[i]), columns[i + 1], columns[i + 2]) for i in range(0, n, 3)])


def sequences(ids: np.ndarray, longest: int) -> np.ndarray:
    """For every place the words from there on, at most ``longest``, cut at the first -1; places with one word are left out."""
    ended = np.append(ids, np.full(longest, -1, ids.dtype))
    starts = np.flatnonzero((ended[:-1] >= 0) & (ended[1:] >= 0))
    rows = np.empty((len(starts), longest), np.int32)
    on = np.ones(len(starts), bool)
    for t in range(longest):
        word = ended[starts + t]
        on &= word >= 0
        rows[:, t] = np.where(on, word, -1)
    return rows


def shard(ids: np.ndarray, names: np.ndarray, dealt_by: Dealt, longest: int) -> Iterator[tuple[int, Automaton]]:
    """The automaton of one shard for each range of prefixes, from its sorted sequences.  ``names`` ascends."""
    rows = sequences(ids, longest)
    if not len(rows):
        return
    third = np.where(rows[:, 2] >= 0, names[rows[:, 2]], -1) if longest > 2 else np.full(len(rows), -1)
    dealt = dealt_by.ranges_of(names[rows[:, 0]], names[rows[:, 1]], third)
    order = np.lexsort((*rows.T[::-1], dealt))
    rows, dealt = rows[order], dealt[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1) | (dealt[1:] != dealt[:-1])
    starts = np.flatnonzero(new)
    weights = np.diff(np.append(starts, len(rows)))
    rows, dealt = rows[starts], dealt[starts]
    cuts = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))
    for s, e in zip(cuts, np.append(cuts[1:], len(rows))):
        yield int(dealt[s]), Automaton.of_sorted(np.where(rows[s:e] >= 0, names[rows[s:e]], -1), weights[s:e])


def _by_language(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, int, str, list[bytes]]]:
    """(row, part, language, words) of every block."""
    for i in range(batch.num_rows):
        part, langs, sizes, texts = (batch.column(c)[i].as_py() for c in ("part", "langs", "sizes", "texts"))
        own = defaultdict(list)
        for lang, text in zip(langs, blocks.texts_of(sizes, texts)):
            own[lang].append(text)
        for lang, its in own.items():
            yield i, part, lang, words_of(its)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, lang, word, n``: each word once per part, as far as a task can hold its words."""
    counts: dict[tuple[int, str], Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (part, lang), own in counts.items():
            own.pop(b"\n", None)
            yield pa.record_batch({
                "part": pa.array([part] * len(own), pa.int32()), "lang": pa.array([lang] * len(own), pa.string()),
                "word": pa.array(list(own), pa.binary()), "n": pa.array(list(own.values()), pa.int64())})
        counts.clear()

    for batch in batches:
        for _, part, lang, words in _by_language(batch):
            counts[part, lang].update(words)
        if sum(map(len, counts.values())) > HELD:
            yield from flush()
    yield from flush()


def _shards(dealt: Dealt, longest: int):
    """The automata of every block of a part.  ``known``: the frequent words of the part with their numbers."""

    def each(key: tuple, held: pa.Table, known: pa.Table) -> pa.Table:
        names, out = {}, []
        known = known.sort_by("id")
        langs = np.array(known.column("lang").to_pylist(), object)
        told, ids = np.array(known.column("word").to_pylist(), object), known.column("id").to_numpy()
        for lang in set(langs.tolist()):
            own = langs == lang
            names[lang] = dict(zip(told[own].tolist(), range(own.sum()))), ids[own]
        said: dict[str, list[np.ndarray]] = defaultdict(list)

        def flush(lang: str) -> None:
            ids = np.concatenate(said.pop(lang))
            out.extend((r, lang, a.pack()) for r, a in shard(ids, names[lang][1], dealt, longest))

        for _, _, lang, words in _by_language(held):
            if lang in names:
                place = names[lang][0]
                # A text ends where the next begins.
                said[lang].append(np.fromiter((place.get(w, -1) for w in [*words, b"\n"]), np.int32, len(words) + 1))
                if sum(map(len, said[lang])) >= SHARD:
                    flush(lang)
        for lang in list(said):
            flush(lang)
        types = (pa.int64(), pa.string(), pa.list_(pa.binary()))
        whole = pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 3, types)], ["range", "lang", "automaton"])
        # Returned in small batches: the JVM holds one at a time.
        return pa.Table.from_batches(whole.to_batches(ROWS_BACK), whole.schema)

    return each


def _united(least: int, dealt: Dealt | None = None):
    """The automata of each range and language united and pruned; rows come sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, arcs, most = None, [], 0, 4 * HELD

        def flush() -> pa.RecordBatch:
            nonlocal arcs, most
            whole = Automaton.union(held).pruned(least, dealt)
            held.clear()
            arcs, most = 0, 4 * HELD
            return pa.record_batch({
                "range": pa.array([key[0]], pa.int64()), "lang": pa.array([key[1]], pa.string()), "automaton": pa.array([whole.pack()], pa.list_(pa.binary()))})

        for batch in batches:
            for r, lang, data in zip(*(batch.column(c).to_pylist() for c in ("range", "lang", "automaton"))):
                if (r, lang) != key and held:
                    yield flush()
                key = (r, lang)
                held.append(Automaton.unpack(data))
                arcs += held[-1].arcs()
                if len(held) > 1 and arcs > most:
                    held[:] = [Automaton.union(held)]
                    arcs = held[0].arcs()
                    # What stays apart is united again only when as much has come on top.
                    most = max(most, 2 * arcs)
        if held:
            yield flush()

    return run


def _candidates(dealt: Dealt):
    """``lang, path, along, spread``: every phrase of two words or more, and the counts of its beginnings from two words on.

    ``spread``: the first two words' count is that of one range of several.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("automaton").to_pylist()):
                automaton = Automaton.unpack(data)
                pairs = automaton.pairs_spread(dealt)
                for t in range(1, len(automaton.levels)):
                    if not len(automaton.levels[t][1]):
                        continue
                    at, along = np.arange(len(automaton.levels[t][1])), []
                    for n in range(t, 0, -1):
                        before, _, weight = automaton.levels[n]
                        along.append(weight[at])
                        at, pair = before[at], at
                    paths = automaton.paths(t)
                    yield pa.record_batch({
                        "lang": pa.array([lang] * len(paths), pa.string()), "path": pa.array(list(paths), pa.list_(pa.int64())),
                        "along": pa.array(list(np.stack(along[::-1], axis=1)), pa.list_(pa.int64())), "spread": pa.array(pairs[pair])})

    return run


def _looked_up(key, asked: pa.Table, automata: pa.Table) -> pa.Table:
    """The counts of the phrases asked of one range: each composed with the range's automaton."""
    paths = asked.column("rest").to_pylist()
    whole = [Automaton.unpack(a) for a in automata.column("automaton").to_pylist()]
    counts = whole[0].compose(paths) if whole else [0] * len(paths)
    return pa.table({"lang": asked.column("lang"), "rest": asked.column("rest"), "r": pa.array(counts, pa.int64())})


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, first: int = FIRST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first phrases.

    Words are what stands between spaces and tabs in a piece, pieces end at
    punctuation and line ends, A-Z count as a-z.  A phrase of two to
    ``longest`` words with a count ``a`` of at least ``least`` is cut after each
    of its words into parts with the counts ``l`` and ``r``; the cut with the
    least floor(1000 a n / (l r)) counts, ties to the earliest.  A phrase is
    dropped if one with a word more holds it and is as frequent, which is so
    whenever any longer one is.

    Some million words are a shard: its sorted sequences of words that are
    frequent at all make an automaton, cut by ranges of two-word prefixes, or of
    three where a pair of words could fill several ranges (``Dealt``);
    ranges are united across shards, which adds the counts up, and pruned.  A
    shard sends a sequence once, so neither a frequent word or pair nor a repeated
    passage gathers in a task, and no prefix but such a pair is known outside its range.  All
    counts are exact.

    NULL texts count as empty, a NULL language as ``und``.  An empty table gives
    no rows.  Equal rows count as often as they occur.
    """
    held = blocks.stored(docs, text, langs=F.coalesce(F.col(lang).cast("string"), F.lit("und")))
    said = written(held.mapInArrow(_counted, "part int, lang string, word binary, n bigint"), "words")
    # A word's number is the least of its rows': any will do that is its own.
    word = Window.partitionBy("lang", "word")
    numbered = said.withColumn("id", F.monotonically_increasing_id()).withColumns(
        {"f": F.sum("n").over(word), "id": F.min("id").over(word)})
    told = written(numbered.filter(F.col("f") >= least).drop("n"), "vocabulary")
    total = written(said.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    ranges = max(1, -(-int(total.agg(F.sum("n")).first()[0] or 0) // RANGE))
    forget(said)
    known = told.select("lang", "word", "id", "f").distinct()
    often = known.filter(F.col("f") >= RANGE).select("id", "f").collect()
    dealt = Dealt(ranges, [r["id"] for r in often], [r["f"] for r in often])

    # Blocks lie in buckets by part, so only the words move.
    shards = held.groupBy("part").cogroup(told.select("part", "lang", "word", "id").groupBy("part"))
    made = shards.applyInArrow(_shards(dealt, longest), "range bigint, lang string, automaton array<binary>")
    united = written(made.repartition("range", "lang").sortWithinPartitions("range", "lang").mapInArrow(
        _united(least, dealt), "range bigint, lang string, automaton array<binary>"), "automata")
    forget(held)
    known = written(known, "known")
    forget(told)

    found = written(united.mapInArrow(_candidates(dealt), "lang string, path array<bigint>, along array<bigint>, spread boolean"), "candidates")
    pairs = None
    if often:
        # The counts of pairs that were spread are added up, and stand for the one of a range wherever it is named.
        pair = F.slice("path", 1, 2).alias("pair")
        pairs = found.filter("spread AND size(path) = 2").groupBy("lang", pair).agg(F.sum(F.get("along", F.lit(0))).alias("whole")).filter(F.col("whole") >= least)
        pairs = written(pairs, "pairs")
        longer = found.filter("spread AND size(path) > 2").select("lang", "path", "along", pair).join(pairs, ["lang", "pair"])
        longer = longer.select("lang", "path", F.concat(F.array("whole"), F.expr("slice(along, 2, size(along))")).alias("along"))
        found = found.filter("NOT spread").select("lang", "path", "along").union(longer).union(
            pairs.select("lang", "pair", F.array("whole")))
        found = written(found, "whole-candidates")
    else:
        found = found.drop("spread")
    found = found.withColumn("a", F.element_at("along", -1))
    cuts = found.select("lang", "path", "a", "along", F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("k"))
    cuts = cuts.withColumn("rest", F.slice("path", F.col("k") + 1, F.size("path") - F.col("k")))
    asked = cuts.filter(F.size("rest") > 1).select("lang", "rest").distinct()

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rests = batch.column("rest")
            ends = rests.offsets.to_numpy()
            flat = rests.values.to_numpy(zero_copy_only=False)
            first, second = flat[ends[:-1]], flat[ends[:-1] + 1]
            has_third = np.diff(ends) > 2
            third = np.where(has_third, flat[np.minimum(ends[:-1] + 2, len(flat) - 1)], -1)
            # Pairs that are spread have been added up.
            its = pa.array(np.flatnonzero(has_third | (dealt.spread(first, second) == 0)))
            yield pa.record_batch([pa.array(dealt.ranges_of(first, second, third)), batch.column("lang"), rests], ["range", "lang", "rest"]).take(its)

    placed = asked.mapInArrow(ranged, "range bigint, lang string, rest array<bigint>")
    longer = placed.groupBy("range", "lang").cogroup(united.groupBy("range", "lang")).applyInArrow(
        _looked_up, "lang string, rest array<bigint>, r bigint")
    single = known.select("lang", F.array("id").alias("rest"), F.col("f").alias("r"))
    counted = longer.union(single)
    if pairs is not None:
        counted = counted.union(pairs.select("lang", F.col("pair").alias("rest"), F.col("whole").alias("r")))
    parts = cuts.join(counted, ["lang", "rest"])
    heads = known.select("lang", F.col("id").alias("head"), F.col("f").alias("f"))
    parts = parts.withColumn("head", F.element_at("path", 1)).join(heads, ["lang", "head"])
    parts = parts.withColumn("l", F.when(F.col("k") == 1, F.col("f")).otherwise(F.get("along", F.col("k") - 2)))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    parts = parts.join(total, "lang").withColumns({f"_{c}": x for c, x in wide.items()})
    parts = parts.withColumn("score", F.expr("(1000BD * (_a * _n)) div (_l * _r)"))
    best = parts.groupBy("lang", "path").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("best")).select("lang", "path", "best.*")

    inner = found.filter(F.size("path") > 2).select(
        "lang", F.col("a").alias("over"),
        F.explode(F.array(F.slice("path", F.lit(1), F.size("path") - 1), F.slice("path", F.lit(2), F.size("path") - 1))).alias("path"))
    inner = inner.groupBy("lang", "path").agg(F.max("over").alias("over"))
    kept = best.join(inner, ["lang", "path"], "left").filter(F.col("over").isNull() | (F.col("over") < F.col("a"))).drop("over")

    spelt = kept.select("lang", "path", F.posexplode("path").alias("at", "id")).join(known.select("id", "word"), "id")
    spelt = spelt.groupBy("lang", "path").agg(F.sort_array(F.collect_list(F.struct("at", F.col("word").cast("string").alias("w")))).alias("ws"))
    spelt = spelt.select("lang", "path", F.array_join(F.col("ws.w"), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.join(spelt, ["lang", "path"]).withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
