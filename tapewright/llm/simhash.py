"""SimHash near-duplicates, found through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tapewright.llm.common import ROW, map_batches, placed, seeded, selected, written
from tapewright.llm.components import components

SHINGLE = 3
DISTANCE = 3
# Reference fingerprints of two neighbouring bits each.  With the zero word their distances give 32 coordinates from 0
# to 2, of which two fingerprints that differ in at most three bits share all but three: in five blocks, two agree.
PAIRS = [3 << b for b in range(0, 64, 2)]
BLOCKS = 5
# Large buckets are dealt out by the reference fingerprints of one bit: two of five blocks and three of six of the rest.
FINER = 6
# Larger buckets are split by further blocks.
BUCKET = 4096
# Runs up to this length are compared place by place, all runs of a batch at once.
SHORT = 32
# Reference fingerprints at large; one byte of the table for each.
PIVOTS = [seeded("pivot", i) for i in range(16)]
SEED = 42


def fingerprint(text: bytes | None) -> int:
    """A bit is set if it is in more than half of the shingles' hashes; no words: zero."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = SHINGLE - 1
    pairs = zip(starts[:-last].tolist(), ends[last:].tolist()) if len(words) >= SHINGLE else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in pairs], "<u8")
    counts = sum(
        np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        for part in np.array_split(hashes, -(-len(hashes) // 65536))
    )
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def prints_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the fingerprint."""
    schema = "doc_id bigint, fp bigint"

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
        return pa.record_batch([batch.column(0), prints], ["doc_id", "fp"])

    return map_batches(docs.select(F.col(key).cast("bigint"), F.col(text).cast("binary")), each, schema)


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def _masks(words: list[int], blocks: int, equal: int) -> list[int]:
    """One mask per choice of ``equal`` of the blocks into which the words are cut."""
    cut = [sum(words[i] for i in part.tolist()) for part in np.array_split(np.arange(len(words)), blocks)]
    return [reduce(add, chosen) for chosen in combinations(cut, equal)]


def coordinates(fp: Column) -> Column:
    """Half of what the distances to the zero word and to each of ``PAIRS`` differ by, plus one: two bits for each.

    That is how many of the pair's two bits are set.
    """
    every = F.lit(_signed(sum(w // 3 for w in PAIRS)))
    one, other = fp.bitwiseAND(every), F.shiftrightunsigned(fp, 1).bitwiseAND(every)
    return one.bitwiseXOR(other).bitwiseOR(F.shiftleft(one.bitwiseAND(other), 1))


def _keyed(prints: DataFrame, word: Column, masks: list[int]) -> DataFrame:
    """Each row once per mask, under the part of the word that the mask selects."""
    keys = [F.struct(F.lit(i).alias("t"), word.bitwiseAND(F.lit(_signed(m))).alias("k")) for i, m in enumerate(masks)]
    return prints.select("fp", "near", "far", F.inline(F.array(*keys)))


def _table(pivots: list[int]) -> Column:
    """Distances to eight reference fingerprints, a byte each."""
    distance = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("bigint") for p in pivots]
    return reduce(add, [F.shiftleft(d, 8 * i) for i, d in enumerate(distance)])


def _close(fps: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray | int) -> np.ndarray:
    """Which pairs link: no coordinate differs by more than the distance, and neither do the fingerprints."""
    apart = np.abs(table[i].astype(np.int16) - table[j].astype(np.int16)).max(axis=1)
    close = apart <= DISTANCE
    i = i[close]
    j = j[close] if isinstance(j, np.ndarray) else j
    # Unsigned: numpy counts the bits of a negative number's absolute value.
    close[close] = np.bitwise_count((fps[i] ^ fps[j]).view(np.uint64)) <= DISTANCE
    return close


def _spread(fps: np.ndarray, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whatever is connected in one bucket.

    Whoever is reached leaves the rest, so a dense bucket is walked in few
    steps and gives a link per fingerprint, not one per pair.
    """
    rest = np.arange(len(fps))
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            hit = _close(fps, table, rest, int(at))
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                yield np.full(len(found), fps[at]), fps[found]
                reached.extend(found.tolist())


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal keys; the rows come sorted by key."""

    def found(part: pa.Table) -> pa.RecordBatch | None:
        t, k, fps = (part.column(c).to_numpy() for c in ("t", "k", "fp"))
        table = np.ascontiguousarray(np.stack([part.column("near").to_numpy(), part.column("far").to_numpy()], 1)).view(np.uint8)
        first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])]))
        sizes = np.diff(np.append(first, len(fps)))
        run = np.repeat(np.arange(len(sizes)), sizes)
        short = (sizes <= SHORT)[run]
        pairs = []
        for lag in range(1, int(sizes[sizes <= SHORT].max(initial=1))):
            i = np.flatnonzero((run[:-lag] == run[lag:]) & short[:-lag])
            i = i[_close(fps, table, i, i + lag)]
            pairs.append((fps[i], fps[i + lag]))
        for start, size in zip(first[sizes > SHORT], sizes[sizes > SHORT]):
            pairs.extend(_spread(fps[start:start + size], table[start:start + size]))
        if not pairs:
            return None
        a, b = (np.concatenate(x) for x in zip(*pairs))
        return pa.record_batch({"a": a, "b": b})

    held: list[pa.RecordBatch] = []
    for batch in batches:
        t, k = batch.column("t").to_numpy(), batch.column("k").to_numpy()
        # What lies before the last run of this batch is complete.
        cut = int(np.flatnonzero((t != t[-1]) | (k != k[-1])).max(initial=-1)) + 1
        if cut:
            whole = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
            if (out := found(whole)) is not None:
                yield out
        elif held:
            last = held[-1]
            if (last.column("t")[-1].as_py(), last.column("k")[-1].as_py()) != (t[0], k[0]):
                if (out := found(pa.Table.from_batches(held).combine_chunks())) is not None:
                    yield out
                held = []
        held.append(batch.slice(cut))
    if held and (out := found(pa.Table.from_batches(held).combine_chunks())) is not None:
        yield out


def _linked(keyed: DataFrame) -> DataFrame:
    return keyed.repartition("t", "k").sortWithinPartitions("t", "k").mapInArrow(_links, "a bigint, b bigint")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links between distinct fingerprints (``fp``): enough to connect all that lie within the distance.

    Distances to the reference fingerprints decide who meets: close ones share
    the coordinates of two of five blocks of ``PAIRS``.  The fingerprints of
    buckets above ``bucket`` rows are dealt out anew under the coordinates of
    one-bit references, which leave 19 bits or 20 to differ, so no bucket of
    those ever holds more than 2^20 fingerprints.  In a bucket the distances to
    ``PIVOTS`` discard pairs by their largest difference, and the fingerprints
    verify the rest.
    """
    prints = prints.select("fp", _table(PIVOTS[:8]).alias("near"), _table(PIVOTS[8:]).alias("far"))
    equal = BLOCKS - DISTANCE
    keyed = _keyed(prints, coordinates(F.col("fp")), _masks(PAIRS, BLOCKS, equal))
    large = written(keyed.groupBy("t", "k").count().filter(F.col("count") > bucket).select("t", "k"), "buckets")
    plain = keyed.join(large, ["t", "k"], "left_anti")
    crowded = keyed.join(large, ["t", "k"], "left_semi").select("fp", "near", "far").distinct()
    bits = [1 << b for b in range(64)]
    finer = []
    for mask in _masks(bits, BLOCKS, equal):
        finer += [mask | more for more in _masks([b for b in bits if not mask & b], FINER, FINER - DISTANCE)]
    return _linked(plain).union(_linked(_keyed(crowded, F.col("fp"), finer)))


def _grouped(prints: DataFrame, first: Column) -> DataFrame:
    """``fp, component_id``: the smallest ``first`` of all fingerprints reachable from each."""
    classes = written(prints.groupBy("fp").agg(first.alias("first")), "fingerprints")
    roots = components(links(classes)).withColumnRenamed("node", "fp")
    met = classes.join(roots, "fp")
    least = met.groupBy("root").agg(F.min("first").alias("component_id"))
    reached = met.join(least, "root").select("fp", "component_id")
    return classes.join(reached, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id"), "first")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Copies share a fingerprint and are one class, so only distinct fingerprints
    are ever compared.  NULL, empty and wordless texts have the fingerprint
    zero and link like any other.  A NULL key never becomes a component's id
    unless the component has no other.  An empty table gives no rows.
    """
    prints = written(prints_of(docs, key, text), "prints")
    # Written, so that both sides of the last join are plain exchanges and Spark can split a fingerprint of many copies.
    grouped = written(_grouped(prints, F.min("doc_id")), "groups")
    return prints.join(grouped, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest key.

    Rows with equal keys are told apart by a hash of their texts; of rows that
    are alike in both, one stays.  A NULL key comes last.  Copies of a fingerprint are reduced inside the
    map tasks; no text crosses an exchange.
    """
    rows = placed(docs)
    id_, string = F.col(ROW).getField(key), F.col(ROW).getField(text)
    order = F.struct(id_.isNull().alias("none"), id_.cast("bigint").alias("id"), F.xxhash64(string).alias("text"), "part", "pos")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = pa.array([fingerprint(t.as_py()) for t in batch.column("text")], pa.int64())
        return pa.record_batch([batch.column("o"), prints], ["o", "fp"])

    narrow = rows.select(order.alias("o"), string.cast("binary").alias("text"))
    schema = narrow.select("o", F.lit(0).cast("bigint").alias("fp")).schema
    prints = written(map_batches(narrow, each, schema), "prints")
    firsts = _grouped(prints, F.min("o")).select("component_id.part", "component_id.pos").distinct()
    return selected(rows, prints.select("o.part", "o.pos"), firsts)
