"""Repeated passages across documents: maximal repeats from the interval tree of an enhanced suffix array."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tapewright.llm import blocks
from tapewright.llm.common import forget, map_batches, written

LENGTH = 50
# Bytes of a gram.  Every string of 50 bytes has 31 grams, of which the least in hash order is its anchor.
GRAM = 20
# Grams of all blocks that meet in one task at a time.
GROUP = 1 << 20
# Neighbouring blocks whose grams are dealt to groups together, and as many grams at most: rows are bundles times groups.
BUNDLE = 16
BUNDLED = 1 << 20
# Bytes of text whose grams are hashed at once; their arrays stay near the processor.
AT_ONCE = 1 << 16
# Segments that are compared at once.
COMPARED = 1 << 16
# Suffixes that are sorted at once.
SORTED = 1 << 17
# Rows of segments that are looked at together, and whole groups besides.
TOGETHER = 1 << 14
NO_KEY = np.iinfo(np.int64).max

_ODD = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _mixed(a: np.ndarray, b: np.ndarray, factor: np.uint64) -> np.ndarray:
    out = a * factor
    out ^= out >> np.uint64(29)
    out += b
    return out


def grams(text: bytes) -> np.ndarray:
    """A hash of the 20 bytes from each place on, by doubling: 16 bytes and 4."""
    h = np.frombuffer(text, np.uint8).astype(np.uint64) * _ODD[0]
    sizes = {1: h}
    for i, n in enumerate((1, 2, 4, 8)):
        h = _mixed(h[:-n], h[n:], _ODD[i + 1])
        sizes[2 * n] = h
    places = len(text) - GRAM + 1
    h = _mixed(sizes[16][:places], sizes[4][16:16 + places], _ODD[5])
    h ^= h >> np.uint64(32)
    h *= _ODD[1]
    return h ^ h >> np.uint64(29)


def _least(value: np.ndarray, wide: int) -> np.ndarray:
    """The place of the least of every ``wide`` neighbours, the first of those that are equal but for the bits that hold places."""
    bits = np.uint64(len(value).bit_length())
    place = (np.uint64(1) << bits) - np.uint64(1)
    value, size = value & ~place | np.arange(len(value), dtype=np.uint64), 1
    while size < wide:
        step = min(size, wide - size)
        value = np.minimum(value[step:], value[:-step])
        size += step
    return (value & place).astype(np.int64)


def anchored(texts: list[bytes], length: int = LENGTH) -> dict[str, np.ndarray]:
    """``text, hash, place, first, last``: the anchors of all texts, and the strings of ``length`` bytes that each is the anchor of.

    The anchor of a string is the least of its grams by the high bits of their
    hashes, the first of equal ones.  It follows from the string alone, so equal strings have
    equal anchors at equal places, wherever they are.  Least hashes are small,
    so ``hash`` is mixed once more, to be even in its high bits.
    """
    found = {n: [] for n in ("text", "hash", "place", "first", "last")}
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(texts):
        # Texts are looked at together, one after the other; strings that would cross from one to the next are left out.
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + AT_ONCE)))
        whole, upto = b"".join(texts[i:j]), np.cumsum(sizes[i:j])
        if len(whole) >= length:
            value = grams(whole)
            at = _least(value, length - GRAM + 1)
            owner = np.repeat(np.arange(j - i), sizes[i:j])[:len(at)]
            inside = np.flatnonzero(np.arange(len(at)) + length <= upto[owner])
            at, owner = at[inside], owner[inside]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
            starts = np.flatnonzero(new)
            before = (upto - sizes[i:j])[owner[starts]]
            for n, x in (("text", owner[starts] + i), ("hash", value[at[starts]] * _ODD[2]), ("place", at[starts] - before),
                         ("first", inside[starts] - before), ("last", inside[np.append(starts[1:], len(at)) - 1] - before)):
                found[n].append(x)
        i = j
    return {n: np.concatenate(x) if x else np.zeros(0, np.uint64 if n == "hash" else np.int64) for n, x in found.items()}


def _own_grams(own: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a block, ascending, and whether several of its texts have them."""
    order = np.argsort(own["hash"])
    value, text = own["hash"][order], own["text"][order]
    starts = np.flatnonzero(_begins(value))
    if not len(starts):
        return value, np.zeros(0, bool)
    return value[starts], np.minimum.reduceat(text, starts) != np.maximum.reduceat(text, starts)


def _begins(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for column in sorted_columns:
        differ = column[1:] != column[:-1]
        new[1:] |= differ.any(axis=1) if differ.ndim > 1 else differ
    return new


def _chosen(row: dict) -> list[bytes]:
    """The texts of a block; those that are copies of another document's are empty."""
    ours = set(row["ours"])
    return [t if i in ours else b"" for i, t in enumerate(blocks.texts_of(row["sizes"], row["texts"]))]


def _group(value: np.ndarray, groups: int) -> np.ndarray:
    return (value >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)


def _gathered(groups: int, length: int):
    """Every bundle's grams, dealt to groups by the high bits of their hashes.

    Blocks come by part.  A bundle whose blocks do not all come in a row, or
    that has too many grams, is dealt in pieces, each as a bundle would be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> pa.RecordBatch:
            every, several = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.argsort(every)
            every, several = every[order], several[order]
            starts = np.flatnonzero(_begins(every))
            # Different blocks hold different texts.
            value, count = every[starts], np.diff(np.append(starts, len(every)))
            several = (count > 1) | np.logical_or.reduceat(several, starts) if len(starts) else several
            group = _group(value, groups)
            cuts = np.flatnonzero(np.append(_begins(group), True)) if len(group) else np.zeros(1, np.int64)
            low = (value & np.uint64(0xFFFFFFFF)).astype("<u4")
            rows = [(g, *key, low[s:e].tobytes(), np.packbits(several[s:e]).tobytes())
                    for g, s, e in zip(group[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())]
            columns = list(zip(*rows)) or [()] * 5
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                   ["grp", "part", "bundle", "grams", "several"])

        for batch in batches:
            for row in batch.to_pylist():
                bundle = row["part"], row["seq"] // BUNDLE
                if held and (bundle != key or sum(len(x) for x, _ in held) > BUNDLED):
                    yield flush()
                key = bundle
                held.append(_own_grams(anchored(_chosen(row), length)))
        if held:
            yield flush()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every bundle of a group its grams that another text has too.  Rows come sorted by group."""
    key, held = None, []

    def flush() -> pa.RecordBatch:
        low = [np.frombuffer(h[2], "<u4") for h in held]
        every = np.concatenate(low)
        several = np.concatenate([np.unpackbits(np.frombuffer(h[3], np.uint8), count=len(x)) for h, x in zip(held, low)])
        order = np.argsort(every)
        new = _begins(every[order])
        starts = np.flatnonzero(new)
        many = np.diff(np.append(starts, len(every))) > 1
        shared = several > 0
        shared[order] |= many[np.cumsum(new) - 1]
        ends = np.cumsum([len(x) for x in low]).tolist()
        lists = [x[shared[e - len(x):e]].tobytes() for x, e in zip(low, ends)]
        out = pa.record_batch({
            "grp": pa.array([key] * len(held), pa.int64()), "part": pa.array([h[0] for h in held], pa.int32()),
            "bundle": pa.array([h[1] for h in held], pa.int32()), "shared": pa.array(lists, pa.binary())})
        held.clear()
        return out

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "part", "bundle", "grams", "several"))):
            if row[0] != key and held:
                yield flush()
            key = row[0]
            held.append(row[1:])
    if held:
        yield flush()


def _bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column one after the other, and where each value begins and the last ends."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _padded(data: np.ndarray, start: np.ndarray, size: np.ndarray, wide: int) -> np.ndarray:
    """Strings of some bytes as rows of equal width, with zeros behind."""
    table = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(wide, np.uint8)), wide)[start]
    table[np.arange(wide) >= size[:, None]] = 0
    return table


def _alike(gram: np.ndarray, table: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal strings of a gram are neighbours, and where each lot of them begins in it."""
    mark = gram.view(np.uint64) + size.astype(np.uint64)
    for word in table.view(np.uint64).T:
        mark = _mixed(mark, word, _ODD[1])
    order = np.argsort(mark)
    # If two lots had one mark they might come in pieces, which changes nothing.
    return order, _begins(mark[order], gram[order], size[order], table.view(np.uint64)[order])


def _width(length: int) -> int:
    """Bytes of the longest segment, a multiple of eight."""
    return 8 * -(-(2 * length - GRAM) // 8)


_SEGMENTS = "gram bigint, segment binary, least bigint, most bigint, part int, seq int, places binary"


def _segments(groups: int, length: int):
    """Around every shared anchor the segment of text that its strings cover; equal ones of a block are one row.

    ``least`` and ``most`` are the keys of its texts, ``places`` the number of
    each text and where in it the strings begin.
    """

    def rows_of(row: dict) -> Iterator[pa.RecordBatch]:
        lists = [np.frombuffer(m["shared"], "<u4") for m in row["shared"]]
        if not sum(map(len, lists)):
            return
        texts = _chosen(row)
        own = anchored(texts, length)
        known = np.repeat(np.array([m["grp"] for m in row["shared"]], np.uint64), [len(x) for x in lists]) << np.uint64(32) | np.concatenate(lists)
        known.sort()
        asked = _group(own["hash"], groups) << np.uint64(32) | own["hash"] & np.uint64(0xFFFFFFFF)
        asked = np.flatnonzero(known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked)
        whole = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        begins = np.append(0, ends[:-1])
        keys = np.array([NO_KEY if k is None else k for k in row["keys"]], np.int64)
        for i in range(0, len(asked), COMPARED):
            part = asked[i:i + COMPARED]
            text, first, gram = own["text"][part], own["first"][part], own["hash"][part].view(np.int64)
            size = own["last"][part] + length - first
            table = _padded(whole, begins[text] + first, size, _width(length))
            order, new = _alike(gram, table, size)
            starts = np.flatnonzero(new)
            rows = order[starts]
            key = keys[text][order]
            inside = np.arange(table.shape[1]) < size[rows][:, None]
            where = np.stack([text, first], axis=1).astype("<i4")[order]
            yield pa.record_batch([
                pa.array(gram[rows]), _binary(table[rows][inside], np.append(0, np.cumsum(size[rows]))),
                pa.array(np.minimum.reduceat(key, starts)), pa.array(np.maximum.reduceat(key, starts)),
                pa.array(np.full(len(rows), row["part"], np.int32)), pa.array(np.full(len(rows), row["seq"], np.int32)),
                _binary(where.reshape(-1).view(np.uint8), 8 * np.append(starts, len(order)))],
                [c.split(" ")[0] for c in _SEGMENTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for found in rows_of(row):
                    for i in range(0, found.num_rows, 20_000):
                        yield found.slice(i, 20_000)

    return run


def tree(sizes: list[int], common: list[int], least: list[int], most: list[int], before: list[int], length: int) -> Iterator[tuple[int, int, int, int]]:
    """``(size, low, high, least)`` of every maximal repeat among sorted suffixes: the interval tree, scanned with a stack.

    ``common[i]`` is how many bytes suffix i shares with the next one.  An
    interval is as long as all its suffixes agree, and cannot be longer on the
    right.  It is a maximal repeat if they do not agree on the byte before them
    either (``before``: that byte, or -1 where the suffix has none to go by),
    and if more than one text has it.
    """
    stack: list[list[int]] = []  # size, low, least, most, the byte before or -1 where they differ

    def joined(a: int, b: int, byte: int) -> None:
        top = stack[-1]
        top[2], top[3] = min(top[2], a), max(top[3], b)
        top[4] = byte if top[4] == byte else -1

    for i, size in enumerate(sizes):
        if stack and stack[-1][0] == size:
            joined(least[i], most[i], before[i])
        else:
            stack.append([size, i, least[i], most[i], before[i]])
        shared = common[i] if common[i] >= length else 0
        while stack and stack[-1][0] > shared:
            size, low, a, b, byte = stack.pop()
            if size >= length and byte < 0 and a < b:
                yield size, low, i, a
            if stack and stack[-1][0] >= shared:
                joined(a, b, byte)
            elif shared:
                stack.append([shared, low, a, b, byte])


def _suffixes(body: np.ndarray, which: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Every suffix of at least ``length`` bytes of some segments: bytes, size, segment, start, and the byte before (-1 at the start)."""
    wide = body.shape[1]
    room = wide + wide - length
    flat = np.zeros((len(body), room), np.uint8)
    flat[:, :wide] = body
    flat = flat.reshape(-1)
    count = sizes - length + 1
    row = np.repeat(np.arange(len(which)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    place = row * room + start
    table = np.lib.stride_tricks.sliding_window_view(np.append(flat, np.zeros(wide, np.uint8)), wide)[place]
    before = np.where(start > 0, flat[place - 1].astype(np.int64), -1)
    return table, sizes[row] - start, which[row], start, before


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each ``low`` to before its ``high``, one after the other, and which of these ranges each is in."""
    size = high - low
    row = np.repeat(np.arange(len(low)), size)
    return np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + low[row], row


def _united(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches that some spans of each owner cover: spans that overlap or touch are one."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    if not len(order):
        return owner, start, end
    # Owners one after the other on one line.
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(owner * far + end)
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (owner[1:] * far + start[1:] > reach[:-1])
    starts = np.flatnonzero(new)
    last = np.append(starts[1:], len(order)) - 1
    return owner[starts], start[starts], reach[last] - owner[starts] * far


def _repeats(chunk: pa.Table, length: int, names: bool) -> pa.RecordBatch | None:
    """The maximal repeats of whole groups of equal grams, for every row that holds one.

    Without names, of what all texts of a row lose only the stretches are
    given, as repeats that are older than any text.
    """
    gram, least, most = (chunk.column(c).to_numpy() for c in ("gram", "least", "most"))
    data, offsets = _bytes(chunk.column("segment"))
    table = _padded(data, offsets[:-1], np.diff(offsets), _width(length))
    order, new = _alike(gram, table, np.diff(offsets))
    starts = np.flatnonzero(new)
    of_row = np.empty(len(gram), np.int64)
    of_row[order] = np.cumsum(new) - 1
    body, sizes, its_gram = table[order[starts]], np.diff(offsets)[order[starts]], gram[order[starts]]
    low, high = np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts)
    _, group = np.unique(its_gram, return_inverse=True)
    many = np.bincount(group)
    # Segment, start, size and least of every member of every repeat.
    # A gram whose texts all go on alike has one segment, which is the repeat.
    alone = np.flatnonzero((many[group] == 1) & (low < high))
    found = [(alone, np.zeros(len(alone), np.int64), sizes[alone], low[alone])]
    rest = np.flatnonzero(many[group] > 1)
    rest = rest[np.argsort(group[rest], kind="stable")]
    ends = np.cumsum(sizes[rest] - length + 1)
    i = 0
    while i < len(rest):
        # Whole groups, as many as are sorted at once.
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SORTED)))
        j = int(np.searchsorted(group[rest], group[rest[j - 1]], "right"))
        table, size, owner, start, before = _suffixes(body[rest[i:j]], rest[i:j], sizes[rest[i:j]], length)
        # A string that one segment alone has is no repeat beyond that segment's own texts.
        words = table.view(">u8").astype(np.uint64)
        mark = group[owner].astype(np.uint64)
        for word in words[:, :length // 8].T:
            mark = _mixed(mark, word, _ODD[1])
        _, at, count = np.unique(mark, return_inverse=True, return_counts=True)
        worth = np.flatnonzero((count[at] > 1) | ((low[owner] < high[owner]) & (before < 0)))
        table, words, size, owner, start, before = (x[worth] for x in (table, words, size, owner, start, before))
        order = np.lexsort((size, *words.T[::-1], group[owner]))
        table, size, owner, start, before = table[order], size[order], owner[order], start[order], before[order]
        differ = table[1:] != table[:-1]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), table.shape[1])
        common = np.minimum(common, np.minimum(size[1:], size[:-1]))
        common[group[owner[1:]] != group[owner[:-1]]] = 0
        common = np.append(common, 0)
        # Only where neighbours agree far enough, or a suffix has several texts, is there anything to scan.
        near = common >= length
        used = near | np.append(False, near[:-1]) | ((low[owner] < high[owner]) & (before < 0))
        used = np.flatnonzero(used)
        its = list(tree(size[used].tolist(), common[used].tolist(), low[owner[used]].tolist(), high[owner[used]].tolist(), before[used].tolist(), length))
        if its:
            span, first, last, key = np.array(its, np.int64).T
            member, row = _spread(first, last + 1)
            found.append((owner[used[member]], start[used[member]], span[row], key[row]))
        i = j
    s, start, span, key = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(s, kind="stable")
    s, start, span, key = s[order], start[order], span[order], key[order]
    entry, row = _spread(np.searchsorted(s, of_row), np.searchsorted(s, of_row, "right"))
    if names:
        out = {"start": start[entry], "size": span[entry], "least": key[entry]}
    else:
        # Only what covers a text that is not the first to have it.
        keep = most[row] > key[entry]
        row, entry = row[keep], entry[keep]
        all_lose = key[entry] < least[row]
        some, older = np.flatnonzero(~all_lose), np.flatnonzero(all_lose)
        owner, a, b = _united(row[older], start[entry[older]], (start + span)[entry[older]])
        row, entry = row[some], entry[some]
        out = {"start": np.append(start[entry], a), "size": np.append(span[entry], b - a),
               "least": np.append(key[entry], np.full(len(owner), np.iinfo(np.int64).min))}
        row = np.append(row, owner)
    if not len(row):
        return None
    out = {c: pa.array(x if c == "least" else x.astype(np.int32)) for c, x in out.items()}
    out = {c: chunk.column(c).combine_chunks().take(pa.array(row)) for c in ("part", "seq", "places")} | out
    if names:
        strings = [body[x, a:a + n].tobytes() for x, a, n in zip(s[entry].tolist(), start[entry].tolist(), span[entry].tolist())]
        out["repeat"] = pa.array(strings, pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _grouped(length: int, names: bool):
    """Repeats of all groups; the rows come sorted by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held and (out := _repeats(pa.Table.from_batches(held), length, names)) is not None:
                yield out
            held.clear()

        for batch in batches:
            gram = batch.column("gram").to_numpy()
            if rows >= TOGETHER:
                # What lies before the last gram of this batch is complete.
                cut = int(np.searchsorted(gram, gram[-1]))
                if cut or held[-1].column("gram")[-1].as_py() != gram[0]:
                    held.append(batch.slice(0, cut))
                    yield from flush()
                    rows, batch = 0, batch.slice(cut)
            held.append(batch)
            rows += batch.num_rows
        yield from flush()

    return run


def _found(held: DataFrame, length: int, names: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The blocks with the texts that stand for their copies, every row's digest, the class of each digest, and the repeats."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for part, seq, keys, sizes, texts in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "keys", "sizes", "texts"))):
            its = blocks.texts_of(sizes, texts)
            rows += [(hashlib.sha256(t).digest(), k, part, seq, pos, len(t)) for pos, (k, t) in enumerate(zip(keys, its))]
        types = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["digest", "key", "part", "seq", "pos", "n_bytes"])

    said = written(map_batches(held, each, "digest binary, key bigint, part int, seq int, pos int, n_bytes bigint"), "digests")
    # Copies of a text are one class; the copy with the smallest key stands for it.
    order = F.struct(F.col("key").isNull().alias("none"), "key", "part", "seq", "pos", "n_bytes")
    firsts = written(said.groupBy("digest").agg(F.min(order).alias("f")).select("digest", "f.*"), "firsts")
    chosen = written(firsts.groupBy("part").agg(F.collect_list(F.struct("seq", "pos")).alias("firsts")), "chosen")
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0
    groups = max(1, -(-int(total) // (GROUP * (length - GRAM + 2) // 2)))

    # Of what comes to a part every block keeps its own.
    def its(list_of: str, of: Column) -> Column:
        return F.filter(list_of, lambda x: x[x_of[list_of]] == of)

    x_of = {"firsts": "seq", "shared": "bundle"}
    ours = held.join(chosen, "part").withColumn("ours", its("firsts", F.col("seq"))["pos"]).drop("firsts")
    dealt = ours.select("part", "seq", "sizes", "texts", "ours").mapInArrow(
        _gathered(groups, length), "grp bigint, part int, bundle int, grams binary, several binary")
    shared = dealt.repartition("grp").sortWithinPartitions("grp").mapInArrow(_shared, "grp bigint, part int, bundle int, shared binary")
    shared = shared.groupBy("part").agg(F.collect_list(F.struct("bundle", "grp", "shared")).alias("shared"))
    asked = ours.join(shared, "part").withColumn("shared", its("shared", F.floor(F.col("seq") / BUNDLE).cast("int")))
    segments = asked.select("part", "seq", "keys", "sizes", "texts", "ours", "shared").mapInArrow(_segments(groups, length), _SEGMENTS)
    schema = "part int, seq int, places binary, start int, size int, least bigint" + ", repeat binary" * names
    repeats = segments.repartition("gram").sortWithinPartitions("gram").mapInArrow(_grouped(length, names), schema)
    return ours, said, firsts, repeats


_REMOVED = "digest binary, n_removed bigint, n_spans bigint, kept_sha256 string"


def _removed(length: int):
    """What is removed of every text of a part, by its digest."""

    def each(key: tuple, held: pa.Table, spans: pa.Table) -> pa.Table:
        seqs = spans.column("seq").to_numpy()
        order = np.argsort(seqs, kind="stable")
        seqs, spans = seqs[order], spans.take(pa.array(order))
        rows = []
        for n in range(held.num_rows):
            row = {c: held.column(c)[n].as_py() for c in ("seq", "keys", "sizes", "texts", "ours")}
            texts = _chosen(row)
            keys = np.array([NO_KEY if k is None else k for k in row["keys"]], np.int64)
            low, high = (int(np.searchsorted(seqs, row["seq"], side)) for side in ("left", "right"))
            here = spans.slice(low, high - low)
            start, size, least = (here.column(c).to_numpy() for c in ("start", "size", "least"))
            places, offsets = _bytes(here.column("places"))
            pos, first = places.view("<i4").reshape(-1, 2).astype(np.int64).T
            its = np.repeat(np.arange(len(start)), np.diff(offsets) // 8)
            keep = least[its] < keys[pos]
            pos, first, its = pos[keep], first[keep] + start[its[keep]], its[keep]
            pos, first, last = _united(pos, first, first + size[its])
            ours = sorted(row["ours"])
            cuts = zip(np.searchsorted(pos, ours).tolist(), np.searchsorted(pos, ours, "right").tolist())
            first, last = first.tolist(), last.tolist()
            for p, (i, j) in zip(ours, cuts):
                kept = [texts[p][a:b] for a, b in zip([0, *last[i:j]], [*first[i:j], len(texts[p])])]
                rows.append((hashlib.sha256(texts[p]).digest(), sum(last[i:j]) - sum(first[i:j]), j - i, hashlib.sha256(b"".join(kept)).hexdigest()))
        types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, types)],
                        ["digest", "n_removed", "n_spans", "kept_sha256"])

    return each


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A byte goes if a string of ``length`` bytes that covers it also starts in
    a document with a smaller key.  The strings are those of the maximal
    repeats: every repeat is removed wherever its document is not the first to
    have it.

    NULL texts are empty.  A NULL key is larger than all others; rows with equal
    keys take nothing from each other.  Every row gives one, also rows that
    are alike.  An empty table gives no rows.
    """
    held = blocks.stored(docs, text, keys=F.col(key).cast("bigint"))
    ours, said, firsts, repeats = _found(held, length, False)
    rows = ours.select("part", "seq", "keys", "sizes", "texts", "ours").groupBy("part")
    done = rows.cogroup(repeats.groupBy("part")).applyInArrow(_removed(length), _REMOVED)
    done = written(done, "removed")
    forget(held)
    classes = firsts.select("digest", F.col("key").alias("first")).join(done, "digest")
    # A copy of a document with a smaller key goes whole; a short one has nothing that could be removed.
    copy = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first")) & (F.col("n_bytes") >= length)
    return said.join(classes, "digest").select(
        F.col("key").alias("doc_id"), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("bigint").alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``repeat, size, first, doc_id, start``: every occurrence of every maximal repeat, in the text that stands for its copies.

    A repeat is a string of at least ``length`` bytes that several different
    texts have; it is in no longer one at all of its occurrences, as far as an
    anchor reaches (``2 * length - 20`` bytes): a longer repeat is a chain of
    repeats that overlap by ``length - 1`` bytes or more.  ``first`` is the smallest key that has it.
    """
    held = blocks.stored(docs, text, keys=F.col(key).cast("bigint"))
    _, _, firsts, found = _found(held, length, True)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        places = [np.frombuffer(p, "<i4").reshape(-1, 2) for p in batch.column("places").to_pylist()]
        row = np.repeat(np.arange(len(places)), [len(p) for p in places])
        every = np.concatenate(places)
        out = {c: batch.column(c).take(pa.array(row)) for c in ("repeat", "size", "least", "part", "seq")}
        start = every[:, 1] + batch.column("start").to_numpy()[row]
        return pa.RecordBatch.from_pydict(out | {"pos": pa.array(every[:, 0], pa.int32()), "start": pa.array(start, pa.int32())})

    rows = map_batches(found, each, "repeat binary, size int, least bigint, part int, seq int, pos int, start int")
    met = rows.join(firsts.select("part", "seq", "pos", F.col("key").alias("doc_id")), ["part", "seq", "pos"])
    return met.select("repeat", "size", F.nullif("least", F.lit(NO_KEY)).alias("first"), "doc_id", "start")
