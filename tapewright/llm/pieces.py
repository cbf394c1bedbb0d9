"""N-best segmentation into the pieces of a SentencePiece model, and the way back."""

from __future__ import annotations

import dataclasses
import functools
import heapq
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

# The sign for a space in pieces; where a text has it literally it is this number, which no character has.
SPACE, LITERAL = "▁", 0x110000
# Segments up to this length go through the lattice many at a time, longer ones alone.
SHORT = 48
# A character without a piece is spelt in bytes and costs this much more than the dearest piece.
PENALTY = 10.0
# Scores below this mark pieces that the model itself never makes.
NEVER = -1e8
# Segments never reach over a space that follows something else: no piece does.
SEGMENT = re.compile(r" *[^ ]+| +")
HEAD = np.uint64(44)
ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclasses.dataclass(frozen=True)
class Model:
    """Pieces by their code points, and by a hash of those for whole arrays."""

    scores: dict[tuple[int, ...], tuple[float, int]]
    longest: int
    maybe: np.ndarray
    hashes: np.ndarray
    by_hash: np.ndarray
    values: np.ndarray
    texts: list[bytes | None]
    byte_ids: np.ndarray
    unknown: float


@functools.cache
def model(path: str | None = None) -> Model:
    """The model of a file, once per process."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    scores, texts, byte_ids = {}, [], np.zeros(256, np.int64)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            texts.append(bytes([int(piece[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(None)
        else:
            if re.search(f"[^{SPACE}]{SPACE}", piece):
                raise ValueError("a piece reaches over a space inside")
            scores[tuple(map(ord, piece))] = (sp.get_score(i), i)
            texts.append(piece.replace(SPACE, " ").encode())
    longest = max(map(len, scores))
    hashed = np.array([_hash(np.array([k], np.uint64))[0] for k in scores], np.uint64)
    order = np.argsort(hashed)
    values, ids = np.array([s for s, _ in scores.values()]), np.array([i for _, i in scores.values()])
    if len(np.unique(hashed)) < len(hashed):
        raise ValueError("two pieces share a hash")
    # Whether any piece's hash begins with these 20 bits: most stretches of text are ruled out here.
    maybe = np.zeros(1 << 20, bool)
    maybe[hashed >> HEAD] = True
    return Model(scores, longest, maybe, hashed[order], ids[order], values[order], texts, byte_ids,
                 values[values > NEVER].min() - PENALTY)


def _hash(codes: np.ndarray) -> np.ndarray:
    """One number per row of code points, the same for a row wherever it lies in a longer one."""
    out = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        out = _step(out, codes[:, k])
    return out


def _step(out: np.ndarray, code: np.ndarray) -> np.ndarray:
    mixed = (out ^ (code.astype(np.uint64) + np.uint64(1))) * ODD
    return mixed ^ (mixed >> np.uint64(29))


def segments(text: str) -> list[str]:
    """The text with one space in front, cut before each space that follows something else."""
    return SEGMENT.findall(" " + text)


def codes_of(segment: str) -> np.ndarray:
    """Code points, spaces as the sign for them."""
    codes = np.frombuffer(segment.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes[codes == ord(SPACE)] = LITERAL
    codes[codes == 32] = ord(SPACE)
    return codes


# A segment's ways: (score, edges); an edge is an id, or minus one minus a code point that is spelt in bytes.
Way = tuple[float, tuple[int, ...]]


def edges(m: Model, codes: Sequence[int], end: int) -> Iterator[tuple[int, float, int]]:
    """(start, score, edge) of the pieces that end there, the longest last."""
    for start in range(end - 1, max(-1, end - m.longest - 1), -1):
        known = m.scores.get(tuple(codes[start:end]))
        if known:
            yield start, *known
        elif start == end - 1:
            yield start, m.unknown, -1 - codes[start]


def forward(m: Model, codes: Sequence[int]) -> list[float]:
    """The best score from the start to each place (Viterbi)."""
    best = [0.0]
    for end in range(1, len(codes) + 1):
        best.append(max(best[s] + score for s, score, _ in edges(m, codes, end)))
    return best


def n_best(m: Model, codes: Sequence[int], n: int) -> list[Way]:
    """The ``n`` best ways through the lattice, by A-star from the end to the start.

    The forward scores are exactly what is still to come, so no step is taken
    that is not on one of the best ways.  Of equal scores the way with the
    shorter last piece comes first, then with the shorter one before it, and so
    on, which is the way the forward pass takes too.
    """
    best = forward(m, codes)
    found: list[Way] = []
    # (minus the score of the best way through, order, place, score behind, edges behind)
    heap: list[tuple[float, int, int, float, tuple]] = [(-best[-1], 0, len(codes), 0.0, ())]
    count = 0
    while heap and len(found) < n:
        _, _, at, behind, ways = heapq.heappop(heap)
        if not at:
            out = []
            while ways:
                edge, ways = ways
                out.append(edge)
            found.append((behind, tuple(out)))
            continue
        # The last to come is the first to go among equals: the shortest piece.
        for start, score, edge in reversed(list(edges(m, codes, at))):
            count -= 1
            total = behind + score
            heapq.heappush(heap, (-(total + best[start]), count, start, total, (edge, ways)))
    return found


def two_best(m: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Best and second-best score of many segments of one length, and the edges of their best ways."""
    rows, n = codes.shape
    first, second = np.full((rows, n + 1), -np.inf), np.full((rows, n + 1), -np.inf)
    first[:, 0] = 0
    back, taken = np.zeros((rows, n + 1), np.int64), np.zeros((rows, n + 1), np.int64)
    hashes: list[np.ndarray] = []  # of the stretch from each place to here
    for end in range(1, n + 1):
        hashes = [_step(h, codes[:, end - 1]) for h in hashes[-(m.longest - 1):]]
        hashes.append(_step(np.zeros(rows, np.uint64), codes[:, end - 1]))
        for size, h in enumerate(reversed(hashes), 1):
            if size == 1:
                at = np.minimum(np.searchsorted(m.hashes, h), len(m.hashes) - 1)
                known = m.hashes[at] == h
                score = np.where(known, m.values[at], m.unknown)
                first[:, end], second[:, end] = first[:, end - 1] + score, second[:, end - 1] + score
                taken[:, end] = np.where(known, m.by_hash[at], -1 - codes[:, end - 1])
                back[:, end] = 1
                continue
            r = np.flatnonzero(m.maybe[h >> HEAD])
            at = np.minimum(np.searchsorted(m.hashes, h[r]), len(m.hashes) - 1)
            known = m.hashes[at] == h[r]
            r, at = r[known], at[known]
            if not len(r):
                continue
            one, two, old = first[r, end - size] + m.values[at], second[r, end - size] + m.values[at], first[r, end]
            better = one > old
            second[r, end] = np.maximum(np.maximum(second[r, end], two), np.minimum(one, old))
            w = r[better]
            first[w, end], back[w, end], taken[w, end] = one[better], size, m.by_hash[at[better]]
    at, steps = np.full(rows, n), []
    while (at > 0).any():
        steps.append(np.where(at > 0, taken[np.arange(rows), at], np.iinfo(np.int64).min))
        at = np.maximum(at - back[np.arange(rows), at], 0)
    return first[:, n], second[:, n], steps[::-1]


@dataclasses.dataclass
class Ways:
    """Best ways of distinct segments: scores, and edges of segment ``i`` at ``starts[i]`` and on."""

    score: np.ndarray
    second: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    flat: np.ndarray


def ways_of(m: Model, distinct: Sequence[str]) -> Ways:
    lengths = np.array([len(s) for s in distinct])
    codes, first = codes_of("".join(distinct)), np.cumsum(lengths) - lengths
    score, second = np.zeros(len(distinct)), np.full(len(distinct), -np.inf)
    parts, owners = [], []
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        if n > SHORT:
            for i in at:
                best = n_best(m, codes[first[i]:first[i] + n].tolist(), 2)
                score[i], second[i] = best[0][0], best[1][0] if len(best) > 1 else -np.inf
                parts.append(np.array(best[0][1], np.int64))
                owners.append(np.full(len(parts[-1]), i))
            continue
        score[at], second[at], steps = two_best(m, codes[first[at][:, None] + np.arange(n)])
        grid = np.stack(steps, 1)
        # Ways are filled from the end, so the blanks are in front.
        real = grid != np.iinfo(np.int64).min
        parts.append(grid[real])
        owners.append(np.repeat(at, real.sum(1)))
    owner, flat = np.concatenate(owners), np.concatenate(parts)
    order = np.argsort(owner, kind="stable")
    flat = flat[order]
    sizes = np.bincount(owner, minlength=len(distinct))
    return Ways(score, second, np.cumsum(sizes) - sizes, sizes, flat)


def spelt(m: Model, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of edges, with the characters without a piece in bytes, and the number of ids per edge."""
    counts = np.ones(len(flat), np.int64)
    odd = np.unique(flat[flat < 0])
    spellings = {}
    for edge in odd.tolist():
        code = -1 - edge
        raw = (SPACE if code == LITERAL else chr(code)).encode("utf-8", "surrogatepass")
        spellings[edge] = m.byte_ids[list(raw)]
        counts[flat == edge] = len(raw)
    ids = np.repeat(flat, counts)
    first = np.cumsum(counts) - counts
    for edge, spelling in spellings.items():
        places = first[flat == edge]
        for k, i in enumerate(spelling):
            ids[places + k] = i
    return ids, counts


def combined(lists: Sequence[Sequence[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best sums of one score from each list (each list is in descending order)."""
    start = (0,) * len(lists)
    heap, seen, found = [(-sum(x[0] for x in lists), start)], {start}, []
    while heap and len(found) < n:
        total, at = heapq.heappop(heap)
        found.append((-total, at))
        for k, i in enumerate(at):
            if i + 1 < len(lists[k]):
                following = (*at[:k], i + 1, *at[k + 1:])
                if following not in seen:
                    seen.add(following)
                    heapq.heappush(heap, (total + lists[k][i] - lists[k][i + 1], following))
    return found


def encode(
    docs: DataFrame, n: int = 4, path: str | None = None, key: str = "doc_id", text: str = "text", at_once: int = 1 << 23,
    proof: bool = False,
) -> DataFrame:
    """``doc_id, rank, score, ids`` of the ``n`` best segmentations of every whole text.

    The score of a segmentation is the sum of its pieces' scores.  No piece
    reaches over the start of a word, so the lattice of a text is a chain of
    small ones: forward scores are computed once per distinct word of a batch,
    and the next-best ways can differ from the best only in the ``n - 1`` words
    that lose the least by their second way.  Those words are searched from the
    end, and their ways are combined.  ``ids`` are unsigned little-endian
    32-bit numbers.  About ``at_once`` characters are looked at together.
    ``proof`` adds, to a text's first way, the checksums of the text and of what the ids decode to.

    A text has fewer segmentations than ``n`` if its lattice has; a NULL or
    empty text has the one of the space in front.  Of equal scores the earlier
    word changes first.  Each row is its own, also repeated ones; no rows give
    no rows.
    """
    if n < 1:
        raise ValueError("n counts from one")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)

        @functools.lru_cache(50_000)
        def ways(segment: str) -> list[Way]:
            return n_best(m, codes_of(segment).tolist(), n)

        held, chars = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                held.append(part)
                chars += sum(len(t.as_py()) for t in part.column(1) if t.is_valid)
                if chars >= at_once:
                    yield _encoded(m, ways, held, n, proof)
                    held, chars = [], 0
        if held:
            yield _encoded(m, ways, held, n, proof)

    return docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(
        run, "doc_id bigint, rank int, score double, ids binary" + ", text_crc32 bigint, decoded_crc32 bigint" * proof)


def _encoded(m: Model, ways, batches: Sequence[pa.RecordBatch], n: int, proof: bool) -> pa.RecordBatch:
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(s, len(index)) for s in segments(t.as_py() or "")]) for b in batches for t in b.column(1)]
    keys = [k for b in batches for k in b.column(0).to_pylist()]
    distinct = list(index)
    known = ways_of(m, distinct)
    loss = known.score - known.second
    # Ids of the best way of each distinct segment, one after the other.
    flat, counts = spelt(m, known.flat)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    start, stop = bounds[known.starts], bounds[known.starts + known.sizes]
    out: list[tuple] = []
    for key, doc in zip(keys, docs):
        size = stop[doc] - start[doc]
        ends = np.cumsum(size)
        ids = flat[np.repeat(start[doc] - (ends - size), size) + np.arange(ends[-1])].astype("<u4")
        lost = loss[doc]
        open_ = np.flatnonzero(np.isfinite(lost))
        picked = np.sort(open_[np.argsort(lost[open_], kind="stable")[:n - 1]])
        choices = [ways(distinct[doc[p]]) for p in picked]
        rest = float(known.score[doc].sum()) - float(known.score[doc[picked]].sum())
        for rank, (total, at) in enumerate(combined([[w[0] for w in c] for c in choices], n), 1):
            parts, done = [], 0
            for p, c, i in zip(picked, choices, at):
                # Of equally good ways the search may put another first than the forward pass took.
                parts += [ids[done:ends[p] - size[p]], spelt(m, np.array(c[i][1]))[0].astype("<u4")]
                done = ends[p]
            out.append((key, rank, rest + total, b"".join(x.tobytes() for x in [*parts, ids[done:]])))
    owners, ranks, scores, ids = zip(*out)
    columns = {
        "doc_id": pa.array(owners, pa.int64()), "rank": pa.array(ranks, pa.int32()),
        "score": pa.array(scores, pa.float64()), "ids": pa.array(ids, pa.binary())}
    if proof:
        # The bytes of all pieces but the space in front: checked as they are, whether they are a text or not.
        spelling = [t or b"" for t in m.texts].__getitem__
        texts = (zlib.crc32((t.as_py() or "").encode()) for b in batches for t in b.column(1))
        first = [rank == 1 for rank in ranks]
        columns["text_crc32"] = pa.array([next(texts) if one else None for one in first], pa.int64())
        columns["decoded_crc32"] = pa.array([
            zlib.crc32(b"".join(map(spelling, np.frombuffer(x, "<u4").tolist()))[1:]) if one else None for one, x in zip(first, ids)], pa.int64())
    return pa.record_batch(columns)


def decoded(m: Model, ids: Sequence[int]) -> str:
    """The text of ids; control pieces have none, and the space in front goes."""
    return b"".join(m.texts[i] or b"" for i in ids).decode("utf-8", "replace")[1:]


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """The rows with their ``text``; a NULL column of ids gives NULL, an input column ``text`` gives way."""
    kept = [c for c in encoded.columns if c.lower() != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = [None if x.as_py() is None else decoded(m, np.frombuffer(x.as_py(), "<u4").tolist()) for x in batch.column(ids)]
            yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, "text"])

    schema = encoded.select(*kept).schema
    schema = type(schema)(list(schema.fields))
    return encoded.mapInArrow(run, schema.add("text", "string"))
