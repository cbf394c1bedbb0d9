"""Perplexity under an interpolated modified Kneser-Ney model of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tapewright.llm.common import ROW, map_batches, written

# Four symbols of 16 bits fill a long: grams, their contexts and their suffixes are shifts and masks of it.
ORDER = 4
SYMBOL = 16
# Bytes of text per scoring batch: the wider, the fewer grams are looked up twice.
BATCH = 12 << 20
# Trusted ids are broadcast up to this number (32 MB), so that no text moves, and joined beyond it.  The rows are the same.
BROADCAST_IDS = 4_000_000
# Characters of a window; windows overlap by half.
WINDOW = 24
# Characters whose grams a task holds at once.
CHARS = 1 << 19
# Scored rows that leave Python at once.
ROWS_BACK = 256


def symbols(text: str | None) -> np.ndarray:
    """Code points, those beyond 16 bits as one symbol, after a start of zeros."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate([np.zeros(ORDER - 1, np.uint64), np.minimum(points, 0xFFFF).astype(np.uint64)])


def grams_of(text: str | None) -> np.ndarray:
    """The gram that ends at each character of the text."""
    s = symbols(text)
    n = len(s) - (ORDER - 1)
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out = out << np.uint64(SYMBOL) | s[k:k + n]
    return out.view(np.int64)


def _tail(gram: Column, n: int) -> Column:
    return gram if n == ORDER else gram.bitwiseAND(F.lit((1 << SYMBOL * n) - 1))


def _context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, SYMBOL)


def _parts(texts: Iterator[str | None]) -> Iterator[np.ndarray]:
    """Grams of the texts, in parts of a bounded size; one text is never split."""
    held, size = [], 0
    for text in texts:
        held.append(grams_of(text))
        size += len(held[-1])
        if size >= CHARS:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def _unpacked(column: pa.Array | pa.ChunkedArray) -> Iterator[str | None]:
    grow = zstandard.ZstdDecompressor().decompress
    for raw in column:
        yield grow(raw.as_py()).decode() if raw.is_valid else None


def _merged(a: tuple[np.ndarray, np.ndarray] | None, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g, n = np.unique(grams, return_counts=True)
    if a is None:
        return g, n
    every, at = np.unique(np.concatenate([a[0], g]), return_inverse=True)
    return every, np.bincount(at, weights=np.concatenate([a[1], n])).astype(np.int64)


def _counted(texts: DataFrame) -> DataFrame:
    """Grams of the trusted texts with their counts: added up per task, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in _parts(t.as_py() for b in batches for t in b.column(0)):
            total = _merged(total, part)
            if len(total[0]) >= CHARS:
                yield pa.record_batch({"g": total[0], "c": total[1]})
                total = None
        if total is not None:
            yield pa.record_batch({"g": total[0], "c": total[1]})

    return texts.mapInArrow(run, "g bigint, c bigint").groupBy("g").agg(F.sum("c").alias("c"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What a count of one, of two, and of three or more gives up.

    From the numbers of grams counted one to four times; a small table that
    lacks one of them takes the middle of the range instead.
    """
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), k - 0.1) for k, d in enumerate(found, 1)]


def train(texts: DataFrame) -> DataFrame:
    """The model of a one-column frame of texts: ``n, g, p, bow`` per gram.

    ``p`` is the interpolated probability of a gram's last symbol after the
    others; ``bow`` is the weight a shorter context gets where the gram is the
    context.  The row of ``n`` 0 has the probability of an unseen symbol.  The
    top order has counts, lower ones the number of different symbols before.
    No text at all gives that row only.
    """
    tables = {ORDER: written(_counted(texts), "grams")}
    for n in range(ORDER - 1, 0, -1):
        shorter = tables[n + 1].groupBy(_tail(F.col("g"), n).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        tables[n] = written(shorter, "grams")
    tallies = reduce(DataFrame.union, [
        t.agg(F.lit(n), F.sum("c"), *[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)], F.count(F.lit(1)))
        for n, t in tables.items()])
    tally = {r[0]: [x or 0 for x in r[1:]] for r in tallies.collect()}
    give = {n: discounts(*x[1:5]) for n, x in tally.items()}

    def given(n: int) -> Column:
        d1, d2, d3 = give[n]
        return F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(F.lit(d3))

    total, n1, n2, _, _, kinds = tally[1]
    left = sum(d * k for d, k in zip(give[1], (n1, n2, kinds - n1 - n2))) / total if total else 1.0
    unseen = left / (kinds + 1)
    model = tables[1].select("g", ((F.col("c") - given(1)) / F.lit(float(total or 1)) + unseen).alias("p"))
    levels = [model]
    weights = []
    for n in range(2, ORDER + 1):
        seen = tables[n].select("g", "c", _context(F.col("g")).alias("context"), _tail(F.col("g"), n - 1).alias("tail"), given(n).alias("d"))
        contexts = seen.groupBy("context").agg(F.sum("c").alias("s"), (F.sum("d") / F.sum("c")).alias("bow"))
        weights.append(contexts.select(F.col("context").alias("g"), "bow"))
        below = levels[-1].select(F.col("g").alias("tail"), F.col("p").alias("lower"))
        grown = seen.join(contexts, "context").join(below, "tail")
        p = (F.col("c") - F.col("d")) / F.col("s") + F.col("bow") * F.col("lower")
        levels.append(grown.select("g", p.alias("p")))
    rows = []
    for n, level in enumerate(levels, 1):
        # The start of a text is a context, though no gram ends in it.
        full = level.join(weights[n - 1], "g", "full") if n < ORDER else level.withColumn("bow", F.lit(None).cast("double"))
        rows.append(full.select(F.lit(n).alias("n"), "g", "p", "bow"))
    floor = texts.sparkSession.range(1).select(F.lit(0), F.lit(0).cast("bigint"), F.lit(unseen), F.lit(1.0))
    return written(reduce(DataFrame.union, rows).union(floor), "model")


def _log_p(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``g, logp`` of distinct grams: every gram asks for its longer suffixes and contexts in one join.

    The row of order 0 is one number, and those of order 1 are as many as there
    are symbols, 65,536 at most, so both are at hand in every task: what all
    grams ask for is never a key of an exchange.
    """
    g = F.col("g")
    floor = model.filter("n = 0").first()["p"]
    single = F.broadcast(model.filter("n = 1").select(F.col("g").alias("one"), F.col("p").alias("p1"), F.col("bow").alias("w2")))
    asked = [(f"p{n}", n, _tail(g, n)) for n in range(2, ORDER + 1)]
    asked += [(f"w{n}", n - 1, _context(_tail(g, n))) for n in range(3, ORDER + 1)]
    rows = grams.select("g", F.inline(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(n).alias("n"), key.alias("key")) for role, n, key in asked])))
    # A gram that the model does not have at any order is still one.
    met = rows.join(model.filter("n > 1").withColumnRenamed("g", "key"), ["n", "key"], "left")
    got = met.groupBy("g").agg(*[
        F.max(F.when(F.col("role") == role, F.col("p" if role[0] == "p" else "bow"))).alias(role) for role, _, _ in asked])
    got = got.withColumns({"_last": _tail(g, 1), "_before": _context(_tail(g, 2))})
    got = got.join(single.select(F.col("one").alias("_last"), "p1"), "_last", "left")
    got = got.join(single.select(F.col("one").alias("_before"), "w2"), "_before", "left")
    p = F.lit(floor)
    for n in range(1, ORDER + 1):
        lower = p if n == 1 else F.coalesce(F.col(f"w{n}"), F.lit(1.0)) * p
        p = F.coalesce(F.col(f"p{n}"), lower)
    return got.select("g", F.log(p).alias("logp"))


def _worst(values: np.ndarray, sizes: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """The largest mean surprise of any window of each text; a text that is shorter is one window."""
    upto = np.concatenate([[0.0], np.cumsum(-values)])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    steps = np.maximum(1, -(-(sizes - width) // (width // 2)) + 1)
    owner = np.repeat(np.arange(len(sizes)), steps)
    at = starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps)) * (width // 2)
    at = np.maximum(starts[owner], np.minimum(at, ends[owner] - width))
    until = np.minimum(at + width, ends[owner])
    mean = (upto[until] - upto[at]) / np.maximum(until - at, 1)
    return np.maximum.reduceat(mean, np.cumsum(steps) - steps)


def scored(
    docs: DataFrame, model: DataFrame, columns: Sequence[str], key: str = "doc_id", text: str = "text", batch: int = BATCH,
) -> DataFrame:
    """The named columns in a struct (the text, if named, beside it), with ``n_scored`` characters, their
    ``perplexity``, and that of the ``worst`` window (NULL where there is none).

    Texts cross one exchange, compressed, into batches of about ``batch`` bytes.  A batch sends each of
    its grams once to the shards of the model and gets its probability back,
    so the model is never held whole anywhere and common grams are not sent
    per document.
    """
    parts = max(1, -(-int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // batch))
    others = [F.col(f"`{c}`") for c in columns if c != text]
    part = F.pmod(F.xxhash64(key, text), F.lit(parts))
    rows = docs.select(F.struct(*others).alias(ROW), F.col(text).cast("string").alias("text"), part.alias("part"))
    packed = T.StructType([rows.schema[ROW], T.StructField("packed", T.BinaryType()), rows.schema["part"]])

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        texts = [squeeze(t.as_py().encode()) if t.is_valid else None for t in batch.column("text")]
        return pa.record_batch([batch.column(ROW), pa.array(texts, pa.binary()), batch.column("part")], packed.names)

    dealt = map_batches(rows, pack, packed).repartition("part")
    keeps = text in columns
    passed = [ROW, *["text"] * keeps]

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            column = b.column("part").to_numpy()
            for part in np.unique(column):
                for grams in _parts(_unpacked(b.column("packed").filter(pa.array(column == part)))):
                    held[part] = np.union1d(held.get(part, grams[:0]), grams)
        for part, grams in held.items():
            yield pa.record_batch({"part": np.full(len(grams), part, np.int64), "g": grams})

    pairs = dealt.mapInArrow(distinct, "part bigint, g bigint").repartition("g")
    # The count keeps both columns, so that this and the join share one exchange.
    once = pairs.groupBy("g").agg(F.count("part").alias("n")).filter("n > 0")
    known = pairs.join(_log_p(once, model), "g").select("part", "g", "logp")

    schema = T.StructType([*[rows.schema[c] for c in passed], T.StructField("n_scored", T.LongType()),
                            T.StructField("perplexity", T.DoubleType()), T.StructField("worst", T.DoubleType())])

    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("g").to_numpy())
        grams, logp = found.column("g").to_numpy()[order], found.column("logp").to_numpy()[order]
        counts, sums, worst = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows), np.zeros(rows.num_rows)
        held, first, size = [], 0, 0

        def flush(until: int) -> None:
            sizes = np.array([len(x) for x in held], np.int64)
            counts[first:until] = sizes
            if sizes.any():
                values = logp[np.searchsorted(grams, np.concatenate(held))]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                sums[first:until] = np.bincount(owner, weights=values, minlength=len(sizes))
                worst[first:until] = _worst(values, sizes)

        texts = []
        for i, t in enumerate(_unpacked(rows.column("packed"))):
            if keeps:
                texts.append(t)
            held.append(grams_of(t))
            size += len(held[-1])
            if size >= CHARS or i + 1 == rows.num_rows:
                flush(i + 1)
                held, first, size = [], i + 1, 0
        empty = counts == 0
        perplexity = np.exp(-sums / np.maximum(counts, 1))
        kept = {ROW: rows.column(ROW)} | ({"text": pa.array(texts, pa.string())} if keeps else {})
        whole = pa.table(kept | {
            "n_scored": counts, "perplexity": pa.array(perplexity, mask=empty), "worst": pa.array(np.exp(worst), mask=empty)})
        # Returned in small batches: the JVM holds one at a time.
        return pa.Table.from_batches(whole.to_batches(ROWS_BACK), whole.schema)

    return dealt.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(score, schema)


def limits(trusted: DataFrame, lang: str, quantile: float, slack: float) -> DataFrame:
    """``lang, limit, worst_limit`` from the scores of trusted documents; the NULL language has a row of its own.

    The quantile of a few documents is little more than their largest.  The
    limit is not below what a normal distribution of their logarithms would
    give, wider by 12 / n of n documents for what so few can tell.
    """
    wide = NormalDist().inv_cdf(min(quantile, 1 - 1e-6))

    def limit(c: str) -> Column:
        spread = F.greatest(F.coalesce(F.stddev_samp(F.log(c)), F.lit(0.0)), F.lit(LEAST_SPREAD))
        likely = F.exp(F.avg(F.log(c)) + F.lit(wide) * spread * (F.lit(1.0) + F.lit(12.0) / F.count(c)))
        return F.greatest(F.percentile_approx(c, quantile, 10_000), likely) * F.lit(slack)

    return trusted.groupBy(F.col(lang).alias("lang")).agg(limit("perplexity").alias("limit"), limit("worst").alias("worst_limit"))


def ids_of(trusted: DataFrame, key: str = "doc_id", most: int = BROADCAST_IDS) -> DataFrame:
    """The distinct ids, to be broadcast if their counted number is small and joined if not."""
    ids = written(trusted.select(key).dropna().distinct(), "trusted")
    return F.broadcast(ids) if ids.count() <= most else ids


# This share of the trusted documents of a language that the model has not seen is ordinary.
QUANTILE = 0.998
# Logarithms of perplexities are taken to differ by this much at least.
LEAST_SPREAD = 0.05
# One trusted document of so many sets the limits and trains nothing.
HELD = 5
# Where there are too few to hold any out, the limits come from what the model was trained on, with this factor.
SLACK = 1.5
# A log-probability varies by about this much around its mean, so the mean over few characters is uncertain.
DEVIATION = 2.0


def _judged(
    docs: DataFrame, trusted: DataFrame, columns: Sequence[str], key: str = "doc_id", text: str = "text",
    lang: str = "lang", quantile: float = QUANTILE, held: int = HELD, broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    ids = ids_of(trusted, key, broadcast_ids)
    out = F.pmod(F.xxhash64(key), F.lit(held)) == 0
    counts = ids.agg(F.count_if(out), F.count_if(~out)).first()
    apart = held > 1 and all(counts)
    learnt, tested = (ids.filter(~out), ids.filter(out)) if apart else (ids, ids)
    model = train(docs.join(learnt, key, "left_semi").select(F.col(text).cast("string")))
    row = F.col(ROW)
    result = written(scored(docs, model, list(dict.fromkeys([*columns, key, lang])), key, text).withColumns({
        "_key": row.getField(key), "_lang": row.getField(lang)}), "perplexities")
    good = result.select("_key", "_lang", "perplexity", "worst").join(tested.withColumnRenamed(key, "_key"), "_key", "left_semi")
    limit = written(limits(good, "_lang", quantile, 1.0 if apart else SLACK), "limits")
    names = ("limit", "worst_limit")
    most = limit.agg(*[F.max(n).alias(n) for n in names]).first()
    met = result.join(limit, F.col("_lang").eqNullSafe(F.col("lang")), "left").withColumns({
        n: F.coalesce(F.col(n), F.lit(most[n]).cast("double"), F.lit(float("inf"))) for n in names})
    ordinary = F.col("perplexity") <= F.col("limit") * F.exp(F.lit(DEVIATION) / F.sqrt("n_scored"))
    return met.withColumn("kept", F.coalesce(ordinary & (F.col("worst") <= F.col("worst_limit")), F.lit(False)))


ADDED = ["n_scored", "perplexity", "worst", "limit", "worst_limit", "kept"]


def judged(docs: DataFrame, trusted: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """The documents (all their columns, or those named) with ``ADDED``.

    The model is trained on the texts of four fifths of the documents whose key
    is among ``trusted``; the others, which it has not seen, set two limits for
    their language: a quantile of their perplexities, and one of the
    perplexities of their worst windows (``limits``).  A document is kept if it is within
    both, the first widened by one standard error of the document's own mean,
    which matters for texts of a few words.  A language without such documents
    takes the largest limits of the others; without any trusted document every
    text with a character is kept.  With too few of them to hold any out, or
    with ``held=1``, the limits are those of the training documents times ``SLACK``.
    A NULL or empty text has no perplexity and is not kept.  A NULL
    language is a language, a NULL key is never trusted, and repeated rows are
    judged alike.  Input columns with the added names give way.
    """
    return _columns(_judged(docs, trusted, columns or docs.columns, **options), columns or docs.columns, ADDED, options.get("text", "text"))


def filtered(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that ``judged`` keeps, all columns as they were."""
    kept = _judged(docs, trusted, docs.columns, **options).filter("kept")
    return _columns(kept, docs.columns, [], options.get("text", "text"))


def _columns(df: DataFrame, columns: Sequence[str], added: Sequence[str], text: str) -> DataFrame:
    kept = [c for c in columns if c.lower() not in added]
    return df.select(*[F.col("text").alias(c) if c == text else F.col(ROW).getField(c).alias(c) for c in kept], *added)
