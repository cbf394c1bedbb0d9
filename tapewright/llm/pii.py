"""Personal data: generators propose spans, boosted trees choose among them."""

from __future__ import annotations

import dataclasses
import itertools
import math
import random
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tapewright.llm.common import ROW, boxed, forget, map_batches, sample_of, written

TREES, DEPTH = 20, 4
# Candidates for one task of a pass over those that train the trees.
TRAINED = 1 << 16
# Share of the chosen candidates of the held-out part that must be right.
PRECISION = 0.95

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Where a match can start is rewritten so that a long run is read once.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
IP = re.compile(r"[0-9]+((?:\.[0-9]+){3})?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# High-recall generators beside the base patterns, by the kind they propose.  Numbers are looked for only
# within a stretch of number characters, mail addresses only around a sign for "at".
STRETCH = re.compile(r"[0-9(+][\x20()+,./0-9-]{5,}[0-9]")
NUMBERS = (
    ("ip", re.compile(r"(?<![\w.])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?!\w)")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./-]?[0-9]{4}){2}[\x20./-]?[0-9]{1,7}(?![0-9])")),
    ("phone", re.compile(r"(?<![\w.])(?:\+|00)?[0-9]{0,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-]?[0-9]{3,4}(?!\w)")),
)
AT = re.compile(r"\s?(?:@|\(at\)|\[at\])\s?")
LOCAL = re.compile(r"[\w.%+-]")
DOMAIN = re.compile(r"[\w-]{1,64}(?:\s?(?:\.|\(dot\)|\[dot\])\s?[\w-]{1,32}){1,4}")
MARKERS = re.compile(r"[0-9@]|[(\[]at[)\]]")
# Words shortly before a span that speak of personal data.
CONTEXT = re.compile(r"(?i)mail|phone|tel|call|fax|mobile|card|visa|account|\bip\b|host|address|contact")
BEFORE = 24

FEATURES = (
    *KINDS, "length", "digits", "letters", "separators", "dots", "at", "plus",
    "groups", "luhn", "octets", "distinct", "context", "word_before", "word_after", "line_start",
)


def luhn(digits: str) -> bool:
    double = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in double)) % 10 == 0


def octets(parts: Sequence[str]) -> bool:
    return all(len(q := p.lstrip("0")) < 4 and int(q or "0") <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans of a whole text in code points, by kind as listed, then start."""
    found = []
    if "@" in text:
        found += [("email", *m.span()) for m in EMAIL.finditer(text) if m[1]]
    if "." in text:
        found += [("ip", *m.span()) for m in IP.finditer(text) if m[1] and octets(m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def proposed(text: str) -> list[tuple[str, int, int]]:
    """Spans that might be personal data.  They may overlap each other and the base spans."""
    found = []
    for at in AT.finditer(text) if "@" in text or "at)" in text or "at]" in text else ():
        start, domain = at.start(), DOMAIN.match(text, at.end())
        while domain and start and LOCAL.match(text, start - 1):
            start -= 1
        if domain and start < at.start():
            found.append(("email", start, domain.end()))
    for stretch in STRETCH.finditer(text):
        for kind, pattern in NUMBERS:
            found += [(kind, *m.span()) for m in pattern.finditer(text, stretch.start(), stretch.end() + 1)]
    return found


def runs_on(text: str, start: int, end: int) -> bool:
    """Whether more numbers stand right beside a span: the base patterns then may have missed it."""
    return bool(re.match(r"[\x20.-]?[0-9]", text[end:end + 2]) or re.search(r"[0-9][\x20.-]?$", text[max(0, start - 2):start]))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of one candidate."""
    span, before = text[start:end], text[max(0, start - BEFORE):start]
    digits = "".join(c for c in span if "0" <= c <= "9")
    parts = re.findall("[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    return [
        *[float(kind == k) for k in KINDS],
        float(len(span)), float(len(digits)), float(letters), float(len(span) - len(digits) - letters),
        float(span.count(".")), float("@" in span), float(span.startswith("+")), float(len(parts)),
        float(bool(digits) and luhn(digits)), float(len(parts) == 4 and octets(parts)),
        len(set(span)) / len(span), float(bool(CONTEXT.search(before))),
        float(before[-1:].isalnum()), float(text[end:end + 1].isalnum()), float("\n" in before or start == 0),
    ]


@dataclasses.dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays: for every tree and node the feature, the split, the children and the value."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    limit: dict[str, float]
    # Per form: candidates held out, precision and recall at its limit.
    measured: dict[str, dict[str, float]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for t, weight in enumerate(self.weight):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                goes_left = x[np.arange(len(x)), self.feature[t][at]] <= self.split[t][at]
                at = np.where(goes_left, self.left[t][at], self.right[t][at])
            total += weight * self.value[t][at]
        return total

    def chosen(self, x: np.ndarray, forms: Sequence[str]) -> np.ndarray:
        return self.margin(x) >= np.array([self.limit.get(f, math.inf) for f in forms])


def _arrays(model) -> tuple[np.ndarray, ...]:
    """The nodes of every tree; a leaf is its own child."""
    size = 2 ** (DEPTH + 1)
    shape = (len(model.trees), size)
    feature, left, right = (np.zeros(shape, np.int64) for _ in range(3))
    split, value = np.zeros(shape), np.zeros(shape)
    for t, tree in enumerate(model.trees):
        todo, used = [(tree._call_java("rootNode"), 0)], 1
        while todo:
            node, at = todo.pop()
            value[t, at], left[t, at], right[t, at] = node.prediction(), at, at
            if node.subtreeDepth():
                feature[t, at], split[t, at] = node.split().featureIndex(), node.split().threshold()
                left[t, at], right[t, at] = used, used + 1
                todo += [(node.leftChild(), used), (node.rightChild(), used + 1)]
                used += 2
    return feature, split, left, right, value, np.array(model.treeWeights)


def form(kind: str, span: str) -> str:
    """The way a candidate is written.  Every kind and form has a limit of its own."""
    if kind == "email":
        return "email" if "@" in span else "email, spelt"
    if kind == "phone":
        return "phone" if span.startswith(("+", "00")) else "phone, bare"
    if kind == "card":
        return "card" if sum("0" <= c <= "9" for c in span) >= 16 else "card, short"
    return kind


def limits(margins: np.ndarray, labels: np.ndarray, forms: np.ndarray, precision: float, counts: np.ndarray | None = None) -> dict[str, float]:
    """Per form the margin above which the held-out candidates are right often enough.

    It lies midway to the first candidate that stays out; where none does, it is
    no more than 0, the trees' own boundary.  With ``counts`` a row stands for so
    many candidates, of which ``labels`` are personal data.
    """
    found = {}
    counts = np.ones(len(margins), np.int64) if counts is None else counts
    for one in np.unique(forms):
        m, y, n = margins[forms == one], labels[forms == one], counts[forms == one]
        order = np.argsort(-m, kind="stable")
        m, right = m[order], np.cumsum(y[order]) / np.cumsum(n[order])
        # Equal margins stand or fall together.
        ends = np.flatnonzero(np.append(m[1:] != m[:-1], True) & (right >= precision))
        if len(ends) and y.any():
            last = ends[-1]
            found[str(one)] = float((m[last] + m[last + 1]) / 2) if last + 1 < len(m) else min(float(m[last]), 0.0)
    return found


# What stands before planted personal data, and before planted numbers that are none.
CUES = {
    "phone": ("phone", "call", "tel.", "fax", "mobile", "reach me on", ""), "email": ("mail", "write to", "contact", "e-mail:", ""),
    "card": ("card", "paid by", "visa", "card number:", ""), "ip": ("host", "from", ""),
}
OTHERS = ("order", "part", "on", "pages", "lot", "between", "version", "sum", "record", "")


def _number(rng: random.Random, n: int) -> str:
    return str(rng.randrange(1, 10)) + "".join(str(rng.randrange(10)) for _ in range(n - 1))


def _checked(rng: random.Random, n: int, right: bool = True) -> str:
    """A number of n digits that passes the checksum, or just fails it."""
    head = _number(rng, n - 1)
    last = next(d for d in "0123456789" if luhn(head + d))
    return head + (last if right else str((int(last) + rng.randrange(1, 10)) % 10))


def _grouped(digits: str, sizes: Sequence[int], sign: str) -> str:
    """The digits in groups of these sizes, what is left over as one more."""
    ends = list(itertools.accumulate(sizes))
    return sign.join(filter(None, [digits[e - n:e] for e, n in zip([*ends, len(digits)], [*sizes, len(digits) - ends[-1]])]))


def variant(rng: random.Random, kind: str, span: str | None = None) -> str:
    """Personal data in a form that the base patterns do not know: of a base span, or made up."""
    if kind == "email":
        local, _, domain = (span or f"{rng.choice('abcdefgh')}{_word(rng)}.{_word(rng)}@{_word(rng)}.{rng.choice(('example', 'org', 'net'))}").partition("@")
        at = rng.choice((" (at) ", "(at)", " [at] ", "[at]"))
        return local + at + (domain.replace(".", rng.choice((".", " (dot) ", "[dot]"))))
    if kind == "phone":
        digits = "".join(c for c in span or "" if "0" <= c <= "9")[-10:]
        digits = digits if len(digits) == 10 else _number(rng, 10)
        return rng.choice((
            _grouped(digits, (3, 3, 4), "-"), _grouped(digits, (3, 3, 4), " "), f"({digits[:3]}) {digits[3:6]} {digits[6:]}",
            f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", _grouped(digits, (3, 3, 4), ".")))
    if kind == "card":
        digits = "".join(c for c in span or "" if "0" <= c <= "9") if rng.random() < 0.5 else ""
        digits = digits or _checked(rng, rng.choice((13, 14, 15, 16)))
        return _grouped(digits, (4, 4, 4), rng.choice((".", "/", "-", " ", "")) if len(digits) < 16 else rng.choice("./"))
    return span or ".".join(str(rng.randrange(256)) for _ in range(4))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(3, 8)))


def other_number(rng: random.Random) -> str:
    """A number that looks like personal data to the generators and is none."""
    return rng.choice((
        f"{rng.randrange(1900, 2040)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d} {rng.randrange(10, 24)}:{rng.randrange(10, 60)}",
        f"{rng.randrange(1, 29):02d}.{rng.randrange(1, 13):02d}.{rng.randrange(1900, 2040)} {_number(rng, 4)}",
        _grouped(_checked(rng, 16, False), (4, 4, 4), rng.choice("-. /")), _checked(rng, rng.choice((13, 14, 15)), False),
        f"{_number(rng, 3)} {_number(rng, 3)} {_number(rng, 3)} {_number(rng, 3)}", f"{_number(rng, 2)},{_number(rng, 3)},{_number(rng, 3)},{_number(rng, 3)}",
        f"{_number(rng, 3)}.{_number(rng, 3)} {_number(rng, 4)}", f"{_number(rng, 2)}-{_number(rng, 3)}-{_number(rng, 5)}-{_number(rng, 2)}",
    ))


def examples(text: str) -> Iterator[tuple[str, float, list[float], str]]:
    """(kind, label, features, form) of candidates whose truth does not come from the base patterns' shape.

    Three readings of a text.  As it is: what the generators propose beside
    base spans is taken for ordinary text.  Its base spans rewritten into forms
    that the patterns do not know: those are personal data.  With one planted
    sentence of either sort.  Candidates that only overlap one of these are
    left out, and so are those beside which more numbers stand.
    """
    rng = random.Random(zlib.crc32(text.encode()))

    def read(text: str, true: set, silent: list[tuple[int, int]]) -> Iterator[tuple]:
        for k, s, e in dict.fromkeys(proposed(text)):
            if (k, s, e) in true:
                yield k, 1.0, features(text, k, s, e), form(k, text[s:e])
            elif all(e <= a or b <= s for a, b in silent) and not runs_on(text, s, e):
                yield k, 0.0, features(text, k, s, e), form(k, text[s:e])

    base = sorted(base_spans(text), key=lambda x: x[1:]) if MARKERS.search(text) else []
    yield from read(text, set(), [(s, e) for _, s, e in base])
    if base:
        parts, true, at, size = [], set(), 0, 0
        for k, s, e in base:
            if s >= at and k != "ip":
                new = variant(rng, k, text[s:e])
                parts += [text[at:s], new]
                size += s - at
                true.add((k, size, size + len(new)))
                size, at = size + len(new), e
        yield from (x for x in read("".join([*parts, text[at:]]), true, [(0, size + len(text))]) if x[1])
    if rng.random() < 0.5:
        # Beside the planted sentence stands what stands there in the table.
        near = text[:200] if len(text) < 400 else text[(i := rng.randrange(len(text) - 200)):i + 200]
        cut = near.find(" ") + 1
        kind = rng.choice(("phone", "email", "card", ""))
        value = variant(rng, kind) if kind else other_number(rng)
        cue = rng.choice(CUES[kind]) if kind else rng.choice((*OTHERS, *CUES["phone"]))
        head = near[:cut] + (cue + " " if cue else "")
        planted = head + value + rng.choice((" ", ". ", ", ", "\n")) + near[cut:]
        start, end = len(head), len(head) + len(value)
        for x in read(planted, {(kind, start, end)}, [(0, start), (end, len(planted))] if not kind else [(0, len(planted))]):
            yield x


def _candidates(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*x, zlib.crc32(t.encode()) % 4) for t in batch.column(0).to_pylist() if t for x in examples(t)]
            if rows:
                kinds, labels, x, forms, folds = zip(*rows)
                yield pa.record_batch({"kind": pa.array(kinds), "label": pa.array(labels), "x": pa.array(x, pa.list_(pa.float64())),
                                       "form": pa.array(forms), "fold": pa.array(folds, pa.int32())})

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "kind string, label double, x array<double>, form string, fold int")


def _margins(held: DataFrame, trees: Trees) -> DataFrame:
    """``form, margin, n, right``: how many candidates the trees give a margin, and how many of them are personal data."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))
        return pa.record_batch([batch.column("form"), pa.array(trees.margin(x)), batch.column("label")], ["form", "margin", "label"])

    scored = map_batches(held.select("x", "form", "label"), each, "form string, margin double, label double")
    return scored.groupBy("form", "margin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("right"))


def train(docs: DataFrame, text: str = "text", rows: int | None = None, precision: float = PRECISION) -> Trees | None:
    """Trees from the ``examples`` of all documents, or of about ``rows``; None if they show one class only.

    Three quarters of the documents train the trees, the rest sets a limit for
    every kind and form and measures what it gives (``Trees.measured``).  Only
    the margins that the trees tell apart come to the driver, with their counts.
    """
    found = written(_candidates(docs if rows is None else sample_of(docs, rows), text), "candidates")
    seen = {r["label"]: r["count"] for r in found.filter("fold > 0").groupBy("label").count().collect()}
    if len(seen) < 2:
        return None
    learn = found.filter("fold > 0").select("label", array_to_vector("x").alias("features"))
    # The trees pass over their rows a hundred times, in few tasks however many files those came in.
    learn = learn.coalesce(max(16, -(-sum(seen.values()) // TRAINED)))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, cacheNodeIds=False).fit(learn)
    trees = Trees(*_arrays(model), limit={}, measured={})
    test = _margins(found.filter("fold = 0"), trees).toPandas()
    forget(found)
    if test.empty:
        return None
    margins, right, counts, forms = (test[c].to_numpy() for c in ("margin", "right", "n", "form"))
    forms = forms.astype(str)
    limit = limits(margins, right, forms, precision, counts)
    measured = {}
    for one in limit:
        its, picked = forms == one, margins >= limit[one]
        hits = float(right[its & picked].sum())
        measured[one] = {"n": int(counts[its].sum()), "precision": hits / counts[its & picked].sum(), "recall": hits / right[its].sum()}
    return dataclasses.replace(trees, limit=limit, measured=measured)


def spans_of(text: str, trees: Trees | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the others that the trees choose: the best first, none across another span."""
    if not MARKERS.search(text):
        return [], []
    base = base_spans(text)
    if trees is None:
        return base, []
    rest = [c for c in dict.fromkeys(proposed(text)) if c not in base]
    if not rest:
        return base, []
    x = np.array([features(text, *c) for c in rest])
    picked = trees.chosen(x, [form(k, text[s:e]) for k, s, e in rest])
    margins = trees.margin(x)
    taken = sorted((s, e) for _, s, e in base)
    more = []
    for i in sorted(np.flatnonzero(picked), key=lambda i: (-margins[i], rest[i][1], rest[i][2])):
        kind, s, e = rest[i]
        if all(e <= a or b <= s for a, b in taken):
            taken.append((s, e))
            more.append((kind, s, e))
    return base, more


def redacted(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    """The text with ``[KIND]`` for every span; overlapping spans become one, named after the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ORDER = {k: i for i, k in enumerate(KINDS)}


def _found(rows: DataFrame, trees: Trees | None, redact: bool) -> DataFrame:
    """The first column of ``rows`` with the spans of the text in the second, and that text redacted."""
    first = rows.columns[0]
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans: list[tuple[str, int, int]]) -> list[dict]:
        return [{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans, key=lambda x: (ORDER[x[0]], x[1]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every, texts = [], [], []
            for string in batch.column(1):
                text = string.as_py()
                sure, more = spans_of(text or "", trees)
                base.append(listed(sure))
                every.append(listed(sure + more))
                if redact:
                    texts.append(redacted(text, sure + more) if base[-1] or every[-1] else text)
            columns = [batch.column(0), pa.array(base, spans_type), pa.array(every, spans_type)]
            yield pa.record_batch([*columns, *[pa.array(texts, pa.string())] * redact],
                                  [first, "base", "spans", *["redacted"] * redact])

    schema = rows.select(first).schema.add("base", SPANS).add("spans", SPANS)
    return rows.mapInArrow(run, schema.add("redacted", "string") if redact else schema)


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int | None = None) -> DataFrame:
    """``doc_id, base, spans`` for every row: what the base patterns find, and that with what the trees add.

    A NULL or empty text has no spans.  Rows are looked at one by one, so
    copies, repeated rows and NULL keys need no care; an empty table, or one
    that shows the trees a single class, adds nothing to the base.
    """
    trees = train(docs, text, rows)
    return _found(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string")), trees, False)


def clean(docs: DataFrame, text: str = "text", rows: int | None = None, n_chars: str | None = "n_chars") -> DataFrame:
    """All rows and columns with the spans replaced in the text by their kinds; ``n_chars`` follows the text.

    A NULL text stays NULL.  A text without a span is not touched.
    """
    trees = train(docs, text, rows)
    # The text goes to Python and back once.
    found = _found(boxed(docs, empty=text, text=F.col(text).cast("string")), trees, True)

    def field(c: str):
        if c == text:
            return F.col("redacted").alias(c)
        if c == n_chars:
            kind = docs.schema[c].dataType
            return F.when(F.size("spans") > 0, F.length("redacted")).otherwise(F.col(ROW).getField(c)).cast(kind).alias(c)
        return F.col(ROW).getField(c).alias(c)

    return found.select(*[field(c) for c in docs.columns])
