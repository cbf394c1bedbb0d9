import re
import zlib

import numpy as np
from awkward import awkward, docs, none  # noqa: F401
from hypothesis import given, settings, strategies as st

from tapewright.llm import pii


def slow_base(text):
    """The contract's patterns as they stand."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@-+%_0127 ()é\n", max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert pii.base_spans(text) == slow_base(text)


def test_base_of_real_formats():
    text = "a.b@c.example, x@y@z.org 255.1.2.3 256.1.2.3.4 1.2.3.4.5.6.7.8, 4111 1111-1111 1111, 4111111111111112; +1 (017) 555-7713 +12 3"
    assert pii.base_spans(text) == slow_base(text)
    assert [k for k, _, _ in pii.base_spans(text)] == ["email", "email", "ip", "ip", "ip", "card", "phone"]


def test_long_runs_are_read_once():
    for text in ("a" * 400_000, "1" * 400_000, "+1" + " " * 400_000, "1." * 200_000, "@" * 100_000):
        pii.base_spans(text)
        pii.proposed(text)


def test_awkward_documents(docs):  # noqa: F811
    got = pii.spans(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in awkward())
    wanted = {r[0]: slow_base(r[1] or "") for r in awkward() if r[0] is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert [tuple(s) for s in r["base"]] == wanted[r["doc_id"]]
            assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def test_cleaning_replaces_spans_and_keeps_the_rest(docs):  # noqa: F811
    got = pii.clean(docs)
    assert got.schema == docs.schema
    for before, after in zip(sorted(docs.collect(), key=str), sorted(got.collect(), key=str)):
        found = slow_base(before["text"] or "")
        if not found:
            assert before == after
        else:
            assert slow_base(after["text"]) == [] and after["n_chars"] == len(after["text"])
            assert after["text"].count("[") >= len(found)


def test_no_rows(none):  # noqa: F811
    assert pii.spans(none).collect() == [] and pii.clean(none).collect() == []


def test_overlapping_spans_become_one():
    assert pii.redacted("call 12345 now", [("card", 5, 8), ("phone", 7, 10)]) == "call [CARD] now"
    assert pii.redacted("é12", [("ip", 1, 3)]) == "é[IP]"


def test_limits_hold_their_precision():
    margins, labels = np.array([3.0, 2, 2, 1, 0, -1]), np.array([1.0, 1, 1, 0, 1, 0])
    assert pii.limits(margins, labels, np.array(["card"] * 6), 0.95) == {"card": 1.5}
    assert pii.limits(margins, labels * 0 + 1, np.array(["card"] * 6), 0.95) == {"card": -1.0}
    assert pii.limits(margins + 2, labels * 0 + 1, np.array(["card"] * 6), 0.95) == {"card": 0.0}
    assert pii.limits(margins, labels * 0, np.array(["card"] * 6), 0.95) == {}


def test_trees_add_what_the_patterns_miss(spark):
    """Held-out: two cards that the base pattern reads as one long number; numbers that fail the check stay."""
    def card(i, ok):
        digits = [int(c) for c in f"4{i * 7919 % 10 ** 14:014d}"]
        total = sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits))
        return "".join(map(str, digits)) + str((-total + (0 if ok else 5)) % 10)

    rows = [(i, f"order {i} was paid by {card(i, i % 2 == 0)} and sent from 10.{i % 250}.3.{i % 99}") for i in range(400)]
    pair = f"{card(1000, True)} {card(1001, True)}"
    rows += [(1000, f"both {pair} were used"), (1001, f"only {card(1003, False)} was used")]
    got = {r["doc_id"]: r for r in pii.spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1000]["base"] == [] and [tuple(s) for s in got[1000]["spans"]] == [("card", 5, 21), ("card", 22, 38)]
    assert got[1001]["spans"] == []


# A table of many sorts of text: prose, contacts in the base forms, and numbers that are no personal data.
def _table(n):
    import random
    rng = random.Random(9)
    rows = []
    for i in range(n):
        words = " ".join(rng.choice(["the", "quick", "report", "of", "old", "trees", "and", "water", "ran", "near"]) for _ in range(rng.randrange(10, 60)))
        tail = rng.choice([
            f"write to {rng.choice('abc')}.{i}@site{i % 9}.example soon", f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} now",
            f"sold {rng.randrange(100, 999)} of {rng.randrange(1000, 9999)} on 2024-0{rng.randrange(1, 9)}-1{rng.randrange(9)}",
            f"version {i % 9}.{i % 7}.{i % 5} of part {rng.randrange(10 ** 6)}", pii.other_number(rng), ""])
        rows.append((i, f"{words} {tail} {words[:30]}"))
    return rows


def test_forms_beyond_the_patterns_are_found(spark):
    """Held-out texts: a phone without a plus, addresses spelt out, a card of 15 digits; dates, sums and failed checks stay."""
    rows = _table(1500)
    new = [
        (9001, "phone 555-123-4567", "555-123-4567"), (9002, "mail jane.doe (at) site.example today", "jane.doe (at) site.example"),
        (9003, "call (017) 555 7713", "(017) 555 7713"), (9004, "card 378282246310005 was used", "378282246310005"),
        (9005, "on 2024-05-17 10:33 we left", None), (9006, "sum 12,345,678,901 of all", None), (9007, "order 378282246310006 was sent", None),
    ]
    frame = spark.createDataFrame(rows + [r[:2] for r in new], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.spans(frame).filter("doc_id > 9000").collect()}
    for i, text, wanted in new:
        found = [text[s["start"]:s["end"]] for s in got[i]["spans"]]
        assert got[i]["base"] == [] and found == ([wanted] if wanted else []), text


def test_precision_and_recall_are_measured_per_form(spark):
    trees = pii.train(spark.createDataFrame(_table(1500), "doc_id bigint, text string"))
    for form in ("phone, bare", "email, spelt", "card, short"):
        m = trees.measured[form]
        assert m["n"] > 20 and m["precision"] >= 0.95 and m["recall"] >= 0.5, (form, m)


def test_long_names_of_addresses_are_whole():
    name = "x" * 500
    assert ("email", 0, 500 + len(" (at) site.example")) in pii.proposed(f"{name} (at) site.example")
    assert pii.base_spans(f"{name}@site.example") == [("email", 0, 513)]


def test_trees_learn_from_all_documents(spark, monkeypatch):
    """More documents and candidates than any bounded sample took: all that are held out are measured."""
    monkeypatch.setattr(pii, "TREES", 2)
    numbers = ["555-123-{:04d}", "(017) 555 {:04d}", "4{:04d} 201 33 44 1", "2024-05-17 10:33 {:04d}"]
    texts = [" and ".join(n.format((7 * i + k) % 10_000) for k, n in enumerate(numbers)) + f" for +1 ({i % 700 + 200}) 555-{i % 10_000:04d} in {i}" for i in range(21_000)]
    trees = pii.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    held = [x[3] for t in texts if zlib.crc32(t.encode()) % 4 == 0 for x in pii.examples(t)]
    assert len(texts) > 20_000 and 4 * len(held) > 50_000 and trees.measured
    assert {f: m["n"] for f, m in trees.measured.items()} == {f: held.count(f) for f in trees.measured}


def test_limits_of_counts_equal_those_of_rows():
    rng = np.random.default_rng(1)
    margins, labels, forms = rng.integers(-5, 6, 500) / 4, rng.random(500) < 0.9, rng.choice(["card", "phone"], 500)
    keys, at = np.unique(np.array([f"{f} {m}" for f, m in zip(forms, margins)]), return_inverse=True)
    met = {k: i for i, k in enumerate(at)}
    rows = np.array([met[k] for k in range(len(keys))])
    got = pii.limits(margins[rows], np.bincount(at, labels), forms[rows], 0.9, np.bincount(at))
    assert got == pii.limits(margins, labels, forms, 0.9) != {}
