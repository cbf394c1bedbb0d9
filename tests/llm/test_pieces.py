import itertools

import numpy as np
import pyarrow as pa
import pytest
from awkward import awkward, docs, none  # noqa: F401
from hypothesis import given, settings, strategies as st

from tapewright.llm import pieces


@pytest.fixture(scope="module")
def m():
    return pieces.model()


def all_ways(m, codes):
    """Every way through a small lattice, best score first."""
    def ways(at):
        if at == len(codes):
            yield 0.0, ()
        for end in range(at + 1, len(codes) + 1):
            for start, score, edge in pieces.edges(m, codes, end):
                if start == at:
                    for rest, more in ways(end):
                        yield score + rest, (edge, *more)
    return sorted(ways(0), key=lambda w: -w[0])


def one(m, text, n):
    batch = pa.record_batch({"doc_id": pa.array([1]), "text": pa.array([text], pa.string())})
    out = pieces._encoded(m, lambda s: pieces.n_best(m, pieces.codes_of(s).tolist(), n), [batch], n, False)
    return [(r["score"], np.frombuffer(r["ids"], "<u4").tolist()) for r in out.to_pylist()]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab e\n▁é😀", max_size=9))
def test_n_best_equals_all_ways(text):
    m = pieces.model()
    ways = all_ways(m, pieces.codes_of(" " + text).tolist())
    got = one(m, text, 5)
    assert [s for s, _ in got] == pytest.approx([s for s, _ in ways[:5]])
    for score, ids in got:
        assert pieces.decoded(m, ids) == text
    assert len({tuple(ids) for _, ids in got}) == len(got)
    flat = {tuple(pieces.spelt(m, np.array(w, np.int64))[0].tolist()): s for s, w in ways}
    assert all(flat[tuple(ids)] == pytest.approx(s) for s, ids in got)


def test_a_star_takes_no_step_off_the_best_ways(m):
    codes = pieces.codes_of(" international").tolist()
    ways = all_ways(m, codes)
    got = pieces.n_best(m, codes, 50)
    assert [s for s, _ in got] == pytest.approx([s for s, _ in ways[:50]])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="%a1e. -=", min_size=1, max_size=70))
def test_first_way_does_not_depend_on_how_many_are_asked(text):
    m = pieces.model()
    ways = {n: one(m, text, n)[0] for n in (1, 2, 4)}
    assert ways[1] == ways[2] == ways[4]


def test_ties_on_given_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    first = [sorted((r["doc_id"], bytes(r["ids"])) for r in pieces.encode(frame, n).filter("rank = 1").collect()) for n in (1, 4)]
    assert first[0] == first[1]
    proved = pieces.encode(frame, 2, proof=True).collect()
    assert sum(r["decoded_crc32"] is not None for r in proved) == frame.count() and all(r["text_crc32"] == r["decoded_crc32"] for r in proved)


def test_combined_sums():
    lists = [[5.0, 4, 1], [3.0, 2.5], [0.0]]
    wanted = sorted((sum(c) for c in itertools.product(*lists)), reverse=True)
    got = pieces.combined(lists, 100)
    assert [s for s, _ in got] == wanted and len({at for _, at in got}) == len(wanted)


def test_awkward_documents(docs, m):  # noqa: F811
    encoded = pieces.encode(docs, 3)
    rows = pieces.decode(encoded).collect()
    texts = {str(r[0]): r[1] or "" for r in awkward() if r[0] is not None}
    assert {str(r["doc_id"]) for r in rows} == {str(r[0]) for r in awkward()}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["text"] == texts[str(r["doc_id"])]
    best = {r["doc_id"]: r["score"] for r in rows if r["rank"] == 1}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["score"] <= best[r["doc_id"]]
    # Repeated rows are encoded each; the space of an empty text has one way.
    assert sum(r["doc_id"] == 2 for r in rows) == 6 and sum(r["doc_id"] == 3 for r in rows) == 1


def test_batches_change_nothing(docs):  # noqa: F811
    whole, parts = (sorted(map(str, pieces.encode(docs, 2, at_once=n).collect())) for n in (1 << 24, 500))
    assert whole == parts


def test_no_rows(none):  # noqa: F811
    assert pieces.encode(none).collect() == [] and pieces.decode(pieces.encode(none)).collect() == []
