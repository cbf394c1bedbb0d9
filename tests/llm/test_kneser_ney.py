import math
from collections import Counter, defaultdict

import pytest
from awkward import awkward, docs, none  # noqa: F401
from pyspark.sql import functions as F

from tapewright.llm import kneser_ney as kn


def slow_model(texts):
    """Probabilities of the last of four characters, straight from the definition."""
    counts = {4: Counter()}
    for t in texts:
        s = "\0\0\0" + t
        counts[4].update(s[i:i + 4] for i in range(len(t)))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    give = {n: kn.discounts(*[sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]) for n, c in counts.items()}

    def d(n, c):
        return give[n][min(c, 3) - 1] if c else 0.0

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        after = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return p(gram[1:])
        c = after.get(gram, 0)
        return (c - d(n, c)) / total + sum(d(n, x) for x in after.values()) / total * p(gram[1:])

    return p


def test_perplexities_equal_brute_force(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "the dog sat on the log", "en"), (3, "le chat est sur le lit", "fr"),
            (4, "the cat saw the dog", "en"), (5, "zzz 😀", "en"), (6, "", "en"), (7, None, "fr"), (8, "t", None)]
    trained = [t for i, t, _ in rows if i <= 3]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in kn.judged(frame, spark.createDataFrame([(1,), (2,), (3,)], "doc_id bigint"), held=1).collect()}
    p = slow_model(trained)
    for i, t, _ in rows:
        if not t:
            assert got[i]["perplexity"] is None and not got[i]["kept"] and got[i]["n_scored"] == 0
            continue
        s = "\0\0\0" + "".join(c if ord(c) < 0x10000 else "￿" for c in t)
        logs = [math.log(p(s[k:k + 4])) for k in range(len(t))]
        assert got[i]["perplexity"] == pytest.approx(math.exp(-sum(logs) / len(t)))
        starts = {*range(0, max(1, len(t) - kn.WINDOW + 1), kn.WINDOW // 2), max(0, len(t) - kn.WINDOW)}
        worst = max(-sum(logs[a:a + kn.WINDOW]) / len(logs[a:a + kn.WINDOW]) for a in starts)
        assert got[i]["worst"] == pytest.approx(math.exp(worst))
    english = max(got[1]["perplexity"], got[2]["perplexity"])
    assert got[4]["limit"] >= english * kn.SLACK * 0.999 and got[8]["limit"] == max(got[3]["limit"], got[4]["limit"])


def test_probabilities_add_up_to_one(spark):
    p = slow_model(["the cat sat on the mat", "a cat is a cat"])
    letters = set("the cat sat on the mat a cat is a cat")
    for context in ("the", " ca", "zzz"):
        assert sum(p(context + x) for x in letters | {"￿"}) == pytest.approx(1)
    texts = spark.createDataFrame([("the cat sat on the mat",), ("a cat is a cat",)], "text string")
    # A context that no gram ends in has a weight but no probability.
    rows = [r for r in kn.train(texts).collect() if r["p"] is not None]
    assert sum(r["p"] for r in rows if r["n"] < 2) == pytest.approx(1)
    by_order = defaultdict(int)
    for r in rows:
        by_order[r["n"]] += 1
    assert by_order[0] == 1 and by_order[1] == len(letters)


def test_awkward_documents(docs):  # noqa: F811
    trusted = docs.select("doc_id").filter("doc_id IN (1, 11)")
    got = kn.judged(docs, trusted)
    assert got.columns == [*[c for c in docs.columns if c not in kn.ADDED], *kn.ADDED]
    rows = got.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in awkward())
    for r in rows:
        assert r["n_scored"] == len(r["text"] or "")
        assert (r["perplexity"] is None) == (not r["text"])
    kept = kn.filtered(docs, trusted)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(2) == 2 and 1 in ids and 12 not in ids


def test_nothing_trusted_and_no_rows(docs, none):  # noqa: F811
    no_ids = docs.select("doc_id").limit(0)
    kept = kn.filtered(docs, no_ids)
    assert kept.count() == sum(bool(r[1]) for r in awkward())
    assert kn.judged(none, no_ids).collect() == []


def test_small_batches_change_nothing(docs):  # noqa: F811
    model = kn.train(docs.select("text"))
    one, many = (kn.scored(docs, model, ["doc_id"], batch=b).select(F.col("_row.doc_id"), "n_scored", F.round("perplexity", 9)) for b in (1 << 24, 100))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_held_out_labels(spark):
    """Trained on half of the good documents, it keeps the others and finds most of the junk."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 0")
    trusted = labels.filter("quality = 1 AND doc_id % 2 = 0").select("doc_id")
    got = kn.judged(spark.read.parquet(f"{sf}/documents.parquet"), trusted, ["doc_id", "lang"])
    rows = got.join(labels.filter("quality = 0 OR doc_id % 2 = 1"), "doc_id").select("quality", "kept").collect()
    good, junk = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.15 * len(junk)


def test_a_bad_window_in_good_prose_is_seen(spark):
    rows = [(i, " ".join(f"the {w} sat on the mat near the old {w}" for w in ("cat", "dog", "cow", "hen")) + f" {i}", "en") for i in range(200)]
    rows += [(1000, rows[0][1][:60] + " xqzvk wqjx zzgbk qxvh jjkqw " + rows[0][1][60:], "en")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in kn.judged(frame, frame.filter("doc_id < 200").select("doc_id")).collect()}
    assert not got[1000]["kept"] and sum(r["kept"] for r in got.values()) >= 198


def test_limits_come_from_documents_the_model_has_not_seen(spark):
    frame = spark.createDataFrame([(i, f"text {i * 7919 % 1000} of some {i}", "en") for i in range(60)], "doc_id bigint, text string, lang string")
    out = [r["doc_id"] for r in frame.filter(F.pmod(F.xxhash64("doc_id"), F.lit(kn.HELD)) == 0).collect()]
    got = {r["doc_id"]: r for r in kn.judged(frame, frame.select("doc_id"), quantile=0.5).collect()}
    logs = sorted(math.log(got[i]["perplexity"]) for i in out)
    assert got[0]["limit"] == pytest.approx(max(math.exp(sum(logs) / len(logs)), math.exp(logs[(len(logs) - 1) // 2])))


def test_limits_of_few_documents_are_wide(spark):
    scores = [("a", 3.0 + i % 7 / 10, 5.0) for i in range(400)] + [("b", 3.0, 5.0), (None, 3.0, 5.0), (None, 3.1, 5.0)]
    frame = spark.createDataFrame(scores, "lang string, perplexity double, worst double")
    got = {r["lang"]: r["limit"] for r in kn.limits(frame, "lang", 0.995, 1.0).collect()}
    assert 3.6 <= got["a"] < 4.1 < got[None] < got["b"] < 20
