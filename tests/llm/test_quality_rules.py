import re
from collections import Counter

import pytest
from awkward import SCHEMA, awkward, docs, none  # noqa: F401
from pyspark.sql import functions as F

from tapewright.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(docs):  # noqa: F811
    got = q.judged(docs).select("doc_id", "text", *q.BASE, "base_failed", "kept").collect()
    assert len(got) == len(awkward())
    for r in got:
        assert tuple(r[2:7]) == counts(r["text"]), r["doc_id"]
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_columns_that_clash_give_way_and_others_stay(docs):  # noqa: F811
    got = q.judged(docs)
    assert got.columns == [c for c in docs.columns if c not in ("kept", "n_words")] + [*q.BASE, "base_failed", "kept"]
    assert q.filtered(docs).columns == docs.columns


def test_clean_prose_stays_and_junk_goes(docs):  # noqa: F811
    once = " ".join(f"river{i} stones{i} carry{i} old water{i}." for i in range(40))
    frame = docs.sparkSession.createDataFrame(
        [("prose", once), ("symbols", once.replace(" ", "### ")), ("capitals", once.upper()), ("table", once.replace(" ", " | "))], "name string, text string")
    assert [r["name"] for r in q.filtered(frame).collect()] == ["prose"]


def test_order_is_by_rejections_per_second_and_never_changes_the_verdict(spark):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("text"))
    dear = F.length(F.repeat(F.sha2(F.col("text"), 512), 200)) < 0
    rules = [q.Rule("dear", dear), q.Rule("none", F.lit(False)), q.Rule("many", F.col("text") > "2")]
    assert q.ordered(frame, rules)[0].name == "many"
    kept = {tuple(sorted(r[0] for r in frame.filter(q.verdict(order)).collect())) for order in (rules, rules[::-1])}
    assert len(kept) == 1


@pytest.mark.parametrize("fn", [q.filtered, q.judged])
def test_no_rows(none, fn):  # noqa: F811
    assert fn(none).collect() == []


def test_main_path_is_native(docs):  # noqa: F811
    plan = q.judged(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_schema_is_awkward_enough():
    assert {"kept", "n_words", "_row"} <= {c.split()[0] for c in SCHEMA.split(", ")}
