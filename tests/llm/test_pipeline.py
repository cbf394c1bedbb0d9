"""The pipeline against a brute-force version that works on Python lists, and the registered queries."""

from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_kneser_ney import slow_model  # noqa: F401
from test_packing import check
from test_pii import slow_base
from test_quality_rules import counts
from test_simhash import slow_fingerprint, slow_groups

import check as checks
import corpus_pipeline
from tapewright.llm import queries, quality_rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        path = corpus_pipeline.written(docs, name)
        out[name], docs = (before.collect(), path.collect(), path.columns), path
    return out


def test_stages_and_columns(stages):
    assert list(stages) == ["quality_rules", "quality_classifier", "simhash", "pii", "packing"]
    for name, (before, after, columns) in stages.items():
        if name != "packing":
            assert columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_rules_stage(stages):
    import unicodedata

    def kept(text):
        n, chars, symbols, dup, repeats = counts(text)
        letters = sum(unicodedata.category(c)[0] == "L" for c in text)
        capitals = sum(unicodedata.category(c) == "Lu" for c in text)
        return not (n < 50 or 100 * repeats > 50 * n or 10 * symbols > n or 2 * capitals > letters
                    or not 2 * n <= chars <= 20 * n or 2 * dup > len(text.split("\n")) or 2 * letters < chars)

    before, after, _ = stages["quality_rules"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if kept(r["text"]))


def test_classifier_stage_keeps_clean_documents(stages, spark):
    before, after, _ = stages["quality_classifier"]
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert not gone & good and set(after) <= set(before)


def test_simhash_stage(stages):
    before, after, _ = stages["simhash"]
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in before}
    assert {r["doc_id"] for r in after} == set(slow_groups(prints, {i: i for i in prints}).values())
    assert set(after) <= set(before)


def test_pii_stage(stages):
    before, after, _ = stages["pii"]
    texts = {r["doc_id"]: r["text"] for r in after}
    assert set(texts) == {r["doc_id"] for r in before}
    for r in before:
        if not slow_base(r["text"]):
            assert texts[r["doc_id"]] == r["text"] or "[" in texts[r["doc_id"]]
        assert not slow_base(texts[r["doc_id"]])


def test_packing_stage(stages):
    before, after, _ = stages["packing"]
    texts = defaultdict(list)
    for r in before:
        texts[r["doc_id"]].append(r["text"])
    total, sequences = check(after, texts, 1024)
    assert sequences <= -(-total // 1024) + 4


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, SF).agg(F.count(F.lit(1)), F.sum("length")).first()
    assert rows[1] == sum(r["length"] for r in stages["packing"][1])


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_queries(spark, name):
    con = duckdb.connect()
    for table in checks.TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    verdict = checks.compare(spark, con, name, queries.QUERIES[name], queries.SQL.get(name), SF)
    assert verdict.startswith("ok" if name in queries.SQL else "rows only"), verdict


def test_thirteen_operators_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names
    assert np.all([callable(s[1]) for s in corpus_pipeline.STAGES]) and quality_rules.SAMPLE
