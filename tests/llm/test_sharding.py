import zlib

import pytest
from awkward import awkward, docs, none  # noqa: F401
from pyspark.sql import functions as F

from tapewright.llm import sharding


def check(rows, texts):
    assert len(rows) == len(texts)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    for shard in by_shard.values():
        assert sorted(r["slot"] for r in shard) == list(range(len(shard)))
    wanted = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == wanted
    return {k: sum(r["size"] for r in v) for k, v in by_shard.items()}


def test_awkward_documents(docs):  # noqa: F811
    check(sharding.sharded(docs).collect(), [(r[0], r[1]) for r in awkward()])


@pytest.mark.parametrize("shards", [1, 2, 8, 16])
def test_shards_have_equal_bytes(spark, shards):
    """A third of the rows are copies of one source; one language only."""
    rows = [(i, "copy " * 40 if i % 3 == 0 else f"text {i} " * (i % 50 + 1), "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    sizes = check(sharding.sharded(frame, shards).collect(), [r[:2] for r in rows])
    assert len(sizes) == shards and max(sizes.values()) - min(sizes.values()) <= 3 * 500


def test_each_cut_is_the_weighted_median_of_the_widest_dimension(spark):
    rows = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("size"), F.array(F.col("id") % 10, F.col("id")).alias("dims"), F.xxhash64("id").bitwiseAND(F.lit((1 << 62) - 1)).alias("tie"))
    leaves = {r["leaf"]: r for r in sharding.tree(rows, 250, 2).groupBy("leaf").agg(
        F.sum("size").alias("w"), F.min(F.col("dims")[0]).alias("a"), F.max(F.col("dims")[0]).alias("z"),
        F.min(F.col("dims")[1]).alias("b"), F.max(F.col("dims")[1]).alias("y")).collect()}
    # Both are as wide at the root, so the first is cut; then the second is the widest.
    assert [leaves[i]["w"] for i in range(4)] == [250] * 4
    assert [(leaves[i]["a"], leaves[i]["z"]) for i in range(4)] == [(0, 4), (0, 4), (5, 9), (5, 9)]
    assert leaves[0]["y"] < leaves[1]["b"] and leaves[2]["y"] < leaves[3]["b"]


def test_leaves_reach_the_target(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 97 + 1).alias("size"), F.array(F.col("id") % 1000, F.hash("id").cast("bigint")).alias("dims"), F.col("id").alias("tie"))
    sizes = [r["w"] for r in sharding.tree(rows, 3000).groupBy("leaf").agg(F.sum("size").alias("w")).collect()]
    assert max(sizes) <= 4500 and min(sizes) >= 1400


def test_rows_that_are_alike_stay_whole(spark):
    rows = spark.range(100).select(F.lit(1).cast("bigint").alias("size"), F.array(F.lit(5).cast("bigint")).alias("dims"), F.lit(7).cast("bigint").alias("tie"))
    assert sharding.tree(rows, 10).select("leaf").distinct().count() == 1


def test_whole_strings_are_ranked(spark):
    names = ["", "a", "ab", "b", "https://site0/a", "https://site0/b", "https://site1", "src1", "src10", "src2", "é"]
    frame = spark.createDataFrame([(n,) for n in [*names, None, "b", "b"]], "n string")
    got = {(r["n"], r["c"]) for r in sharding.ranked(frame, "n", "c").collect()}
    assert got == {(n, i) for i, n in enumerate(names, 1)} | {(None, 0)}


def test_sources_with_a_common_prefix_are_split(spark):
    rows = [(i, f"text {i:04d}", "en", f"https://site{i % 4}.example/") for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = sharding.sharded(frame, 4).join(frame.select("doc_id", "source"), "doc_id")
    assert got.groupBy("shard").agg(F.count_distinct("source").alias("n")).agg(F.max("n")).first()[0] <= 2


@pytest.mark.parametrize("shards", [3, 5, 6, 7, 12])
def test_any_number_of_shards_is_even(spark, shards):
    rows = [(i, f"text {i} " * (i % 50 + 1), "en", f"s{i % 7}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    sizes = check(sharding.sharded(frame, shards).collect(), [r[:2] for r in rows])
    assert sorted(sizes) == list(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 6 * 550


def test_no_shards_are_refused(spark):
    with pytest.raises(ValueError):
        sharding.sharded(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), 0)


def test_no_rows(none):  # noqa: F811
    assert sharding.sharded(none).collect() == []


def test_main_path_is_native(docs):  # noqa: F811
    plan = sharding.sharded(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
