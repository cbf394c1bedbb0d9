from conftest import plan_of, rows

from pyspark.sql import functions as F

from tapewright.operators import dedupe


def test_keep_first_is_the_same_for_any_row_order(frame):
    data = [("a", 2, "y"), ("a", 1, "z"), ("b", 5, "q"), ("a", 1, "b"), (None, 1, "n")]
    want = [("a", 1, "b"), ("b", 5, "q"), (None, 1, "n")]
    for order in (data, data[::-1]):
        got = dedupe.keep_first(frame(order, "k string, v int, w string").repartition(3), ["k"])
        assert rows(got) == sorted(want, key=repr)


def test_keep_first_twice_is_once(frame):
    df = frame([("a", 2), ("a", 1), ("b", 1)], "k string, v int")
    once = dedupe.keep_first(df, ["k"])
    assert rows(dedupe.keep_first(once, ["k"])) == rows(once)


def test_key_only_frame_and_empty_frame(frame):
    df = frame([("a",), ("a",)], "k string")
    assert rows(dedupe.keep_first(df, ["k"])) == [("a",)]
    assert rows(dedupe.keep_first(df.limit(0), ["k"])) == []


def test_rank_bound_is_applied_before_the_exchange(frame):
    df = frame([("a", 1)], "k string, v int")
    plan = plan_of(dedupe.keep_first(df, ["k"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    got = dedupe.keep_first(hot, ["k"], ["v"])
    assert got.count() == hot.select("k").distinct().count()
    assert got.filter("k = 0").select("v").collect()[0][0] == 0


def test_nth_per_key(frame):
    df = frame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert rows(dedupe.nth_per_key(df, ["k"], [F.col("v").desc()], 2)) == [("a", 1)]


def test_top_n_splits_every_key(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    top = dedupe.top_n_per_key(df, ["k"], ["v"], 40)
    assert "_salt" in plan_of(top)
    assert rows(top) == sorted([(k, 2 * i + k, i + 1) for k in (0, 1) for i in range(40)], key=repr)


def test_texts_are_no_sort_keys(frame):
    df = frame([("a", "t", "x", 1), ("a", "s", "x", 1)], "k string, full_text string, fetched_at string, n int")
    once = dedupe.keep_first(df, ["k"])
    assert once.columns == df.columns and once.count() == 1
    keys = [line.split("], [")[0] for line in plan_of(once).split("\n") if "Sort [" in line]
    assert keys and all("full_text" not in key for key in keys)


def test_copies_are_split_by_task(spark):
    """Identical rows get different salts in different tasks, the same one when asked again."""
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    salted = copies.withColumn("s", dedupe.salt(["k", "v"], 1024))
    counts = rows(salted.groupBy("s").count())
    assert len(counts) == 8 and rows(salted.groupBy("s").count()) == counts
    assert dedupe.top_n_per_key(copies, ["k"], ["v"], 1500).count() == 1500


def test_null_keys_are_rejects(frame):
    df = frame([("a", 1), (None, 2), ("b", None)], "k string, j int")
    assert rows(dedupe.null_key_rejects(df, ["k", "j"])) == sorted([(None, 2), ("b", None)], key=repr)
    assert rows(dedupe.without_null_keys(df, ["k", "j"])) == [("a", 1)]
