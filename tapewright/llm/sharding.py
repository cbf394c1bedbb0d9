"""K-d tree partitioning of documents into shards of equal bytes.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tapewright.llm.common import crc_of, written

# Bins of one histogram round, and the share of a node that a cut may miss its half by.
BINS = 1024
MISS = 1e-4
# Ties are numbers below this.
TIES = 1 << 62


def ranked(rows: DataFrame, column: str, name: str) -> DataFrame:
    """The rows with the place of a string among all distinct ones in order, from 1; NULL: 0.

    Whole strings are sorted across tasks and numbered there, however long they are and however much they agree in.
    """
    distinct = rows.select(F.col(column).alias("_string")).filter("_string IS NOT NULL").distinct().withColumn("_all", F.lit(0))
    places = slots(distinct, "_all", ["_string"]).select("_string", (F.col("slot") + 1).alias(name))
    return rows.join(places, F.col(column) == F.col("_string"), "left").drop("_string").withColumn(
        name, F.coalesce(name, F.lit(0).cast("bigint")))


def _values(spark: SparkSession, names: str, rows: Sequence[Sequence[int]]) -> DataFrame:
    """A few rows as part of the plan, so that Spark knows their size: one per open node."""
    listed = ", ".join(f"({', '.join(f'{x}L' for x in row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({names})")


def _crossings(rows: DataFrame, asked: list[dict]) -> dict[int, dict]:
    """Of each node the bin in which its weight passes the share that goes left (``half``): one histogram round for all nodes.

    Bins are added up inside the map tasks; what is exchanged are the bins, at
    most ``BINS`` of a node.
    """
    spark = rows.sparkSession
    wanted = _values(spark, "node, dim, tied, v, lo, hi, width, half", [
        [q["node"], q["dim"], q["tied"], q["v"], q["lo"], q["hi"], max(1, -(-(q["hi"] - q["lo"] + 1) // BINS)), q["half"]]
        for q in asked])
    met = rows.join(wanted, "node").withColumn("x", F.get("dims", F.col("dim").cast("int")))
    met = met.filter((F.col("tied") == 0) | (F.col("x") == F.col("v")))
    met = met.withColumn("y", F.when(F.col("tied") == 1, F.col("tie")).otherwise(F.col("x")))
    met = met.filter("y BETWEEN lo AND hi").withColumn("bin", F.expr("(y - lo) div width"))
    bins = met.groupBy("node", "half", "bin").agg(
        F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"), F.min("y").alias("least"), F.max("y").alias("most"))
    upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
    passed = bins.withColumn("upto", upto).filter("upto >= half")
    first = passed.groupBy("node").agg(F.min_by(F.struct("w", "n", "least", "most", "upto"), "bin").alias("b"))
    return {r["node"]: r["b"].asDict() for r in first.collect()}


def _cuts(rows: DataFrame, nodes: list[dict]) -> list[tuple[int, int, int, int]]:
    """(node, dimension, value, tie): up to and with that value, and within it that tie, a row goes left.

    Each round narrows every node's bin to the one that holds the weighted
    median.  Where a single value holds it, rows of that value are told apart
    by their ties, so a value with a third of all rows is cut like any other.
    """
    asked = [dict(n, tied=0, v=0, miss=int(n["w"] * MISS)) for n in nodes]
    done = []
    while asked:
        found, todo = _crossings(rows, asked), []
        for q in asked:
            b = found[q["node"]]
            before = b["upto"] - b["w"]
            if b["w"] > q["miss"] and b["least"] < b["most"]:
                # The bin alone is looked at next: what lies before it is taken off the half.
                todo.append(dict(q, lo=b["least"], hi=b["most"], half=q["half"] - before))
            elif not q["tied"] and b["n"] > 1 and b["w"] > q["miss"]:
                todo.append(dict(q, tied=1, v=b["most"], lo=0, hi=TIES - 1, half=q["half"] - before))
            else:
                # The last bin goes to the side that then lies nearer to the half.
                left = 2 * q["half"] >= b["w"] + 2 * before
                done.append(_cut(q, b["most"] if left else b["least"] - 1))
        asked = todo
    return done


def _cut(q: dict, at: int) -> tuple[int, int, int, int]:
    return (q["node"], q["dim"], q["v"], at) if q["tied"] else (q["node"], q["dim"], at, TIES)


def tree(rows: DataFrame, target: int, depth: int | None = None, shards: int | None = None) -> DataFrame:
    """The rows (``size``, ``dims``, ``tie`` and more) with ``leaf``, the place of their leaf from the left.

    A node is cut in two at the weighted median of its widest dimension
    (against the width at the root) while it has more than one and a half times
    the target, and not below ``depth`` levels.  With ``shards`` a node is cut
    while it is to hold several of them, in proportion to those on either side,
    and ``leaf`` is the shard.  A node of rows that are alike stays whole.  The
    driver sees a row per open node and round: leaves are as many as the caller
    asks for, not as the rows are.
    """
    one = rows.select(F.size("dims").alias("n")).first()
    n_dims = one["n"] if one else 0
    nodes = rows.withColumn("node", F.lit(1).cast("bigint"))
    level, widths = 0, None
    # First shard and number of shards of each node.
    held = {1: (0, shards or 1)}
    while n_dims and (depth is None or level < depth):
        ends = [f(F.get("dims", F.lit(i))).alias(f"{name}{i}") for i in range(n_dims) for name, f in (("a", F.min), ("z", F.max))]
        stats = nodes.groupBy("node").agg(
            F.sum("size").alias("w"), F.min("tie").alias("t0"), F.max("tie").alias("t1"), *ends)
        open_ = []
        for r in stats.collect():
            spans = [r[f"z{i}"] - r[f"a{i}"] for i in range(n_dims)]
            widths = widths or [max(1, s) for s in spans]
            alike = not any(spans) and r["t0"] == r["t1"]
            first, n = held.get(r["node"], (0, 2))
            if (n > 1 if shards else r["w"] * 2 > 3 * target) and not alike:
                dim = max(range(n_dims), key=lambda i: spans[i] / widths[i])
                left, of = (n // 2, n) if shards else (1, 2)
                open_.append({"node": r["node"], "w": r["w"], "dim": dim, "lo": r[f"a{dim}"], "hi": r[f"z{dim}"], "half": -(-r["w"] * left // of)})
                held |= {2 * r["node"]: (first, left), 2 * r["node"] + 1: (first + left, n - left)}
        if not open_:
            break
        cuts = _values(rows.sparkSession, "node, dim, v, t", _cuts(nodes, open_))
        x = F.get("dims", F.col("dim").cast("int"))
        right = (x > F.col("v")) | ((x == F.col("v")) & (F.col("tie") > F.col("t")))
        moved = nodes.join(cuts, "node", "left").withColumn(
            "node", F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + right.cast("bigint")))
        nodes = written(moved.drop("dim", "v", "t"), "tree")
        level += 1
    found = sorted(r["node"] for r in nodes.select("node").distinct().collect())
    if not found:
        return nodes.withColumn("leaf", F.lit(0)).drop("node")
    deepest = max(found).bit_length()
    places = sorted(found, key=lambda n: n << deepest - n.bit_length())
    numbered = [(n, held[n][0] if shards else i) for i, n in enumerate(places)]
    return nodes.join(_values(rows.sparkSession, "node, place", numbered), "node").select(
        *[c for c in nodes.columns if c != "node"], F.col("place").cast("int").alias("leaf"))


def slots(rows: DataFrame, shard: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``slot``: their place within the shard, from 0 without gaps.

    Rows are sorted across tasks, each task numbers its own, and the few
    counts per task and shard are added up: no task ever holds a shard.
    """
    ranged = rows.repartitionByRange(shard, *order).sortWithinPartitions(shard, *order)
    placed = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "slots")
    task = F.shiftright("_at", 33).alias("_task")
    counts = placed.groupBy(task, shard).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(shard).orderBy("_task")) - F.col("_n")
    starts = written(counts.withColumn("_before", before), "starts")
    met = placed.withColumn("_task", task).join(starts, ["_task", shard])
    return met.withColumn("slot", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_task", "_first", "_n", "_before")


def sharded(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text",
    dims: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The tree cuts the bytes in two, in proportion to the shards on either side,
    until a leaf is a shard.  ``shards`` may be any number.  Dimensions are the
    size, and the places of the language and of the source among all of them in
    order.  Equal texts have neighbouring ties, so they stay together unless a
    cut goes through them.

    A NULL text has size 1 and the sum of no bytes; NULL dimensions are the
    smallest; repeated rows that are alike in key and text are never parted.
    A table with fewer rows than shards leaves some empty; an empty one gives
    no rows.  Only key, size, checksum and dimensions are ever exchanged.
    """
    if shards < 1:
        raise ValueError("shards count from one")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    low = F.lit((1 << 31) - 1)
    tie = F.shiftleft(F.xxhash64(text).bitwiseAND(low), 31).bitwiseOR(F.xxhash64(key).bitwiseAND(low))
    strings = [c for c in ("lang", "source") if dims is None and c in docs.columns]
    named = {f"_d{i}": c.cast("bigint") for i, c in enumerate((dims or {}).values())} | {f"_s{i}": F.col(c).cast("string") for i, c in enumerate(strings)}
    rows = written(docs.select(
        F.col(key).cast("bigint").alias("doc_id"), size.alias("size"), crc_of(F.col(text)).alias("text_crc32"), tie.alias("tie"),
        *[c.alias(n) for n, c in named.items()]), "sizes")
    for i in range(len(strings)):
        rows = ranked(rows, f"_s{i}", f"_r{i}")
    values = [F.coalesce(n, F.lit(0).cast("bigint")) for n in named if n.startswith("_d")] + [F.col(f"_r{i}") for i in range(len(strings))]
    rows = written(rows.select("doc_id", "size", "text_crc32", "tie", F.array("size", *values).alias("dims")), "points")
    leaves = tree(rows, 1, shards=shards)
    placed = slots(leaves.withColumnRenamed("leaf", "shard"), "shard", ["tie", "doc_id"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
