"""Not-modified revisits of web archives, resolved to the latest earlier full response."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tapewright.llm.common import written

# The headers that an answer "not modified" may bring up to date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
RECORD = ("record_id", "type", "target_uri", "date", "status", "headers", "payload_digest")


def canonical(url: Column) -> Column:
    """The address without scheme, ``www.``, user, default port, fragment, campaign parameters and last slashes.

    The host is in lower case, the query's parts are sorted.  NULL stays NULL.
    """
    rest = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then agree the last value stays."""
    named = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["key"] == e["key"]))
    return F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>"))


def _asof(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each revisit with the last full response before it, as far as this task has it.

    Rows come sorted by address and date.  The last row out of a task says
    which response its last address ends with.
    """
    task = TaskContext.get().partitionId()
    held: pa.RecordBatch | None = None
    url, end = None, None
    for batch in batches:
        # The last response so far goes before the batch as if it were part of it.
        rows = pa.Table.from_batches([b for b in (held, batch) if b is not None]).combine_chunks().to_batches()[0]
        address = rows.column("url").to_numpy(zero_copy_only=False)
        place = np.arange(len(rows))
        full = rows.column("full").to_numpy(zero_copy_only=False)
        begin = np.maximum.accumulate(np.where(np.append(True, address[1:] != address[:-1]), place, 0))
        last = np.maximum.accumulate(np.where(full, place, -1))
        last = np.where(last >= begin, last, -1)
        fresh = 0 if held is None else 1
        want = place[(place >= fresh) & rows.column("revisit").to_numpy(zero_copy_only=False)]
        if len(want):
            yield _out(rows, want, last[want], task)
        url = address[-1]
        end = rows.slice(int(last[-1]), 1) if last[-1] >= 0 else None
        held = end
    if url is not None:
        kind = batch.schema.field("record").type
        answer = end.column("record") if end is not None else pa.nulls(1, kind)
        yield _batch(pa.array([url]), pa.nulls(1, kind), answer, task, True)


def _out(rows: pa.RecordBatch, at: np.ndarray, found: np.ndarray, task: int) -> pa.RecordBatch:
    answer = rows.column("record").take(pa.array(np.where(found < 0, 0, found), mask=found < 0))
    return _batch(rows.column("url").take(pa.array(at)), rows.column("record").take(pa.array(at)), answer, task, False)


def _batch(url: pa.Array, record: pa.Array, response: pa.Array, task: int, ends: bool) -> pa.RecordBatch:
    n = len(url)
    return pa.record_batch(
        [url, record, response, pa.array([task] * n, pa.int64()), pa.array([ends] * n)],
        ["url", "record", "response", "task", "ends"])


def _value(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda e: e["key"] == name), F.lit(0))["value"]


def _agrees(a: Column, b: Column) -> Column:
    """NULL unless both are there."""
    return F.when(a.isNotNull() & b.isNotNull(), a == b)


def resolve(records: DataFrame, permitted: Sequence[str] = PERMITTED) -> DataFrame:
    """One row per revisit: ``record_id, url, date, resolution, response_id, response_date, payload_digest, headers``.

    Records have ``record_id, type, target_uri, date, status, headers,
    payload_digest``; other columns are not looked at.  A full response has
    type ``response`` and status 200.  A revisit takes the latest one that is
    strictly earlier at the same canonical address; of several at one instant
    the one with the largest id.  Entity tags (compared weakly), dates of last
    modification and digests that both have must all agree.

    ``resolution`` is ``resolved``; ``mismatch`` if a validator differs;
    ``unverified`` if they share none; ``no_response`` if there is none earlier
    (a NULL address or date has none).  A resolved revisit has the response's
    digest, and its headers with the permitted ones of the revisit over them,
    names in lower case; the others have NULL there.  Repeated records are
    resolved each, an empty table gives no rows.

    Records are sorted across tasks by address and date, and what a task ends
    with is carried on to the next, so an address with a third of all records
    is spread like any other.  Payloads are not moved.
    """
    record = F.struct("record_id", "date", _lower_names(F.col("headers")).alias("headers"), "payload_digest").alias("record")
    known = records.select(*RECORD).withColumn("url", canonical(F.col("target_uri")))
    lost = F.col("url").isNull() | F.col("date").isNull()
    full = (F.col("type") == "response") & (F.col("status") == 200) & ~lost
    revisit = F.col("type") == "revisit"
    rows = known.select(
        F.coalesce("url", F.lit("")).alias("url"), "date", F.coalesce(full, F.lit(False)).alias("full"),
        F.coalesce(revisit, F.lit(False)).alias("revisit"), F.col("record_id").alias("id"), record,
    ).filter("full OR revisit")
    # At one instant revisits come first: they see only what is earlier.
    order = ["url", "date", "full", "id"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    part = sorted_.schema["record"].dataType
    schema = T.StructType([
        T.StructField("url", T.StringType()), T.StructField("record", part), T.StructField("response", part),
        T.StructField("task", T.LongType()), T.StructField("ends", T.BooleanType())])
    local = written(sorted_.mapInArrow(_asof, schema), "revisits")
    # One row per task.
    ends = local.filter("ends").select(F.col("url").alias("u"), F.col("task").alias("k"), F.col("response").alias("carried"))
    return _resolved(local.filter("NOT ends"), written(ends, "ends"), permitted)


def _resolved(local: DataFrame, ends: DataFrame, permitted: Sequence[str]) -> DataFrame:
    # The first address of a task goes on from the tasks before it that end with the same address.
    before = Window.partitionBy("u").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    firsts = local.groupBy("task").agg(F.min("url").alias("u")).select(F.col("task").alias("k"), "u")
    steps = ends.unionByName(firsts, allowMissingColumns=True).groupBy("u", "k").agg(F.first("carried", ignorenulls=True).alias("carried"))
    past = steps.withColumn("past", F.last("carried", ignorenulls=True).over(before)).filter("past IS NOT NULL")
    past = written(past.select("u", "k", "past"), "carried")
    met = local.join(past, (F.col("url") == F.col("u")) & (F.col("task") == F.col("k")), "left")
    mine, found = F.col("record"), F.coalesce("response", "past")
    found = F.when((F.col("url") != "") & mine["date"].isNotNull(), found)
    met = met.select("url", mine.alias("mine"), found.alias("found"))
    mine, found = F.col("mine"), F.col("found")

    def tag(headers: Column) -> Column:
        return F.regexp_replace(_value(headers, "etag"), "^W/", "")

    checks = F.array(
        _agrees(tag(mine["headers"]), tag(found["headers"])),
        _agrees(_value(mine["headers"], "last-modified"), _value(found["headers"], "last-modified")),
        _agrees(mine["payload_digest"], found["payload_digest"]))
    checks = F.filter(checks, lambda c: c.isNotNull())
    resolution = (
        F.when(found.isNull(), "no_response").when(F.size(checks) == 0, "unverified")
        .when(F.exists(checks, lambda c: ~c), "mismatch").otherwise("resolved"))
    newer = F.filter(mine["headers"], lambda e: e["key"].isin(list(permitted)))
    kept = F.filter(found["headers"], lambda e: ~F.exists(newer, lambda n: n["key"] == e["key"]))
    sound = F.col("resolution") == "resolved"
    return met.withColumn("resolution", resolution).select(
        mine["record_id"].alias("record_id"), F.when(F.col("url") != "", F.col("url")).alias("url"), mine["date"].alias("date"),
        "resolution", found["record_id"].alias("response_id"), found["date"].alias("response_date"),
        F.when(sound, found["payload_digest"]).alias("payload_digest"),
        F.when(sound, F.map_from_entries(F.array_sort(F.concat(kept, newer)))).alias("headers"))
