"""Keyed Parquet tables whose runs write new folders and make them visible last.

A table is a folder of written versions and a list of those that are live, by
part.  A run stages its rows, reads only the live folders of the parts it
touches, writes a new version beside them, and then renames a new list into
place.  Until that rename every reader sees the old table whole, so a run that
dies at any point can simply be repeated.  One run writes a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tapewright.functions import strings
from tapewright.operators import dedupe
from tapewright.session import shared_folder

PART, VERSION = "_part", "_version"
# Documents are one part: a run appends its own rows and reads none.
LOG = "log"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing for one that is not there."""
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def release(spark: SparkSession, path: str) -> None:
    """Remove a folder of this run's own staged rows."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def live(spark: SparkSession, path: str) -> tuple[int, dict[str, list[str]]]:
    """The newest version and the folders of each part; 0 and none for a table not yet written."""
    lists = [n for n in names(spark, f"{path}/_live") if n.endswith(".json")]
    if not lists:
        return 0, {}
    text = spark.read.text(f"{path}/_live/{lists[-1]}", wholetext=True).first()[0]
    return int(lists[-1].removesuffix(".json")), json.loads(text)


def commit(spark: SparkSession, path: str, version: int, folders: dict[str, list[str]]) -> None:
    """Make a version visible: the list is written aside and renamed into place."""
    fs, target = _file_system(spark, f"{path}/_live/{version:012d}.json")
    _, aside = _file_system(spark, f"{path}/_live/.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(folders).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        raise RuntimeError(f"version {version} of {path} was written by another run")


def _rows(spark: SparkSession, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The live rows."""
    _, folders = live(spark, path)
    return _rows(spark, [f for part in folders.values() for f in part], schema)


def _stage(spark: SparkSession, batch: DataFrame, part: str) -> tuple[str, list[str]]:
    """The batch in the shared folder by part: evaluated once; its parts are known from the folders' names."""
    stage = shared_folder(spark, "stage")
    batch.withColumn(PART, F.expr(part).cast("string")).write.partitionBy(PART).parquet(stage)
    return stage, [n for n in names(spark, stage) if n.startswith(f"{PART}=")]


def _write(spark: SparkSession, rows: DataFrame, path: str, version: int, part: str) -> dict[str, str]:
    folder = f"{path}/data/{version:012d}-{uuid.uuid4().hex[:8]}"
    # Few files per part; Spark splits a part that is too large for one task.
    rows.withColumn(PART, F.expr(part).cast("string")).hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
    return {n: f"{folder}/{n}" for n in names(spark, folder) if n.startswith(f"{PART}=")}


def insert_new(
    spark: SparkSession, path: str, schema: T.StructType, batch: DataFrame, keys: Sequence[str], part: str,
    order: Sequence[str | Column] | None = None,
) -> None:
    """Insert-if-absent: new keys are written beside what is there, nothing is rewritten.

    ``part`` is an SQL expression that must follow from the key.  Of the stored rows only the key columns
    in the parts the batch touches are read.  Running a batch again adds
    nothing; rows with a NULL key are not stored.
    """
    first = dedupe.keep_first(dedupe.without_null_keys(batch, keys), keys, order)
    stage, touched = _stage(spark, first.select(*schema.fieldNames()), part)
    version, folders = live(spark, path)
    known = _rows(spark, [f for p in touched for f in folders.get(p, [])], schema).select(*keys)
    fresh = _rows(spark, [f"{stage}/{p}" for p in touched], schema).join(known, list(keys), "left_anti")
    added = _write(spark, fresh.select(*schema.fieldNames()), path, version + 1, part)
    commit(spark, path, version + 1, {p: [*folders.get(p, []), *([added[p]] if p in added else [])] for p in {**folders, **added}})
    release(spark, stage)


def replace_parts(
    spark: SparkSession, path: str, schema: T.StructType, batch: DataFrame, part: str,
    merged: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Merge a batch into the parts it touches, which are written anew; the others stay as they are.

    ``part`` is an SQL expression that must follow from the key.  ``merged`` gets the stored rows of those
    parts and the staged batch.
    """
    stage, touched = _stage(spark, batch.select(*schema.fieldNames()), part)
    version, folders = live(spark, path)
    stored = _rows(spark, [f for p in touched for f in folders.get(p, [])], schema)
    rows = merged(stored, _rows(spark, [f"{stage}/{p}" for p in touched], schema))
    written = _write(spark, rows.select(*schema.fieldNames()), path, version + 1, part)
    kept = {p: f for p, f in folders.items() if p not in touched}
    commit(spark, path, version + 1, kept | {p: [f] for p, f in written.items()})
    release(spark, stage)


# --- Documents: a log of versions -----------------------------------------------


def _with_version(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])


def append_documents(
    spark: SparkSession, path: str, schema: T.StructType, batch: DataFrame, key: str,
    order: Sequence[str | Column] | None = None, run: str | None = None, unique: bool = False,
) -> None:
    """Add the batch's documents as the newest version of their keys.

    No stored document is read or rewritten, whatever the size of the table.
    A batch that is run again adds the same version once more, unless ``run``
    names it: what a run of that name has added is not added again.  A batch
    with one row per key (``unique``) is written as it is, without an exchange.
    """
    keyed = batch.filter(~strings.is_blank(F.col(key).cast("string")))
    first = keyed if unique else dedupe.keep_first(keyed, [key], order)
    _append(spark, path, first.select(*schema.fieldNames()), run)


def _append(spark: SparkSession, path: str, rows: DataFrame, run: str | None = None) -> None:
    version, folders = live(spark, path)
    if run and any(f.rsplit("/", 1)[1].split("-", 1)[1] == run for f in folders.get(LOG, [])):
        return
    folder = f"{path}/data/{version + 1:012d}-{run or uuid.uuid4().hex[:8]}"
    # A run that died here may have left files of the same name.
    rows.withColumn(VERSION, F.lit(version + 1).cast("bigint")).write.mode("overwrite").parquet(folder)
    commit(spark, path, version + 1, {LOG: [*folders.get(LOG, []), folder]})


def documents(
    spark: SparkSession, path: str, schema: T.StructType, key: str, keep_if_blank: Sequence[str] = ()
) -> DataFrame:
    """The newest version of each document; a column in ``keep_if_blank`` has its newest text that is not blank.

    Keys and versions are compared first; texts are read for the versions that count.
    Nothing is newer than the last version, so its rows are not compared and not exchanged.
    """
    last, folders = live(spark, path)
    log = _rows(spark, folders.get(LOG, []), _with_version(schema))

    def newest(rows: DataFrame) -> DataFrame:
        heads = rows.groupBy(key).agg(F.max(VERSION).alias(VERSION))
        older = rows.filter(F.col(VERSION) < last).join(heads, [key, VERSION]).select(*rows.columns)
        return rows.filter(F.col(VERSION) >= last).unionByName(older)

    found = newest(log.drop(*keep_if_blank)).drop(VERSION)
    for column in keep_if_blank:
        texts = newest(log.filter(~strings.is_blank(F.col(column))).select(key, VERSION, column)).drop(VERSION)
        found = found.join(texts, key, "left").withColumn(column, F.coalesce(column, F.lit("")))
    return found.select(*schema.fieldNames())


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, keep_if_blank: Sequence[str] = ()) -> None:
    """The same documents as one version."""
    version, _ = live(spark, path)
    folder = f"{path}/data/{version + 1:012d}-{uuid.uuid4().hex[:8]}"
    rows = documents(spark, path, schema, key, keep_if_blank)
    rows.withColumn(VERSION, F.lit(version + 1).cast("bigint")).write.parquet(folder)
    commit(spark, path, version + 1, {LOG: [folder]})


def reset_documents(
    spark: SparkSession, path: str, schema: T.StructType, key: str, condition: Column, column: str, value="",
) -> None:
    """Set one column wherever the condition holds on the stored documents.

    What is read is what is kept: a reset text is not replaced by an older one,
    so the table is compacted on the way.
    """
    from tapewright.operators import merge

    version, _ = live(spark, path)
    folder = f"{path}/data/{version + 1:012d}-{uuid.uuid4().hex[:8]}"
    rows = merge.reset_where(documents(spark, path, schema, key, [column]), condition, column, value)
    rows.withColumn(VERSION, F.lit(version + 1).cast("bigint")).write.parquet(folder)
    commit(spark, path, version + 1, {LOG: [folder]})
