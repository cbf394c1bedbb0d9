import pytest
from conftest import day, plan_of, rows

from pyspark.sql import functions as F

from tapewright import schemas, sinks
from tapewright.operators import merge
from tapewright.sinks import store

KV = "k string, v int"


def test_insert_if_absent(frame):
    stored = frame([("a", 1)], KV)
    batch = frame([("a", 9), ("b", 3), ("b", 2), (None, 5)], KV)
    once = merge.insert_if_absent(stored, batch, ["k"])
    assert rows(once) == [("a", 1), ("b", 2)]
    assert rows(merge.insert_if_absent(once, batch, ["k"])) == rows(once)


def _bar(ticker, date, open_, close):
    return (ticker, day(date), open_, 2.0, 0.5, close, 10, 1.0, None)


BAR = "ticker string, date date, open double, high double, low double, close double, volume bigint, vwap double, fetched_at string"


def test_price_upsert_keeps_the_open_and_stores_nulls(frame):
    stored = frame([_bar("a", "2024-01-01", 1.0, 1.5), _bar("a", "2024-01-02", None, 2.0)], BAR)
    batch = frame([_bar("a", "2024-01-01", 9.0, None), _bar("a", "2024-01-02", 8.0, 3.0),
                   _bar("b", "2024-01-01", 7.0, 4.0)], BAR)
    once = merge.upsert_prices(stored, batch)
    got = {(r.ticker, str(r.date)): (r.open, r.close) for r in once.collect()}
    assert got == {("a", "2024-01-01"): (1.0, None), ("a", "2024-01-02"): (None, 3.0), ("b", "2024-01-01"): (7.0, 4.0)}
    assert rows(merge.upsert_prices(once, batch)) == rows(once)


def test_article_upsert(frame):
    stored = merge.with_content_fields(frame([("u", "old", "text")], "url string, title string, content string"))
    batch = frame([("u", None, ""), ("v", "new", "abc"), ("", "x", "y"), (None, "x", "y")],
                  "url string, title string, content string")
    assert rows(merge.upsert_articles(stored, batch)) == [("u", None, "", 0, False), ("v", "new", "abc", 3, True)]


def test_filing_texts_are_kept_when_the_new_text_is_empty(frame):
    ddl = "accession_number string, form_type string, full_text string"
    stored = frame([("a", "x", "text"), ("b", "x", "text"), ("c", "x", None), ("d", "x", "same")], ddl)
    batch = frame([("a", "y", ""), ("b", "y", "newer"), ("c", "y", None), ("e", "y", None)], ddl)
    got = merge.upsert_filing_texts(stored, batch)
    want = [("a", "y", "text"), ("b", "y", "newer"), ("c", "y", ""), ("d", "x", "same"), ("e", "y", "")]
    assert rows(got) == want
    assert rows(merge.upsert_filing_texts(got, batch)) == want


def test_reset_where(frame):
    df = frame([("a", "x"), ("b", ""), ("c", None)], "k string, t string")
    got = merge.reset_where(df, F.col("t") > "", "t")
    assert rows(got) == [("a", ""), ("b", ""), ("c", None)]


def test_insert_twice(spark, frame, tmp_path):
    path, schema = str(tmp_path / "t"), frame([], KV).schema
    assert rows(store.read(spark, path, schema)) == []
    for batch in ([("a", 1)], [("a", 9), ("b", 2), (None, 3)], [("a", 9), ("b", 2)]):
        store.insert_new(spark, path, schema, frame(batch, KV), ["k"], "k")
    assert rows(store.read(spark, path, schema)) == [("a", 1), ("b", 2)]


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_replace_parts_writes_only_touched_parts(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "k string, v int, part string"
    upsert = lambda old, new: merge.upsert(old, new, ["k"])
    stored = frame([("a", 1, "p"), ("b", 1, "q"), ("n", 1, None)], ddl)
    store.replace_parts(spark, path, stored.schema, stored, "part", upsert)
    before = store.live(spark, path)[1]
    for _ in range(2):
        store.replace_parts(spark, path, stored.schema, frame([("a", 2, "p"), ("c", 3, "r")], ddl), "part", upsert)
    after = store.live(spark, path)[1]
    assert rows(store.read(spark, path, stored.schema)) == sorted([("a", 2, "p"), ("b", 1, "q"), ("c", 3, "r"), ("n", 1, None)], key=repr)
    assert after["_part=q"] == before["_part=q"] and after["_part=p"] != before["_part=p"]


def test_a_run_that_dies_before_the_switch_leaves_the_table_whole(spark, frame, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "t"), "k string, v int, part string"
    upsert = lambda old, new: merge.upsert(old, new, ["k"])
    stored, batch = frame([("a", 1, "p"), ("b", 1, "p")], ddl), frame([("a", 2, "p")], ddl)
    store.replace_parts(spark, path, stored.schema, stored, "part", upsert)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(store, "commit", lost)
        with pytest.raises(RuntimeError):
            store.replace_parts(spark, path, stored.schema, batch, "part", upsert)
    assert rows(store.read(spark, path, stored.schema)) == [("a", 1, "p"), ("b", 1, "p")]
    store.replace_parts(spark, path, stored.schema, batch, "part", upsert)
    assert rows(store.read(spark, path, stored.schema)) == [("a", 2, "p"), ("b", 1, "p")]


def test_two_runs_cannot_write_the_same_version(spark, tmp_path):
    path = str(tmp_path / "t")
    store.commit(spark, path, 1, {})
    with pytest.raises(RuntimeError):
        store.commit(spark, path, 1, {"x": []})


DOC = "k string, form string, text string"


def test_documents_are_appended_and_never_rewritten(spark, frame, tmp_path):
    path, schema = tmp_path / "d", frame([], DOC).schema
    first = [(str(i), "old", f"text {i}") for i in range(200)]
    store.append_documents(spark, str(path), schema, frame(first, DOC), "k")
    before = _files(path)
    again = [("1", "new", ""), ("2", "new", "newer"), ("x", "new", None), (None, "new", "lost"), ("2", "new", "newer")]
    for _ in range(2):
        store.append_documents(spark, str(path), schema, frame(again, DOC), "k")
    assert before.items() <= _files(path).items()
    want = {k: (form, text) for k, form, text in first} | {"1": ("new", "text 1"), "2": ("new", "newer"), "x": ("new", "")}
    read = lambda: {r[0]: tuple(r)[1:] for r in store.documents(spark, str(path), schema, "k", ["text"]).collect()}
    assert read() == want
    store.compact(spark, str(path), schema, "k", ["text"])
    assert read() == want
    store.reset_documents(spark, str(path), schema, "k", F.col("form") == "new", "text")
    assert read() == want | {k: ("new", "") for k in ("1", "2", "x")}
    plain = store.documents(spark, str(path), schema, "k")
    assert rows(plain.filter("k = '2'")) == [("2", "new", "")]


def test_only_keys_of_touched_parts_are_read(spark, frame, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "t"), "k string, v string, part string"
    schema = frame([], ddl).schema
    store.insert_new(spark, path, schema, frame([("a", "x", "p"), ("b", "x", "q")], ddl), ["k"], "part")
    plans, folders = [], []
    write, read = store._write, store._rows
    monkeypatch.setattr(store, "_write", lambda spark, rows, *a: (plans.append(plan_of(rows)), write(spark, rows, *a))[1])
    monkeypatch.setattr(store, "_rows", lambda spark, where, *a: (folders.extend(where), read(spark, where, *a))[1])
    store.insert_new(spark, path, schema, frame([("c", "x", "q")], ddl), ["k"], "part")
    assert [f.rpartition("/")[2] for f in folders if f.startswith(path)] == ["_part=q"]
    scans = [line for line in plans[0].split("\n") if "FileScan" in line]
    assert len(scans) == 2 and sum("ReadSchema: struct<k:string>" in s for s in scans) == 1


def test_dual_sink_splits_and_counts(spark, frame, tmp_path):
    df = frame([("acme", "1", "2024-01-01", "long"), ("acme", "2", "bad", "text")],
               "ticker string, accession_number string, filed_at string, full_text string")
    table, docs = str(tmp_path / "t"), str(tmp_path / "d")
    count = sinks.dual(df, schemas.FILING_TABLE, lambda d: d.write.parquet(table),
                       lambda d: sinks.collection(d, "json", path=docs))
    assert count == 2
    stored = spark.read.parquet(table)
    assert "full_text" not in stored.columns
    assert rows(stored.select("accession_number", "filed_at")) == sorted([("1", day("2024-01-01")), ("2", None)], key=repr)
    assert rows(spark.read.json(docs).select("full_text")) == [("long",), ("text",)]


def test_csv_round_trip(spark, frame, tmp_path):
    df = frame([("a, \"b\"", 1), (None, 2), ("line\nbreak\r\n \"", 3), ("", 4), (" \\ ", 5), ("\\N?", 6)], KV)
    sinks.csv(df, str(tmp_path / "c"))
    assert rows(sinks.read_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)


@pytest.mark.parametrize("hot", [0.34])
def test_merge_with_a_hot_key_in_the_batch(spark, hot):
    batch = spark.range(3000).select(
        F.when(F.col("id") < 3000 * hot, 0).otherwise(F.col("id")).cast("string").alias("k"), F.col("id").alias("v"))
    stored = spark.range(1, 2).select(F.lit("2999").alias("k"), F.col("id").alias("v"))
    got = merge.insert_if_absent(stored, batch, ["k"])
    assert got.count() == batch.select("k").distinct().count()
    assert got.filter("k = '0'").first().v == 0
    assert got.filter("k = '2999'").first().v == 1
