import datetime as dt
import random

import pytest

from tapewright.llm import revisits

SCHEMA = (
    "record_id string, type string, target_uri string, date timestamp, status int, headers map<string,string>, "
    "payload_digest string, url string, task int, response string"
)
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def frame(spark, rows):
    return spark.createDataFrame([(i, k, u, at(m), s, h, d, "u", 1, "r") for i, k, u, m, s, h, d in rows], SCHEMA)


def slow(rows, canon):
    """Straight from the definition, for addresses that ``canon`` maps."""
    out = []
    for i, kind, uri, m, _, headers, digest in rows:
        if kind != "revisit":
            continue
        mine = {k.lower(): v for k, v in (headers or {}).items()}
        url = canon(uri)
        full = [r for r in rows if r[1] == "response" and r[4] == 200 and url is not None and canon(r[2]) == url
                and m is not None and r[3] is not None and r[3] < m]
        if not full:
            out.append((i, url, at(m), "no_response", None, None, None, None))
            continue
        best = max(full, key=lambda r: (r[3], r[0]))
        theirs = {k.lower(): v for k, v in (best[5] or {}).items()}
        pairs = [(a, b) for a, b in (
            (mine.get("etag", "").removeprefix("W/"), theirs.get("etag", "").removeprefix("W/")),
            (mine.get("last-modified"), theirs.get("last-modified")), (digest, best[6])) if a and b]
        state = "unverified" if not pairs else "resolved" if all(a == b for a, b in pairs) else "mismatch"
        merged = {**theirs, **{k: v for k, v in mine.items() if k in revisits.PERMITTED}}
        sound = state == "resolved"
        out.append((i, url, at(m), state, best[0], at(best[3]), best[6] if sound else None, merged if sound else None))
    return sorted(out, key=str)


def resolved(df):
    return sorted((tuple(r) for r in revisits.resolve(df).collect()), key=str)


def test_cases(spark):
    etag = {"ETag": '"1"', "Content-Type": "text/html", "Expires": "then"}
    rows = [
        ("a", "response", "http://h.example/x", 10, 200, etag, "d1"),
        ("b", "response", "http://h.example/x", 20, 206, {"etag": '"2"'}, "d2"),
        ("c", "revisit", "http://h.example/x", 30, 304, {"etag": 'W/"1"', "EXPIRES": "now", "Content-Type": "no"}, None),
        ("d", "revisit", "http://h.example/x", 10, 304, {"etag": '"1"'}, None),
        ("e", "revisit", "http://h.example/x", 31, 304, {"etag": '"2"'}, None),
        ("f", "revisit", "http://h.example/x", 32, 304, {}, None),
        ("g", "revisit", "http://h.example/x", 33, 304, None, "d1"),
        ("h", "revisit", "http://h.example/y", 33, 304, etag, "d1"),
        ("i", "revisit", None, 33, 304, etag, "d1"), ("j", "revisit", "http://h.example/x", None, 304, etag, "d1"),
        ("k", "response", None, 5, 200, etag, "d1"), ("l", "response", "http://h.example/z", 5, 200, None, None),
        ("l2", "response", "http://h.example/z", 5, 200, {"Last-Modified": "m"}, None),
        ("m", "revisit", "http://h.example/z", 6, 304, {"last-modified": "m"}, None),
        ("m", "revisit", "http://h.example/z", 6, 304, {"last-modified": "m"}, None), (None, "revisit", "", 7, 304, None, None),
        ("n", None, None, None, None, None, None),
    ]
    wanted = slow(rows, lambda u: u.removeprefix("http://") if u is not None else None)
    wanted = sorted([(a, b or None, *r) for a, b, *r in wanted], key=str)
    assert resolved(frame(spark, rows)) == wanted
    assert {r[3] for r in wanted} == {"no_response", "unverified", "mismatch", "resolved"}


@pytest.mark.parametrize("tasks", ["3", "40"])
def test_many_records_of_few_addresses(spark, tasks):
    """An address with most of the records reaches over many tasks, and what they end with is carried on."""
    rng = random.Random(9)
    rows = []
    for n in range(1500):
        uri = rng.choice(["http://hot.example/"] * 4 + [f"http://h{n % 30}.example/p", "http://quiet.example/"])
        kind = "response" if "quiet" not in uri and rng.random() < (0.01 if "hot" in uri else 0.3) else "revisit"
        headers = {"etag": f'"{rng.randint(1, 2)}"', "date": str(n)}
        rows.append((f"r{n:04d}", kind, uri, rng.randint(0, 600), 200, headers, rng.choice([None, "d"])))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        assert resolved(frame(spark, rows)) == slow(rows, lambda u: u.removeprefix("http://").rstrip("/"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("url, wanted", [
    ("HTTP://WWW.Example.com:80/A/b//?b=2&utm_source=x&a=1&&#f", "example.com/A/b?a=1&b=2"), ("https://u:p@h.example:443", "h.example"),
    ("http://h.example:8080/?", "h.example:8080"), ("h.example/x", "h.example/x"), (None, None), ("", ""),
])
def test_canonical_addresses(spark, url, wanted):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(revisits.canonical(df.u)).first()[0] == wanted


def test_no_rows(spark):
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).collect() == []
