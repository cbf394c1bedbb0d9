"""The registered queries without SQL against brute force on whole small tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from test_pii import slow_base
from test_sharding import check as check_shards
from test_simhash import slow_fingerprint, slow_groups

from tapewright.llm import pii, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op3(spark, texts):
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    wanted = slow_groups(prints, {i: i for i in texts})
    got = queries.QUERIES["op3_simhash"](spark, SF).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted((i, f"{prints[i]:016x}", wanted[i]) for i in texts)


def test_op7(spark, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_pii"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        base = slow_base(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(got[i]["spans"].split(","))


def test_op9(spark, texts):
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op9_packing"](spark, SF).collect():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i in texts:
        assert [s for s, _ in sorted(pieces[i])] == np.cumsum([0, *[n for _, n in sorted(pieces[i])]])[:-1].tolist()
        assert sum(n for _, n in pieces[i]) == len(ids[i])
    for its in places.values():
        assert [o for o, _ in sorted(its)] == np.cumsum([0, *[n for _, n in sorted(its)]])[:-1].tolist() and sum(n for _, n in its) <= 1024


def test_op10(spark, texts):
    rows = queries.QUERIES["op10_sharding"](spark, SF).collect()
    sizes = check_shards(rows, list(texts.items()))
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) <= max(r["size"] for r in rows)


def test_op5(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = np.array(sorted(vectors))
    table = np.stack([vectors[i] for i in ids])
    got = defaultdict(dict)
    for r in queries.QUERIES["op5_nearest"](spark, SF).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in ids[ids % 20 == 0].tolist():
        scores = table @ vectors[q]
        best = [int(i) for i in ids[np.lexsort((ids, -scores))] if i != q][:20]
        found = [got[q][k] for k in range(1, 21)]
        assert all(abs(s - float(vectors[i] @ vectors[q])) < 1e-9 for i, s in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits += len(set(best) & {i for i, _ in found})
    assert hits >= 0.9 * 20 * len(got) and len(got) == sum(ids % 20 == 0)
