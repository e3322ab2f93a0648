"""The registered queries that have no SQL, over whole tables, against brute force."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_documents import exact_neighbours, fingerprint, reach
from tokenizers import Tokenizer

from hedonic.llm import catalog

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall())


def run(spark, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    return df.collect()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def encode(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return tokenizer, {k: tokenizer.encode(t, add_special_tokens=False).ids for k, t in texts.items()}


def test_op1(spark, texts):
    _, ids = encode("byte_bpe_50k.json", texts)
    assert {r["doc_id"]: r["n_tokens"] for r in run(spark, "op1_token_counts")} == {k: len(v) for k, v in ids.items()}


def test_op3(spark):
    vectors = {i: np.array(v, dtype=float) for i, v in duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()}
    want = exact_neighbours(vectors, [i for i in vectors if i % 50 == 0], 5)
    got = run(spark, "op3_nearest_neighbours")
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in got}
    pairs = {(q, i): s for q, near in want.items() for i, s in near}
    both = found.keys() & pairs.keys()
    assert len(both) >= 0.9 * len(pairs) and all(abs(found[p] - pairs[p]) < 1e-12 for p in both)
    assert sorted((r["query_id"], r["rank"]) for r in got) == sorted((q, k + 1) for q, near in want.items() for k in range(len(near)))


def test_op4(spark, texts):
    prints = [fingerprint(t) for t in texts.values()]
    label = reach(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    keys = list(texts)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op4_simhash_dedup")}
    assert got == {k: (format(p, "016x"), keys[j]) for k, p, j in zip(keys, prints, label)}


def test_op5(spark, texts):
    _, ids = encode("byte_bpe_50k.json", texts)
    want, at = {}, 0
    for k, own in ids.items():
        want[k] = (at, len(own) + 1, crc([*own, 2]))
        at += len(own) + 1
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, "op5_token_binary")} == want


def test_op6(spark, texts):
    tokenizer, ids = encode("byte_bpe_50k.json", texts)
    digest = lambda data: hashlib.sha256(data).hexdigest()
    want = {k: (len(v), digest(np.array(v, "<u4").tobytes()), digest(tokenizer.decode(v, skip_special_tokens=False).encode())) for k, v in ids.items()}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in run(spark, "op6_bpe_codec")} == want


def test_op7(spark, texts):
    got = {r["doc_id"]: r for r in run(spark, "op7_quality_classifier")}
    assert got.keys() == texts.keys()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for k, r in got.items())
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall()
    good = [got[k]["predicted"] == y for k, y in labels if got[k]["held_out"]]
    assert sum(good) >= 0.9 * len(good)


def test_op9(spark, texts):
    got = run(spark, "op9_sharding")
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["law"]) for r in got} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode()), "key") for k, t in texts.items()}
    for s in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(0 <= r["shard"] < 16 and r["grown_shard"] in (r["shard"], 16) for r in got)


def test_op10(spark, texts):
    _, ids = encode("word_bpe_49k.json", texts)
    got = run(spark, "op10_best_fit_packing")
    want = []
    for k, own in ids.items():
        own = [*own, 1]
        want += [(k, n, a, len(own[a : a + 4096]), crc(own[a : a + 4096])) for n, a in enumerate(range(0, len(own), 4096))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 4096 and len(at) <= -(-sum(w[3] for w in want) // 4096) + 1
