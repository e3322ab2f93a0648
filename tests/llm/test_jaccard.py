"""The near-duplicate stage against brute-force Jaccard on planted near copies."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from helpers import documents, empty, sentence, words

import corpus_pipeline
from hedonic.llm import jaccard


def shingles(text, n=5):
    own = words((text or "").lower())
    return frozenset(tuple(own[i : i + n]) for i in range(max(len(own) - n + 1, min(len(own), 1))))


def planted(seed):
    """Base texts, each with copies of which up to a few words differ, and a line that many share."""
    rnd, out = random.Random(seed), []
    for base in range(12):
        own = sentence(rnd, rnd.randint(30, 150)).split()
        for _ in range(1 if base % 3 else 35):
            copy = list(own)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = "edit%d" % rnd.randrange(10**6)
            out.append(" ".join(copy))
        out.append(" ".join(own + [f"more{base}"]))
    line = sentence(rnd, 30)
    out += [f"{line} {sentence(rnd, 3)}" for _ in range(30)] + ["", None, "one", "two words", "two words", "a b c d e", "A b c d E"]
    rnd.shuffle(out)
    return out


def kept_by_force(texts):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [k for k in range(len(texts)) if find(k) == k]


@pytest.mark.parametrize("joined", [8, 24])
def test_stage_equals_brute_force(spark, tmp_path, joined, monkeypatch):
    texts = planted(1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    if joined == 8:
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 20)
        kept = jaccard.keep_one(docs, joined_at_most=8)
    else:
        kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == kept_by_force(texts)


def test_fingerprints_link_the_closest_copies_first(spark, tmp_path, monkeypatch):
    """The stage's first edges are the similar ones of SimHash, and what it hands on is what they leave."""
    rnd = random.Random(5)
    texts = [sentence(rnd, 400) for _ in range(12)]
    texts += [f"{t} and one" for t in texts] + [f"{t} {sentence(rnd, 40)}" for t in texts] + ["", "one", "two words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    seen, plain = [], jaccard.fingerprint_links

    def kept(prints, *rest):
        found = plain(prints, *rest)
        seen.append(([tuple(r) for r in prints.collect()], [(r["u"], r["v"]) for r in found.collect()]))
        return found

    monkeypatch.setattr(jaccard, "fingerprint_links", kept)
    out = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in out.collect()) == kept_by_force(texts)
    (prints, found), = seen
    sets = jaccard.shingle_sets(docs, 5, {}, "text").select(F.xxhash64("set").alias("sid"), "set").collect()
    sets, least = {r["sid"]: set(r["set"]) for r in sets}, {}
    bit = lambda values, k: 2 * sum(v >> k & 1 for v in values) > len(values)
    for sid, fp in prints:
        assert all((fp >> k & 1) == bit(sets[sid], k) for k in range(64))
        least[fp] = min(sid, least.get(fp, sid))
    alike = lambda x, y: 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])
    close = {frozenset((least[f], least[g])) for f in least for g in least if f != g and ((f ^ g) & (2**64 - 1)).bit_count() <= 2}
    close |= {frozenset((sid, least[fp])) for sid, fp in prints if sid != least[fp]}
    want = {pair for pair in close if alike(*pair)}
    assert {frozenset(pair) for pair in found} == want and len(found) == len(want) > 8


def test_odd_rows_and_columns(spark):
    docs = documents(spark, clashing=True)
    kept = jaccard.keep_one(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.schema == docs.schema and -5 in ids and 3 not in ids and ids.count(7) == 1
    assert jaccard.keep_one(empty(spark)).count() == 0


def test_full_and_empty_tables_of_shared_shingles_lose_no_link(spark):
    """A table of 64 bits is full and rules nothing out; the rows that stay are the same."""
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 3) for _ in range(60)) for _ in range(20)]
    texts += [t + " and one" for t in texts[:10]] + texts[:5] * 20 + ["", "one"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = [sorted(r["doc_id"] for r in jaccard.keep_one(docs, bits=b).collect()) for b in (64, 1 << 20)]
    assert found[0] == found[1] and len(found[0]) < 40
    prints = jaccard.prefixes(jaccard.shingle_sets(docs, 5, {"doc_id": docs["doc_id"], "_hash": docs["doc_id"]}, "text").withColumn("sid", F.xxhash64("set")), jaccard.common_shingles(docs, 5, "text"))
    each = jaccard.postings(prints.select("sid", "size", "prefix").dropDuplicates(["sid"]), 1 << 28)
    assert each.count() == each.distinct().count() and each.groupBy("key").count().filter("count = 1").count() == 0


def test_sketches_rule_out_no_similar_pair():
    """Bits that differ are never more than the shingles that do, for equal and unequal widths, and unrelated sets are ruled out."""
    rnd = np.random.default_rng(3)
    a, b, lists = [], [], []
    for n in (0, 1, 2, 40, 63, 64, 65, 120, 128, 129, 700, 5000):
        own = rnd.integers(-(2**63), 2**63, n)
        for other in (own, own[: n * 4 // 5], np.r_[own, rnd.integers(-(2**63), 2**63, n // 5 + 1)], rnd.integers(-(2**63), 2**63, n)):
            a, b, lists = [*a, jaccard.sketch_of(own)], [*b, jaccard.sketch_of(other)], [*lists, (set(own.tolist()), set(other.tolist()))]
    odd = jaccard.odd_bits(pa.array(a, pa.binary()), pa.array(b, pa.binary()))
    sizes = np.array([len(x) + len(y) for x, y in lists])
    assert all(o <= len(x ^ y) for o, (x, y) in zip(odd, lists))
    may = jaccard.may_be_alike(sizes, odd)
    assert all(m for m, (x, y) in zip(may, lists) if 5 * len(x & y) >= 4 * len(x | y))
    assert not any(m for m, (x, y) in zip(may, lists) if len(x) > 100 and not x & y)
    # a block agrees with the pairs of its sets, whatever their widths
    members = [x for x, _ in lists] + [y for _, y in lists]
    blocks = jaccard.with_partner(np.array([len(x) for x in members]), np.arange(len(members)), pa.array(a + b, pa.binary()))
    near = [any(i != j and 5 * len(x & y) >= 4 * len(x | y) for j, y in enumerate(members)) for i, x in enumerate(members)]
    assert all(kept for kept, has in zip(blocks, near) if has)


def test_a_block_is_compared_in_little_memory():
    """Two blocks of a common shingle: what is compared at a time is small beside all pairs of their members."""
    rnd, n = np.random.default_rng(4), 2 * jaccard.BLOCK_SETS
    lists = [np.sort(rnd.integers(-(1 << 62), 1 << 62, 100)) for _ in range(n // 2)]
    lists += [np.sort(np.r_[x[:95], rnd.integers(-(1 << 62), 1 << 62, 5)]) if k % 2 else np.sort(rnd.integers(-(1 << 62), 1 << 62, 90)) for k, x in enumerate(lists)]
    sketches, sizes = pa.array([jaccard.sketch_of(x) for x in lists], pa.binary()), np.array([len(x) for x in lists])
    peaks, found = [], []
    for work in (lambda: jaccard.with_partner(sizes, np.arange(n), sketches), lambda: jaccard.forest(lists)):
        tracemalloc.start()
        found.append(work())
        peaks.append(tracemalloc.get_traced_memory()[1] >> 20)
        tracemalloc.stop()
    alike = {k for k in range(n // 2) if k % 2}
    assert alike | {k + n // 2 for k in alike} <= set(np.flatnonzero(found[0]).tolist())
    assert sorted(found[1]) == [(k + n // 2, k) for k in sorted(alike)]
    assert max(peaks) < 72, peaks
