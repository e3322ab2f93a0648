"""Rules, fingerprints, classifier, sharding, URL filters and neighbours on small tables with all oddities."""

import random
import zlib

import numpy as np
import pytest
import xxhash
from helpers import CLASHING, documents, empty, rows, sentence, words
from pyspark.sql import functions as F

from hedonic.llm import ann, graph, neighbours, rules, sharding, simhash, urlfilter
from hedonic.llm.vamana import Graph

# --- rules ------------------------------------------------------------------------


def measures(text):
    text = text or ""
    own = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)} if len(own) < 3000 else set()
    return len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rule_measures_and_verdicts(spark):
    got = rules.judge(documents(spark, clashing=True)).collect()
    assert len(got) == len(rows())
    want = sorted((r[0] or 0, *measures(r[1])) for r in rows())
    assert sorted((r["doc_id"] or 0, *[r[m] for m in rules.MEASURES]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert set(range(40)) - {8} <= kept | {8} and not kept & {100, 101, 102, 103, 109, 111, 112, 113}


def test_rule_order_does_not_change_verdicts(spark):
    docs, given = documents(spark), rules.default_rules()
    measured = rules.measured(docs, "text", ["doc_id"])
    first, last = (sorted(map(str, measured.select("doc_id", rules.verdict(o).alias("k")).collect())) for o in (given, given[::-1]))
    assert first == last
    assert {r.name for r in rules.cascade_order(docs, "text", given)} == {r.name for r in given}


def test_kept_documents_keep_their_columns(spark):
    docs = documents(spark, clashing=True)
    kept = rules.keep_documents(docs)
    assert kept.schema == docs.schema
    want = [r["doc_id"] for r in rules.judge(docs).filter("kept").collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert rules.judge(empty(spark)).count() == 0 and rules.keep_documents(empty(spark)).count() == 0


def test_rules_run_no_python(spark):
    plan = rules.judge(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- fingerprints -------------------------------------------------------------------


def fingerprint(text, shingle=3):
    own = [w.translate(str.maketrans(simhash.UPPER, simhash.LOWER)) for w in words(text)]
    parts = [" ".join(own[i : i + shingle]) for i in range(len(own) - shingle + 1)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes)) if hashes else 0


def reach(values, linked):
    """For each value the smallest position it is connected to."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if label[i] != label[j] and linked(values[i], values[j]):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_fingerprints_and_components(spark):
    got = simhash.near_duplicates(documents(spark, clashing=True)).collect()
    want = sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0))
    prints = [fingerprint(r[1]) for r in want]
    assert sorted((r["doc_id"] or 0, r["fingerprint"]) for r in got) == sorted((r[0] or 0, format(p, "016x")) for r, p in zip(want, prints))
    label = reach(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == sorted((r[0] or 0, want[k][0] or 0) for r, k in zip(want, label))
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("distance,joined", [(2, 24), (2, 0), (2, 10**6), (3, 24), (3, 0), (1, 24), (0, 24)])
@pytest.mark.parametrize("partitions", [3, 4])
def test_links_lose_no_pair(spark, distance, joined, partitions):
    if partitions == 4 and joined != 24:
        pytest.skip("one size of buckets is enough here")
    rnd = random.Random(distance * 10 + partitions)
    centres = [rnd.getrandbits(64) for _ in range(6)] + [0]
    values = set(centres)
    for c in centres:
        for _ in range(25):
            v = c
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                v ^= 1 << b
            values.add(v)
    values |= {rnd.getrandbits(64) for _ in range(60)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r["u"]: r["v"] for r in graph.components(simhash.links(df, distance, partitions, joined)).collect()}
    label = reach(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    assert [found.get(v, v) for v in signed] == [signed[k] for k in label]


def test_thresholds_are_allocated_by_cost():
    assert simhash.allocate([[1, 5, 9], [1, 5, 9], [1, 5, 9]], 2) == [0, 0, 0]
    assert simhash.allocate([[1, 2, 9], [1, 2, 9], [100, 200, 300]], 2) in ([1, 0, -1], [0, 1, -1])
    assert simhash.allocate([[1, 2, 2.5], [50, 60, 70], [50, 60, 70]], 2) == [2, -1, -1]


def test_correlated_bits_share_a_partition():
    rnd = np.random.default_rng(1)
    bits = rnd.integers(0, 2, (2000, 64))
    bits[:, 10], bits[:, 40] = bits[:, 3], bits[:, 3]
    groups = simhash.group_bits(2000, (bits.T @ bits).astype(float), 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any({3, 10, 40} <= set(g) for g in groups)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    found = {r["u"]: r["v"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({n for e in edges for n in e})
    pairs = {tuple(sorted(e)) for e in edges}
    label = reach(nodes, lambda a, b: tuple(sorted((a, b))) in pairs)
    assert {n: found.get(n, n) for n in nodes} == {n: nodes[k] for n, k in zip(nodes, label)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark, clashing=True)
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert len(ids) == len(set(ids))
    groups = {}
    for r in sorted(rows(), key=lambda r: (r[0] is None, r[0] or 0)):
        groups.setdefault(fingerprint(r[1]), []).append(r[0])
    firsts = [g[0] for g in groups.values()]
    got = [None if none else i for none, i, _ in ids]
    assert set(got) <= set(firsts) and -5 in got and 3 not in got and got.count(7) == 1
    assert simhash.keep_one(empty(spark)).count() == 0


# --- classifier -----------------------------------------------------------------------


def labelled(spark, n=240):
    rnd = random.Random(9)
    docs = [(i, sentence(rnd, 60) if i % 3 else " ".join(w.upper() + "!!" for w in sentence(rnd, 60).split()), "en", "s", 1) for i in range(n)]
    return docs, [(i, int(i % 3 > 0), 0) for i in range(n) if i % 5]


def test_votes_separate_held_out_documents(spark):
    docs, labels = labelled(spark)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    known = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (10_000, 1, 0), (1, 0, 0), (2, 7, 1)], "doc_id long, quality int, toxic int")
    model = neighbours.fit(df, known)
    assert len(model.labels) <= 2 * neighbours.MAX_VOTERS
    got = {r["doc_id"]: r["score"] for r in neighbours.score(df, model, ["doc_id"]).collect()}
    good = [(got[i] >= 0.3) == (i % 3 > 0) for i in range(240) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(good) >= 0.95 * len(good) and all(0 <= s <= 1 for s in got.values())
    held = {r["doc_id"]: r["h"] for r in df.select("doc_id", neighbours.held_out(F.col("doc_id")).alias("h")).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(240)}
    kept = neighbours.keep_documents(df.withColumn("score", F.lit("x")), model)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, s in got.items() if s >= 0.3)


def test_votes_of_odd_documents(spark):
    docs, labels = labelled(spark, 60)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = neighbours.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), known)
    odd = documents(spark, clashing=True).drop("score")
    got = neighbours.score(odd, model, ["doc_id"]).collect()
    assert len(got) == len(rows()) and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (100, 101, 102)} == {0.5}
    assert neighbours.score(empty(spark), model, ["doc_id"]).count() == 0 and neighbours.keep_documents(empty(spark), model).count() == 0


def test_votes_with_few_or_no_labels(spark):
    docs = documents(spark)
    none = neighbours.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in neighbours.score(docs, none, ["doc_id"]).collect()} == {0.5}
    one = neighbours.fit(docs, spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int"))
    assert {r["score"] for r in neighbours.score(docs, one, ["doc_id"]).collect()} <= {1.0, 0.5}
    assert len(neighbours.fit(empty(spark), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")).labels) == 0


# --- sharding -------------------------------------------------------------------------


def test_shards_move_few_records(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 1.0, 2.0, 0.0, 1.0]
    both = sharding.assign(sharding.assign(df, ["doc_id"], weights), ["doc_id"], [*weights, 1.0], "grown").collect()
    assert all(r["grown"] in (r["shard"], 5) for r in both)
    share = np.bincount([r["shard"] for r in both], minlength=5) / 20_000
    assert np.allclose(share, np.array(weights) / 5, atol=0.02) and abs(sum(r["grown"] == 5 for r in both) / 20_000 - 1 / 6) < 0.02
    for bad in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError):
            sharding.shard_of([F.col("doc_id")], bad)


def test_slots_have_no_gaps(spark, tmp_path):
    docs = documents(spark).select("doc_id", "text")
    hot = docs.unionByName(spark.range(500).select(F.lit(3).cast("long").alias("doc_id"), F.lit("hot").alias("text")).repartition(4))
    got = sharding.slots(sharding.assign(hot, ["doc_id"], [1.0] * 4)).collect()
    assert len(got) == len(rows()) + 500
    for s in range(4):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert sharding.slots(sharding.assign(empty(spark).select("doc_id"), ["doc_id"], [1.0, 1.0])).count() == 0
    sharding.write_shards(docs, ["doc_id"], [1.0] * 4, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(rows())


# --- URL filters ------------------------------------------------------------------------

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("a.b.c", "", "block"), ("b.c", "/x", "allow"), ("b.c", "/x/yy", "block"), ("b.c", "/x/yy", "allow"), ("net", "/es/", "block")]
URLS = [
    None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.EXAMPLE.COM/en/1?x=/fr/", "http://m.example.com/en/2#/x", "http://m.example.com/EN/2",
    "https://example.com/en", "https://notexample.com/en/", "http://a.b.c", "http://a.b.c/x/yyy", "http://b.c/xa", "http://b.c/x/y", "http://b.c/x/yyy/z", "http://q.b.c?/x",
    "http://x.net/es/a://b.com/", "http://x.net/es", "ftp://.net/es/", "http://net./es/", "http://ÄÖ.com/ü", "http://b.c//x", "x\ny://b.c/x",
]


def judged(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut].translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER)), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fitting = [r for r in RULES if ("." + host).endswith("." + r[0]) and path.startswith(r[1])]
    if not fitting:
        return host, path, None, "allow"
    best = max(fitting, key=lambda r: (r[0].count("."), len(r[1]), r[2] == "block"))
    return host, path, best[0] + best[1], best[2]


@pytest.mark.parametrize("per_pass", [100, 2])
def test_urls_against_brute_force(spark, per_pass):
    rnd = random.Random(5)
    parts = ["a", "b", "c", "www", "m", "example", "com", "net", "x", "yy", "en", "es", ""]
    urls = URLS + ["http://" + ".".join(rnd.choices(parts, k=rnd.randint(1, 4))) + "/" + "/".join(rnd.choices(parts, k=rnd.randint(0, 4))) for _ in range(300)]
    pages = spark.createDataFrame([(i, u, "h", "old") for i, u in enumerate([*urls, *URLS])], "page_id long, url string, host string, verdict string")
    given = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, given, per_pass=per_pass).collect()}
    assert got == {i: judged(u) for i, u in enumerate([*urls, *URLS])}


def test_urls_without_rules_or_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [(r["rule"], r["verdict"]) for r in urlfilter.judge(pages, none, default="block").collect()] == [(None, "block")]
    assert urlfilter.judge(pages.limit(0), none).count() == 0


# --- nearest neighbours -------------------------------------------------------------------


def exact_neighbours(vectors, queries, k):
    out = {}
    for q in queries:
        near = sorted((-float(np.dot(vectors[q], v) / np.sqrt(np.dot(vectors[q], vectors[q])) / np.sqrt(np.dot(v, v))), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_neighbours_with_odd_and_repeated_vectors(spark):
    rnd = np.random.default_rng(7)
    good = {i: rnd.standard_normal(8).astype(np.float32) for i in range(120)}
    for i in range(200, 260):
        good[i] = good[50]  # a vector that many share, that of a query among them
    bad = [(300, None), (350, []), (400, [0.0] * 8), (450, [1.0, None, *[0.0] * 6]), (500, [float("nan"), *[1.0] * 7]), (550, [float("inf"), *[1.0] * 7]), (600, [1.0, 2.0]), (None, [1.0] * 8)]
    listed = [(i, [float(x) for x in v]) for i, v in good.items()]
    df = spark.createDataFrame([*listed, *bad, listed[3], listed[50]], "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(3)
    got = ann.nearest_neighbours(df, F.col("vec_id") % 50 == 0, shard_rows=40).collect()
    want = exact_neighbours(good, [0, 50, 100, 200, 250], 5)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(want) and all(len(f) == 5 for f in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 25
    assert [i for i, _ in found[50]] == [200, 201, 202, 203, 204] and [i for i, _ in found[200]] == [50, 201, 202, 203, 204]
    for q, f in found.items():
        for i, s in f:
            v, w = good[q].astype(float), good[i].astype(float)
            assert s == pytest.approx(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w), abs=1e-12)


def test_few_or_no_neighbours(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], schema)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest_neighbours(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    one = spark.createDataFrame([(0, [1.0, 0.0])], schema)
    assert ann.nearest_neighbours(one, F.col("vec_id") == 0).count() == 0
    assert ann.nearest_neighbours(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 5, 30, 900])
def test_graph_reaches_everything(n):
    x = np.random.default_rng(n).standard_normal((n, 6)).astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    g = Graph.build(x, degree=6, width=12)
    ids = g.search(x[:3], max(n, 1))[0]
    assert all(set(row[row >= 0].tolist()) == set(range(n)) for row in ids)


def test_clashing_names_are_really_in_the_input(spark):
    assert set(CLASHING) <= set(documents(spark, clashing=True).columns)


@pytest.mark.parametrize("clusters,spread", [(10, 0.5), (40, 0.5), (40, 0.05), (200, 0.5)])
def test_graph_finds_neighbours_inside_clusters(clusters, spread):
    """Groups far apart that are larger than a node's degree and a search's width."""
    rnd = np.random.default_rng(clusters)
    x = rnd.standard_normal((3000, 32)) * spread + (3 * rnd.standard_normal((clusters, 32)))[rnd.integers(0, clusters, 3000)]
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    found = Graph.build(x).search(x[:150], ann.SEARCH_WIDTH)[0][:, :6]
    exact = np.argsort(-(x[:150] @ x.T), axis=1)[:, :6]
    assert np.mean([len(set(f.tolist()) & set(e.tolist())) / 6 for f, e in zip(found, exact)]) >= 0.95


def test_scores_of_very_large_and_small_components(spark):
    vectors = {0: [1e200, 0.0], 1: [1.0, 0.0], 2: [1e-200, 1e-200], 3: [-3e307, 1e307], 4: [0.0, 5e-324]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in ann.nearest_neighbours(df, F.col("vec_id") < 5).collect()}
    unit = {k: np.array(v) / max(map(abs, v)) for k, v in vectors.items()}
    assert got.keys() == {(a, b) for a in vectors for b in vectors if a != b}
    for (a, b), score in got.items():
        assert score == pytest.approx(unit[a] @ unit[b] / np.linalg.norm(unit[a]) / np.linalg.norm(unit[b]), abs=1e-12)


@pytest.mark.parametrize("per_pass", [100, 2])
def test_urls_keep_columns_of_any_name(spark, per_pass):
    pages = spark.createDataFrame([(1, "http://m.example.com/en/2", 7, 8, 9, 10, "old")], "page_id long, url string, _best long, _found long, best long, row long, rule string")
    given = spark.createDataFrame(RULES, "host string, path string, verdict string")
    (got,) = urlfilter.judge(pages, given, per_pass=per_pass).collect()
    assert got.asDict() == {"page_id": 1, "url": "http://m.example.com/en/2", "_best": 7, "_found": 8, "best": 9, "row": 10, "host": "m.example.com", "path": "/en/2", "rule": "example.com/en/", "verdict": "block"}


def test_largest_draw_of_a_shard_has_a_finite_score(spark):
    u = (F.lit((1 << 52) - 1).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    assert spark.range(1).select((F.lit(1.0) / -F.log(u)).alias("s")).first()["s"] > 1e15
