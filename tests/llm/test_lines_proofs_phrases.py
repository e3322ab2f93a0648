"""Line dedup, Merkle manifest and phrase collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import CLASHING, documents, empty, rows
from pyspark.sql import functions as F

from hedonic.llm import linededup, merkle, phrases

GAP = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return text.encode().lower().decode()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lines


def brute_lines(docs, min_chars, min_documents):
    keyed = [(i, [(line, ascii_lower(line.strip(GAP))) for line in (t or "").split("\n")]) for i, t in docs]
    holders = defaultdict(list)
    for i, lines in keyed:
        for key in {k for _, k in lines if len(k) >= min_chars}:
            holders[key].append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_documents}
    out = []
    for i, lines in keyed:
        kept = [line for line, k in lines if k not in last or last[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def line_docs(seed):
    rnd = random.Random(seed)
    shared = ["A line of the licence that is shared", "  a LINE of the licence that is shared\t", "ÄÖ another shared line of many", "short one", "", "äö another shared line of many"]
    out = []
    for i in range(60):
        lines = [rnd.choice(shared) if rnd.random() < 0.4 else f"own line number {i} {rnd.random()}" for _ in range(rnd.randint(0, 9))]
        out.append((i, "\n".join(lines)))
    out += [(None, shared[0]), (None, shared[0] + "\nmore of its own and long"), (3, out[3][1]), (3, out[3][1]), (70, None), (71, ""), (72, "\n\n"), (73, "\n".join([shared[0]] * 500))]
    return out


@pytest.mark.parametrize("min_chars, min_documents", [(20, 3), (1, 2)])
def test_lines_equal_brute_force(spark, min_chars, min_documents):
    data = line_docs(5)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    out = linededup.drop_lines(docs, min_chars=min_chars, min_documents=min_documents)
    assert Counter(map(tuple, out.collect())) == brute_lines(data, min_chars, min_documents)


def test_lines_of_odd_documents(spark):
    odd = documents(spark, clashing=True)
    want = brute_lines([(r[0], r[1]) for r in rows()], 20, 2)
    assert Counter(map(tuple, linededup.drop_lines(odd, min_documents=2).collect())) == want
    kept = linededup.drop_lines(odd, keep=["doc_id", *CLASHING[:3]])
    assert kept.columns == ["doc_id", *CLASHING[:3], *linededup.RESULTS] and kept.count() == len(rows())
    with pytest.raises(ValueError):
        linededup.drop_lines(odd.withColumn("n_lines", F.lit(1)), keep=["n_lines"])
    assert linededup.drop_lines(empty(spark)).count() == 0


def test_lines_beyond_a_broadcast_and_without_python(spark, monkeypatch):
    monkeypatch.setattr("hedonic.session.BROADCAST_MAX_ROWS", 0)
    data = line_docs(6)
    out = linededup.drop_lines(spark.createDataFrame(data, "doc_id long, text string"))
    assert Counter(map(tuple, out.collect())) == brute_lines(data, 20, 3)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- proofs


def leaf(fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """The levels of a tree, and for each leaf the digests beside its way, left and right."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    paths = []
    for k in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            first = k - k % 8
            path.append(("".join(level[first:k]), "".join(level[k + 1 : first + 8])))
            k //= 8
        paths.append(path)
    return levels[-1][0], paths


def brute_proofs(data):
    """Rows (doc_id, leaf, subroot, root, path) of documents (doc_id, text, lang, source, n_chars)."""
    first = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)
    groups = defaultdict(list)
    for i, text, lang, source, n in data:
        groups[lang].append((first(i), leaf((i, source, lang, n, text)), i))
    names = sorted(groups, key=first)
    subtrees = [tree([h for _, h, _ in sorted(groups[g], key=lambda m: m[:2])]) for g in names]
    root, above = tree([r for r, _ in subtrees])
    out = []
    for g, (subroot, paths), upper in zip(names, subtrees, above):
        for (_, h, i), path in zip(sorted(groups[g], key=lambda m: m[:2]), paths):
            out.append((i, h, subroot, root, tuple(path + upper)))
    return out


def many(n, langs, seed=1):
    rnd = random.Random(seed)
    weights = [3] + [1] * (len(langs) - 1)
    return [(i, f"Text {rnd.random()}", rnd.choices(langs, weights)[0], "s", i) for i in rnd.sample(range(10 * n), n)]


@pytest.mark.parametrize(
    "n, langs, local",
    [(1, ["a"], 1), (8, ["a"], 1), (9, ["a"], 1), (700, [None, "a", "é", "z"], 1), (300, [f"l{k}" for k in range(75)], 1), (700, ["a", "b"], 2), (700, ["a", None], 3), (81, ["a"], 0)],
)
def test_proofs_equal_brute_force(spark, n, langs, local):
    data = many(n, langs)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])) for r in merkle.manifest(docs, local=local).collect()]
    assert sorted(got) == sorted(brute_proofs(data))


def test_proofs_of_odd_documents(spark):
    docs = documents(spark, clashing=True)
    out = merkle.manifest(docs, carried={"other": F.lit("x")})
    got = out.withColumns({"good": merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"), "bad": merkle.fold(F.sha2("other", 256), F.col("path")) == F.col("root")}).collect()
    want = Counter(brute_proofs(rows()))
    assert Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])) for r in got) == want
    assert all(r["good"] and not r["bad"] and r["other"] == "x" for r in got)
    assert merkle.manifest(empty(spark)).collect() == []


def test_registered_proofs(spark):
    import duckdb

    from hedonic.llm import catalog

    where = "/root/testdata/sf0.001"
    data = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{where}/documents.parquet'").fetchall()
    wanted = {p[0]: p for p in brute_proofs(data)}
    texts = {r[0]: r for r in data}
    got = catalog.QUERIES["op12_merkle_manifest"](spark, where).collect()
    assert {r["doc_id"] for r in got} == wanted.keys()
    changed = 0
    for r in got:
        i, h, subroot, root, path = wanted[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) == (h, subroot, root, sha("".join(a + b for a, b in path)))
        if zlib.crc32(str(i).encode()) % 3 == 0:
            _, text, lang, source, n = texts[i]
            h = leaf((i, source, lang, n, None if text is None else ascii_lower(text)))
        for a, b in path:
            h = sha(a + h + b)
        assert (r["folded_root"], r["verified"]) == (h, h == root)
        changed += h != root
    assert changed


# --- phrases


def brute_phrases(data, least, reported):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in data:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        frequent = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            inside = any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in frequent.items())
            score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:reported], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_docs(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "é", "x\x00y", "日本"]
    passages = [" ".join(rnd.choices(vocabulary, k=40)) for _ in range(3)]
    out = []
    for _ in range(n):
        parts = [rnd.choice(passages) if rnd.random() < 0.3 else " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30))) for _ in range(rnd.randint(0, 4))]
        out.append((rnd.choice([". ", ", ", "\n", "\t", "  ", " \x1c "]).join(parts).title(), rnd.choice(["a", "b", None])))
    return out + [(None, "a"), ("", None), ("the " * 3000, "a"), (". . ,", "b"), ("word", "c")]


@pytest.mark.parametrize("spacing, least, reported", [(1, 5, 2000), (2, 8, 50), (7, 5, 2000), (1000, 20, 2000)])
def test_phrases_equal_brute_force(spark, spacing, least, reported):
    data = phrase_docs(spacing)
    docs = spark.createDataFrame(data, "text string, lang string").repartition(3)
    got = sorted(map(tuple, phrases.collocations(docs, least=least, reported=reported, spacing=spacing).collect()))
    assert got == brute_phrases(data, least, reported) and got


def test_phrases_with_a_full_table_and_equal_hashes(spark):
    """A table of few bits lets every run through, and equal hashes are told apart by their words."""
    data = phrase_docs(3, 40)
    docs = spark.createDataFrame(data, "text string, lang string").repartition(2)
    assert sorted(map(tuple, phrases.collocations(docs, least=6, bits=64).collect())) == brute_phrases(data, 6, 2000)
    import numpy as np

    first, group = phrases._groups(np.zeros(4, dtype=np.uint64), [np.array([1, 2, 1, 1]), np.array([1, 1, 1, 3])])
    assert len(first) == 3 and group[0] == group[2] and len(set(group.tolist())) == 3


def test_chunks_recur_with_their_passage(spark):
    rnd = random.Random(4)
    passage = " ".join(f"p{rnd.randint(0, 400)}" for _ in range(600))
    data = [(" ".join(f"q{rnd.randint(0, 400)}" for _ in range(rnd.randint(1, 50))) + " " + passage, "a") for _ in range(20)]
    out = phrases.chunks(spark.createDataFrame(data, "text string, lang string"), spacing=16)
    assert out.filter("n = 20 AND goes_on").count() > 10


def test_phrases_of_odd_documents(spark):
    data = [(r[1], r[2]) for r in rows()]
    docs = documents(spark, clashing=True).withColumn("phrase", F.lit(1))
    assert sorted(map(tuple, phrases.collocations(docs, least=10).collect())) == brute_phrases(data, 10, 2000)
    assert phrases.collocations(empty(spark)).collect() == []
