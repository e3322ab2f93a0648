"""Token operators against the tokenizers library: counts, codes, BPE and packing."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, empty, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hedonic.llm import bpe, dac, encoding, packing, tokencount


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunked_encoding_equals_the_library(name, spaced):
    tokenizer, texts = library(name), [r[1] or "" for r in rows()]
    rnd = random.Random(4)
    texts += ["".join(rnd.choice(" \n\t\u00a0\u2003\x1c\x85aB1.'s,é!") for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    for _ in range(2):  # the second time from the cache
        ids, counts = encoding.library_encoder(name, spaced)(texts)
        for text, own in zip(texts, encoding.documents_of(ids, counts)):
            assert own.tolist() == ids_of(tokenizer, text), text


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_marks_and_line_ends_are_cut_off(name, spaced):
    texts = ["Dark grün.\nBlue### sea,&&&\nIt!! end", "grün***", "", "\nBlue###\n\nend.\n sea$%", "it's\nx<|endoftext|>.\nBlue 12.\nsea \u2167.\nIt e\u0301.\nIt"]
    rnd = random.Random(7)
    texts += ["".join(rnd.choice([" ", "\n", ".\n", "###", "*", "blue", "É", "sea", "<|endoftext|>", "'s", "7", "\u00b2", "\u0301", "&", "\t"]) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    encoder, tokenizer = encoding.library_encoder(name, spaced), library(name)
    encoder.forget()
    ids, counts = encoder(texts)
    for text, own in zip(texts, encoding.documents_of(ids, counts)):
        assert own.tolist() == ids_of(tokenizer, text), text
    encoder.forget()
    encoder(texts[:2])
    # a text's first chunk is taken whole where white space counts
    mixed = [piece for piece in encoder.numbers if piece not in texts and not piece.strip(" ").isalpha() and any(map(str.isalpha, piece))]
    assert not mixed and {".", "###", ",&&&", "!!"} < set(encoder.numbers)


def test_chunk_table_is_bounded(monkeypatch):
    monkeypatch.setattr(encoding, "MAX_CHUNKS", 10)
    encoder = encoding.ChunkEncoder(encoding.spaced_chunks, encoding.library_encoder("byte_bpe_50k.json", True).encode)
    for k in range(6):
        encoder([f"word{k}a word{k}b word{k}c"])
        assert len(encoder.numbers) <= 13


def test_token_counts(spark, tmp_path):
    docs, tokenizer = documents(spark, clashing=True), library("byte_bpe_50k.json")
    path = str(tmp_path / "tokens")
    tokencount.write_token_files(docs, path)
    found = tokencount.count_tokens(spark, f"{path}/kind=tokens", block_tokens=64).collect()
    want = sorted(len(ids_of(tokenizer, r[1])) for r in rows())
    assert sorted(r["n_tokens"] for r in found) == want and all(r["complete"] for r in found)
    by_file = {}
    for r in sorted(found, key=lambda r: (r["file"], r["number"])):
        assert (r["number"], r["start"]) == by_file.get(r["file"], (0, 0))
        by_file[r["file"]] = (r["number"] + 1, r["start"] + r["n_tokens"] + 1)


@pytest.mark.parametrize("whole", [1 << 20, 0])
@pytest.mark.parametrize("width,end", [(2, 0), (4, 50256), (1, 7)])
def test_separator_scan_of_any_flat_file(spark, tmp_path, width, end, whole):
    rnd = np.random.default_rng(width)
    files = {"a": rnd.integers(0, 120, 997), "b": np.full(600, end), "c": np.r_[rnd.integers(8, 100, 500), end], "d": np.array([], dtype=int), "e": np.full(360, 9)}
    if end > 255:
        files["a"][::50] = end
    for name, codes in files.items():
        (tmp_path / name).write_bytes(codes.astype(f"<u{width}").tobytes())
    found = tokencount.stitched(tokencount.find_ends(spark, str(tmp_path), width, end, block_tokens=16, whole_bytes=whole), run_tokens=64).collect()
    got = sorted((r["file"].rsplit("/", 1)[1], r["number"], r["start"], r["n_tokens"], r["complete"]) for r in found)
    want = []
    for name, codes in files.items():
        at, number = 0, 0
        for k, code in enumerate(codes.tolist()):
            if code == end:
                want.append((name, number, at, k - at, True))
                at, number = k + 1, number + 1
        if at < len(codes):
            want.append((name, number, at, len(codes) - at, False))
    assert got == sorted(want)


def test_a_file_that_ends_within_a_token_is_an_error(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc")
    with pytest.raises(Exception, match="within a token"):
        tokencount.find_ends(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("kind", ["small", "mixed", "wide", "none", "ends"])
def test_codes_round_trip_and_random_access(kind):
    rnd = np.random.default_rng(3)
    ids = {"small": rnd.integers(0, 200, 1500), "mixed": rnd.integers(0, 50257, 5000), "wide": rnd.integers(0, 1 << 40, 700), "none": np.zeros(0, int), "ends": np.array([0, 255, 256, 65535, 65536])}[kind]
    codes = dac.Codes(dac.encode(ids))
    assert len(codes) == len(ids) and codes.all().tolist() == ids.tolist()
    for i in [*rnd.integers(0, max(len(ids), 1), 60).tolist(), len(ids) - 1][: len(ids)]:
        assert codes[i] == ids[i]
    for _ in range(30):
        a, b = sorted(rnd.integers(0, len(ids) + 1, 2).tolist())
        assert codes.between(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        codes[len(ids)]
    with pytest.raises(ValueError):
        dac.Codes(b"none")


def test_code_files(spark, tmp_path, monkeypatch):
    path, tokenizer = str(tmp_path / "codes"), library("byte_bpe_50k.json")
    dac.write_codes(documents(spark, clashing=True), path)
    found = sorted(dac.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in found) == [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    want = sorted((r[0] is not None, r[0] or 0, crc(ids_of(tokenizer, r[1]) + [2])) for r in rows())
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids_crc32"]) for r in found) == want
    at = 0
    for r in found:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == crc(r["ids"])
        at += r["n_tokens"]
    some = next(r for r in found if r["doc_id"] == 110)
    for k in (0, 17, some["n_tokens"] - 1):
        assert dac.token_at(spark, path, 110, k) == some["ids"][k]
    assert dac.token_at(spark, path, 110, some["n_tokens"]) is None and dac.token_at(spark, path, 99999, 0) is None


def test_empty_tables(spark, tmp_path):
    dac.write_codes(empty(spark), str(tmp_path / "c"))
    assert dac.read_documents(spark, str(tmp_path / "c")).count() == 0
    assert bpe.digest_documents(empty(spark)).count() == 0
    assert packing.pack_documents(empty(spark)).count() == 0
    tokencount.write_token_files(empty(spark), str(tmp_path / "t"))


def test_bpe_equals_the_library():
    tokenizer, path = library("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.json")
    tables, encoder = bpe.tools(path)
    rnd = random.Random(6)
    texts = [r[1] or "" for r in rows()] + ["a" * n for n in range(1, 40)] + ["abab" * 50, "=" * 99]
    texts += ["".join(rnd.choice("ab \n'sé日1.") for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    ids, counts = encoder(texts)
    for text, own in zip(texts, encoding.documents_of(ids, counts)):
        want = ids_of(tokenizer, text)
        assert own.tolist() == want
        assert tables.decode(own).decode("utf-8", "replace") == tokenizer.decode(want, skip_special_tokens=False)
    for _ in range(200):  # ids that are no text: bytes out of order
        some = [rnd.randrange(50257) for _ in range(12)]
        assert tables.decode(np.array(some)).decode("utf-8", "replace") == tokenizer.decode(some, skip_special_tokens=False)


def test_bpe_over_documents(spark):
    tokenizer = library("byte_bpe_50k.json")
    docs = documents(spark, clashing=True)
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digest_documents(docs).collect())
    want = []
    for doc_id, text, *_ in rows():
        ids = ids_of(tokenizer, text)
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc_id or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want)
    whole = {r["doc_id"]: r for r in bpe.encode_documents(docs.filter("doc_id >= 100")).collect()}
    assert whole[107]["decoded"] == next(r[1] for r in rows() if r[0] == 107) and whole[100]["ids"] == []


def check_plan(plan, counts):
    left = np.array(counts).copy()
    for filling, times in plan.fillings:
        assert 0 < sum(filling) <= plan.capacity and times > 0
        for length in filling:
            left[length] -= times
    assert not left.any()


def best_number(lengths, capacity):
    """The fewest bins, by trying every placement."""
    best = len(lengths)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i, room in enumerate(bins):
            if room >= lengths[k] and room not in bins[:i]:
                place(k + 1, [*bins[:i], room - lengths[k], *bins[i + 1 :]])
        place(k + 1, [*bins, capacity - lengths[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_packing_is_optimal_on_small_sets(seed):
    rnd = random.Random(seed)
    lengths = sorted((rnd.randint(1, 40) for _ in range(rnd.randint(1, 10))), reverse=True)
    counts = np.bincount(lengths, minlength=41)
    plan = packing.plan_packing(counts, 40)
    check_plan(plan, counts)
    want = best_number(lengths, 40)
    assert packing.lower_bound(counts, 40) <= want
    assert plan.sequences == want


@pytest.mark.parametrize("seed", range(6))
def test_packing_of_many(seed):
    rnd = np.random.default_rng(seed)
    lengths = np.minimum(4096, rnd.lognormal(6, 1.3, 20_000).astype(int) + 1)
    counts = np.bincount(lengths, minlength=4097)
    plan, greedy = packing.plan_packing(counts), packing.best_fit_decreasing(counts, 4096)
    check_plan(plan, counts)
    check_plan(greedy, counts)
    assert plan.sequences <= greedy.sequences and plan.sequences <= packing.lower_bound(counts, 4096) * 1.01 + 1
    rows_ = packing.placements(plan)
    assert rows_[:, 2].sum() == counts.sum() and len(rows_) < 60_000


def test_packing_documents(spark):
    tokenizer = library("word_bpe_49k.json")
    docs = documents(spark, clashing=True)
    packed = packing.pack(packing.pieces(docs, capacity=256, with_ids=True), 256)
    got = packed.collect()
    want = []
    for doc_id, text, *_ in rows():
        ids = [*ids_of(tokenizer, text), 1]
        want += [(doc_id or 0, k, a, len(ids[a : a + 256]), crc(ids[a : a + 256])) for k, a in enumerate(range(0, len(ids), 256))]
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 256 and len(at) <= sum(w[3] for w in want) / 256 * 1.02 + 1
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for s, r in whole.items():
        parts = sorted(((p["offset"], bytes(p["ids"])) for p in got if p["sequence_id"] == s))
        assert bytes(r["ids"]) == b"".join(p for _, p in parts) and r["length"] == at[s]


def test_long_words_equal_the_library():
    """Words without spaces, in which a round per merge over all symbols would take minutes."""
    codec, tokenizer, rnd = bpe.Bpe(public_tokenizers.path(bpe.TOKENIZER)), library(bpe.TOKENIZER), random.Random(6)
    texts = ["".join(rnd.choices(letters, k=k)) for letters in ("ab", "etaoin", "the", "é漢a", "x", "=-", "0123456789") for k in (511, 513, 20_000)]
    texts += ["ab " + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=160_000)) + " the word"]
    ids, counts = codec.encode(texts)
    for text, own in zip(texts, encoding.documents_of(ids, counts)):
        assert own.tolist() == ids_of(tokenizer, text), text[:40]
    assert codec.decode(ids).decode() == "".join(texts)
