"""Byte-level BPE encoding and decoding with numpy.

Texts are cut into chunks and those into the words of the tokenizer's pattern; each
distinct word is encoded once per task. Many words are merged together: their symbols
stand in one flat array, and every round looks up all neighbouring pairs by binary search
over the sorted pair keys, finds each word's lowest rank and merges that pair wherever it
stands in the word, from the left. The rounds end when no word has a mergeable pair.

A word of more than ``LONG_WORD`` bytes would need as many rounds over all its symbols. In
such words a round merges one rank wherever it stands, the places of each rank being kept
in a heap, and looks up only the pairs beside the merged places.

Decoding gathers the bytes of all ids from one flat table.

Defined cases: a NULL text counts as empty and has no ids; special tokens are found in
the text as the library finds them; bytes that are not UTF-8 decode to U+FFFD; repeated
rows are encoded each; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import run_starts, spread, table, text_slices, texts_between
from hedonic.llm.encoding import ChunkEncoder, documents_of, spaced_chunks

TOKENIZER = "byte_bpe_50k.json"
# Words whose ids a task keeps, and bytes merged at a time.
MAX_WORDS = 400_000
MERGED_BYTES = 1 << 20
LONG_WORD = 512


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable ones themselves, the others from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Bpe:
    """Merges and vocabulary of a byte-level BPE file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.words = regex.compile(public_tokenizers.PATTERN)
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = specials
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
        self.of_byte = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocab[letter]
        self.size = max([*vocab.values(), *specials.values()]) + 1
        spelled = [b""] * self.size
        for token, n in vocab.items():
            spelled[n] = bytes(letters[c] for c in token) if token not in specials else token.encode()
        for token, n in specials.items():
            spelled[n] = token.encode()
        self.lengths = np.array([len(s) for s in spelled], dtype=np.int64)
        self.starts = run_starts(self.lengths)
        self.bytes = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        # of a pair that is listed twice the last rank holds
        last = np.r_[keys[order][1:] != keys[order][:-1], True]
        self.keys, self.ranks = keys[order][last], order[last]
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        """Empty the table of encoded words."""
        self._known: dict[str, int] = {}
        self._counts, self._firsts, self._ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the number of ids of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        # symbols of words that still change; finished words are set aside
        done_symbols, done_owner = [], []
        none = len(self.merged)
        long = np.repeat(sizes > LONG_WORD, sizes)
        if long.any():
            merged = self._merge_long(symbols[long], owner[long])
            done_symbols.append(merged[0])
            done_owner.append(merged[1])
            symbols, owner = symbols[~long], owner[~long]
        while len(symbols):
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where((self.keys[at] == keys) & (owner[:-1] == owner[1:]), self.ranks[at], none)
            rank = np.r_[rank, none]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(symbols)])
            open_word = np.repeat(lowest < none, length)
            done_symbols.append(symbols[~open_word])
            done_owner.append(owner[~open_word])
            hit = (rank == np.repeat(lowest, length)) & open_word
            # in a row of overlapping pairs, as in "aaaa", every second one from the left is merged
            places = np.flatnonzero(hit)
            if len(places) > 1:
                fresh = np.r_[True, np.diff(places) != 1]
                row = np.cumsum(fresh) - 1
                odd = (places - places[fresh][row]) & 1
                hit[places[odd == 1]] = False
                places = places[odd == 0]
            symbols[places] = self.merged[rank[places]]
            keep = open_word.copy()
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_symbols:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(words), dtype=np.int64)
        ids, owners = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owners, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owners, minlength=len(words))

    def _merge_long(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and owners that are left of long words, merged rank by rank."""
        n, none = len(symbols), len(self.merged)
        # one place more stands for the end on both sides
        symbols, owner = np.r_[symbols, 0], np.r_[owner, -1]
        after, before = np.minimum(np.arange(1, n + 2), n), np.r_[n, np.arange(n)]
        alive, rank = np.ones(n + 1, dtype=bool), np.full(n + 1, none, dtype=np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look_up(places: np.ndarray) -> None:
            right = after[places]
            keys = symbols[places] * self.size + symbols[right]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found = np.where((self.keys[at] == keys) & (owner[places] == owner[right]), self.ranks[at], none)
            rank[places] = found
            order = np.argsort(found, kind="stable")
            found, places = found[order], places[order]
            cuts = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                r = int(found[lo])
                if r == none:
                    break
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(places[lo:hi])

        look_up(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(r)))
            # places whose pair has changed since are looked up anew already
            places = places[rank[places] == r]
            if not len(places):
                continue
            if len(places) > 1:
                # of overlapping pairs every second one from the left, as in the rounds of short words
                fresh = np.r_[True, after[places[:-1]] != places[1:]]
                number = np.arange(len(places))
                places = places[(number - np.maximum.accumulate(np.where(fresh, number, 0))) & 1 == 0]
            right = after[places]
            beyond = after[right]
            symbols[places], after[places], before[beyond] = self.merged[r], beyond, places
            alive[right], rank[right] = False, none
            changed = np.unique(np.r_[places, before[places]])
            look_up(changed[changed < n])
        return symbols[:n][alive[:n]], owner[:n][alive[:n]]

    def _learn(self, words: list[str]) -> None:
        batch, size = [], 0
        for k, word in enumerate(words):
            data = word.encode("utf-8", "surrogatepass")
            batch.append(data)
            size += len(data)
            if size >= MERGED_BYTES or k == len(words) - 1:
                ids, counts = self.merge(batch)
                self._firsts = np.r_[self._firsts, len(self._ids) + run_starts(counts)[:-1]]
                self._counts, self._ids = np.r_[self._counts, counts], np.r_[self._ids, ids]
                batch, size = [], 0

    def encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in which no special token is looked for."""
        if len(self._known) > MAX_WORDS:
            self.forget()
        known, new, found = self._known, [], []
        for text in texts:
            row = []
            for word in self.words.findall(text):
                n = known.get(word)
                if n is None:
                    n = known[word] = len(known)
                    new.append(word)
                row.append(n)
            found.append(np.array(row, dtype=np.int64))
        self._learn(new)
        which = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        lengths = self._counts[which]
        ends = run_starts(lengths)[run_starts(np.array([len(f) for f in found], dtype=np.int64))]
        return self._ids[spread(self._firsts[which], lengths)], np.diff(ends)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, special tokens included where they are spelled out."""
        special = [k for k, t in enumerate(texts) if self.special and any(s in t for s in self.specials)]
        if not special:
            return self.encode_plain(texts)
        parts, owner, fixed = [], [], {}
        marked = set(special)
        for k, text in enumerate(texts):
            at = 0
            for m in self.special.finditer(text) if k in marked else ():
                parts += [text[at : m.start()], ""]
                fixed[len(parts) - 1] = self.specials[m.group()]
                owner += [k, k]
                at = m.end()
            parts.append(text[at:])
            owner.append(k)
        ids, counts = self.encode_plain(parts)
        pieces = list(documents_of(ids, counts))
        for k, n in fixed.items():
            pieces[k] = np.array([n], dtype=np.uint32)
        sizes = np.bincount(owner, weights=[len(p) for p in pieces], minlength=len(texts)).astype(np.int64)
        return np.concatenate(pieces), sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        ids = np.asarray(ids, dtype=np.int64)
        return self.bytes[spread(self.starts[ids], self.lengths[ids])].tobytes()


_TOOLS: dict[str, tuple[Bpe, ChunkEncoder]] = {}


def tools(path: str) -> tuple[Bpe, ChunkEncoder]:
    """A worker's tables for a tokenizer file, kept between tasks."""
    if path not in _TOOLS:
        bpe = Bpe(path)
        _TOOLS[path] = bpe, ChunkEncoder(spaced_chunks, bpe.encode)
    return _TOOLS[path]


def encode_documents(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, ids (an array) and decoded (the text that the ids give back)."""
    return _over(docs, path, doc_id, text, digests=False)


def digest_documents(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    return _over(docs, path, doc_id, text, digests=True)


def _over(docs: DataFrame, path: str | None, doc_id: str, text: str, digests: bool) -> DataFrame:
    path = path or public_tokenizers.path(TOKENIZER)
    schema = "doc_id bigint, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<bigint>, decoded string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = tools(path)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                ids, counts = encoder(texts_between(texts, lo, hi))
                data = np.frombuffer(bpe.decode(ids), dtype=np.uint8)
                cuts = np.r_[0, np.cumsum(bpe.lengths[ids])][run_starts(counts)].tolist()
                first, second = [], []
                for own, a, b in zip(documents_of(ids, counts), cuts[:-1], cuts[1:]):
                    raw = data[a:b].tobytes()
                    back = raw.decode("utf-8", "replace")
                    first.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest() if digests else own.astype(np.int64))
                    second.append(hashlib.sha256(back.encode()).hexdigest() if digests else back)
                kinds = [pa.string(), pa.string()] if digests else [pa.list_(pa.int64()), pa.string()]
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(counts.astype(np.int64)), pa.array(first, kinds[0]), pa.array(second, kinds[1])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))])
        encoder.forget()
        bpe.forget()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"))
