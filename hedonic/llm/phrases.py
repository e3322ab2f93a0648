"""Phrases whose words stand together more often than chance would have it.

Texts are read as words and marks (a mark ends a piece) and cut by prefix-free parsing: a
window of ``LONGEST - 1`` words or marks whose hash is a multiple of ``SPACING`` ends a chunk
and begins the next one, which therefore overlaps it by that window. The place of a cut
depends on the words around it alone, so passages that recur give the same chunks: the
distinct ones with their frequencies in the parse are the dictionary, written once, and all
counting is done in it. A run of up to ``LONGEST`` words lies in one chunk at least, and
one that lies in an overlap is counted in the earlier chunk only: in a chunk that continues
another, runs that end inside its first window are left out.

Runs are counted in passes over the dictionary (``PASSES``, the lengths of each). A run can
be frequent only if all its parts are, and the longest ones of the pass before are known as
bits in a table of fixed size (``BITS``): a part's hash may meet another's bit, which lets a
rare run through, but never loses one; exact counts decide afterwards. Tasks count their
runs on word numbers, sums are made in the shuffle, and every frequent run is a row of a
table joined by its words.

Defined cases: a NULL text counts as empty, a NULL language as ``und``; repeated rows count
each; texts without words give nothing; an empty table gives no rows; other columns are
ignored. A text is cut in one task, whatever its length; words may have any length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic.llm.common import SLICE_BYTES, run_starts, spread, table, text_slices
from hedonic.session import Lookup, written

LONGEST = 5
LEAST = 100
REPORTED = 2000
SPACING = 64
PASSES = ((1,), (2,), (3,), (4, 5))
# Bits of the table of frequent runs: 8 MiB, whatever the input.
BITS = 1 << 26
# Marks that end a piece, and the tab, a gap like the space.
_CLEAN = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\t", b"\n" * 10 + b" ")
# Numbers of the empty word between two gaps, of a mark and of the end of a text; those of words are above.
_EMPTY, _MARK, _END = 0, 1, 2
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


class _Words(dict):
    """Numbers words as they are met."""

    def __init__(self):
        super().__init__({b"": _EMPTY, b"\n": _MARK, b"\r": _END})
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class _Reader:
    """Word numbers of texts; the numbers start anew when a slice begins with very many words known."""

    MOST = 500_000

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.numbers = _Words()
        self.words = pa.array(["", "\n", "\r"], pa.large_string())
        self.hashes = np.array([0, 1, 2], dtype=np.uint64)

    def read(self, texts: list[bytes]) -> np.ndarray:
        """The words and marks of all texts by number, with an end between two texts."""
        if len(self.hashes) > self.MOST:
            self._reset()
        tokens = b" \r ".join(texts).split(b" ")
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        new, self.numbers.new = self.numbers.new, []
        if new:
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(xxhash.xxh64_intdigest, new), dtype=np.uint64, count=len(new))])
            self.words = pa.concat_arrays([self.words, pa.array(new, pa.large_binary()).cast(pa.large_string())])
        return ids[ids != _EMPTY]

    def joined(self, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of runs, their words parted by single spaces."""
        runs = pa.LargeListArray.from_arrays(pa.array(run_starts(counts)), self.words.take(pa.array(ids[spread(starts, counts)])))
        return pc.binary_join(runs, pa.scalar(" ", pa.large_string())).cast(pa.string())


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values * _FACTOR
    return values ^ (values >> _SHIFT)


def _extended(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of runs with a further word each."""
    return _mixed(run + _FACTOR) + word


def _cuts(ids: np.ndarray, hashes: np.ndarray, window: int, spacing: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first place, length and ``goes_on`` (overlaps the chunk before it) of each chunk."""
    ends = np.flatnonzero(ids == _END)
    firsts, lasts = np.r_[0, ends + 1], np.r_[ends, len(ids)]
    at = np.zeros(0, dtype=np.int64)
    if len(ids) >= window:
        rolled = hashes[ids[: len(ids) - window + 1]]
        for k in range(1, window):
            rolled = _extended(rolled, hashes[ids[k : len(ids) - window + 1 + k]])
        at = np.flatnonzero(_mixed(rolled) % np.uint64(spacing) == 0)
        text = np.searchsorted(firsts, at, side="right") - 1
        # a window inside one text that neither begins nor ends it
        at = at[(at > firsts[text]) & (at + window < lasts[text])]
    begins = np.concatenate([firsts, at])
    goes_on = np.r_[np.zeros(len(firsts), dtype=bool), np.ones(len(at), dtype=bool)]
    order = np.argsort(begins, kind="stable")
    begins, goes_on = begins[order], goes_on[order]
    text = np.cumsum(~goes_on) - 1
    sizes = np.where(np.r_[goes_on[1:], False], np.r_[begins[1:], 0] + window, lasts[text]) - begins
    full = sizes > 0
    return text[full], begins[full], sizes[full], goes_on[full]


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang", window: int = LONGEST - 1, spacing: int = SPACING) -> DataFrame:
    """The dictionary of the parse: lang, goes_on, chunk (words and marks parted by spaces) and its frequency ``n``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                ids = reader.read([t.encode().lower().translate(_CLEAN).replace(b"\n", b" \n ") for t in texts.slice(lo, hi - lo).to_pylist()])
                ids = ids[~((ids == _MARK) & (np.r_[_END, ids[:-1]] == _MARK))]  # one mark between two pieces is enough
                text, begins, sizes, goes_on = _cuts(ids, reader.hashes, window, spacing)
                languages = batch.column("lang").slice(lo, hi - lo).take(pa.array(text))
                found = pa.table({"lang": languages, "goes_on": pa.array(goes_on), "chunk": reader.joined(begins, sizes, ids)})
                counted = found.group_by(["lang", "goes_on", "chunk"]).aggregate([([], "count_all")])
                columns = [counted.column(c).combine_chunks() for c in ("lang", "goes_on", "chunk", "count_all")]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "goes_on", "chunk", "n"])

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parsed = rows.mapInArrow(parse, "lang string, goes_on boolean, chunk string, n bigint")
    return written(parsed.groupBy("lang", "goes_on", "chunk").agg(F.sum("n").alias("n")), "chunks")


def _groups(hashes: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One element of each group of equal parts, and the group of each element; equal hashes are looked at again."""
    group, values = pd.factorize(hashes)
    first = np.empty(len(values), dtype=np.int64)
    first[group[::-1]] = np.arange(len(group))[::-1]
    if all(np.array_equal(p, p[first[group]]) for p in parts):
        return first, group
    _, first, group = np.unique(np.stack(parts, axis=1), axis=0, return_index=True, return_inverse=True)
    return first, group.reshape(-1)


def _known(bits: bytes, runs: np.ndarray) -> np.ndarray:
    """Whether the bits of runs are set."""
    at = (runs % np.uint64(8 * len(bits))).astype(np.int64)
    return (np.frombuffer(bits, dtype=np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _language_hashes(languages: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's language, and the hash of each number."""
    coded = languages.dictionary_encode()
    names = coded.dictionary.to_pylist()
    return coded.indices.to_numpy(zero_copy_only=False), np.array([xxhash.xxh64_intdigest(x.encode()) for x in names], dtype=np.uint64)


def _grown(ids: np.ndarray, seeds: np.ndarray, hashes: np.ndarray, longest: int, shorter: Broadcast | None, known: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and hashes of the runs up to ``longest`` words; the longer ones only if all their parts of ``known`` words may be frequent."""
    word = np.r_[ids > _END, np.zeros(longest, dtype=bool)]
    may = np.zeros(len(word), dtype=bool)
    at = np.flatnonzero(word)
    run = _extended(seeds[at], hashes[ids[at]])
    for size in range(1, longest + 1):
        if size > 1:
            fits = word[at + size - 1]
            if shorter is not None and size > known:
                fits &= may[at] & may[at + size - known]
            at, run = at[fits], run[fits]
            run = _extended(run, hashes[ids[at + size - 1]])
        if size == known:
            may[at] = _known(shorter.value, run)
        yield size, at, run


def _runs(dictionary: DataFrame, sizes: Sequence[int], shorter: Broadcast | None, window: int) -> DataFrame:
    """How often runs of these lengths occur: lang, phrase, size, n. ``shorter`` is the table of those a word shorter than the first length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            for lo, hi in text_slices(batch.column("chunk"), 4 * SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                ids = reader.read([c.encode() for c in part.column("chunk").to_pylist()])
                ends = ids == _END
                chunk, starts = np.cumsum(ends), np.r_[0, np.flatnonzero(ends) + 1]
                codes, seeds = _language_hashes(part.column("lang"))
                goes_on, weight = part.column("goes_on").to_numpy(zero_copy_only=False), part.column("n").to_numpy()
                for size, at, run in _grown(ids, seeds[codes][chunk], reader.hashes, sizes[-1], shorter, sizes[0] - 1):
                    if size not in sizes:
                        continue
                    fresh = ~goes_on[chunk[at]] | (at + size - 1 - starts[chunk[at]] >= window)
                    at, run = at[fresh], run[fresh]
                    first, group = _groups(run, [codes[chunk[at]], *[ids[at + k] for k in range(size)]])
                    # whole numbers stay exact in doubles below 2 ** 53
                    sums = np.bincount(group, weights=weight[chunk[at]], minlength=len(first)).astype(np.int64)
                    some = at[first]
                    lengths = np.full(len(some), size, dtype=np.int64)
                    # one short key for the shuffle: the phrase, which has no line end, and the language
                    keys = pc.binary_join_element_wise(reader.joined(some, lengths, ids), part.column("lang").take(pa.array(chunk[some])), "\n")
                    yield pa.RecordBatch.from_arrays([keys, pa.array(sums)], names=["key", "n"])

    counted = dictionary.mapInArrow(count, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\n", 1)
    return counted.select(F.expr("substring(key, instr(key, '\n') + 1)").alias("lang"), phrase.alias("phrase"), F.size(F.split(phrase, " ")).alias("size"), "n")


def _bits(frequent: DataFrame, size: int, bits: int) -> bytes:
    """A table of ``bits`` with those of the runs of a frame, all of ``size`` words, put together from at most a 64th as many rows."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, seeds = _language_hashes(batch.column("lang"))
            ids = reader.read([p.encode() for p in batch.column("phrase").to_pylist()])
            run = seeds[codes]
            for words in ids[ids != _END].reshape(-1, size).T:
                run = _extended(run, reader.hashes[words])
            at = (run % np.uint64(bits)).astype(np.int64)
            own = (np.uint64(1) << (at % 64).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // 64), pa.array(own)], names=["place", "bits"])

    rows = frequent.mapInArrow(places, "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return out.tobytes()


def frequent_runs(dictionary: DataFrame, least: int = LEAST, passes: Sequence[Sequence[int]] = PASSES, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Runs that occur at least so often (lang, size, phrase, f), and the number of words of each language (lang, n)."""
    levels, words, shorter, window = [], None, None, passes[-1][-1] - 1
    for sizes in passes:
        counted = _runs(dictionary, sizes, shorter, window)
        if words is None:
            counted = written(counted, "words")
            words = counted.groupBy("lang").agg(F.sum("n").alias("n"))
        level = written(counted.filter(F.col("n") >= least).select("lang", "size", "phrase", F.col("n").alias("f")), "runs")
        levels.append(level)
        if shorter is not None:
            shorter.unpersist()
        if sizes != passes[-1]:
            shorter = dictionary.sparkSession.sparkContext.broadcast(_bits(level.filter(F.col("size") == sizes[-1]), sizes[-1], bits))
    return reduce(DataFrame.unionByName, levels), words


def _part(words: Column, start: int | Column, count: int | Column) -> Column:
    return F.array_join(F.slice(words, start, count), " ")


def scored(runs: DataFrame, words: DataFrame) -> DataFrame:
    """Every frequent run of two words and more at its worst cut: lang, phrase, a, k, l, r, n, score."""
    candidates = runs.filter("size > 1").withColumn("_w", F.split("phrase", " "))
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), "size", "_w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.col("_w"), F.lit(1), F.col("k")).alias("left"), _part(F.col("_w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    left = runs.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = runs.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # parts of a frequent run are as frequent, so every cut finds both of its parts
    both = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(Lookup(words).side, "lang")
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    over = F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"]
    both = both.withColumn("_over", over.cast("decimal(38,0)")).withColumn("_under", (exact["l"] * exact["r"]).cast("decimal(38,0)"))
    both = both.withColumn("score", F.expr("_over div _under"))
    worst = both.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_m"))
    return worst.select("lang", "phrase", "a", "_m.k", "_m.l", "_m.r", "n", "_m.score")


def contained(runs: DataFrame) -> DataFrame:
    """Runs that lie inside one a word longer (lang, phrase), with the most that such a one occurs.

    A run inside one that is longer by several words and as frequent lies inside one of
    each length between, which are as frequent too: a word more is enough to look at.
    """
    longer = runs.filter("size > 2").withColumn("_w", F.split("phrase", " "))
    n = F.col("size") - 1
    parts = longer.select("lang", "f", F.explode(F.array(_part(F.col("_w"), F.lit(1), n), _part(F.col("_w"), F.lit(2), n))).alias("phrase"))
    return parts.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, reported: int = REPORTED, spacing: int = SPACING, bits: int = BITS) -> DataFrame:
    """The first ``reported`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    runs, words = frequent_runs(chunks(docs, text, lang, spacing=spacing), least, bits=bits)
    free = scored(runs, words).join(contained(runs), ["lang", "phrase"], "left").filter(F.coalesce(F.col("most") * 100 < F.col("a") * 100, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    # a rank filter: every task keeps its own first rows before the shuffle
    first = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= reported)
    return first.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 100),
t AS (SELECT *, unnest(range(1, size)) AS cut FROM c),
s AS (
  SELECT t.lang, t.phrase, t.size, a, cut, x.f AS l, y.f AS r, n.n AS n,
         (1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM t JOIN n ON n.lang = t.lang
         JOIN f x ON x.lang = t.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
         JOIN f y ON y.lang = t.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
u AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size AND 100 * c.a >= 100 * b.a
                      AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM u QUALIFY rank <= 2000
"""
