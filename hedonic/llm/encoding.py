"""Token ids of many texts by the tokenizers library, each distinct chunk encoded once.

A text is cut only where both sides are encoded alike alone and together, so the ids of
a text are those of its chunks, one after another. A task keeps the ids of the chunks it
has met; the cache is emptied when it has grown to a fixed size.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from hedonic.llm.common import give_back, run_starts, spread

MAX_CHUNKS = 300_000
MAX_CHARS = 16 << 20

_AFTER_GAP = re.compile(r"\s ")
_OPEN = re.compile(r"(?<=\S) ")


def spaced_chunks(text: str) -> list[str]:
    """Chunks of a text for byte-level encoders, which keep white space.

    Their pattern always starts a new piece at a space after a character that is not
    white space, and never looks back, so the text may be cut there.
    """
    if _AFTER_GAP.search(text) or text[:1] == " ":
        first, *rest = _OPEN.split(text)
    else:
        first, *rest = text.split(" ")
    return [first, *[" " + c for c in rest]]


def bare_chunks(text: str) -> list[str]:
    """Chunks of a text for encoders that drop white space: cut at every space and line end."""
    return text.replace("\n", " ").split(" ")


class _Numbers(dict):
    """Numbers distinct chunks in the order in which they are met."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class ChunkEncoder:
    """Encodes texts by way of a bounded table of their chunks.

    ``encode`` takes distinct chunks and returns their ids in one flat array and the
    number of ids of each.
    """

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.split, self.encode = split, encode
        self._reset()

    def _reset(self) -> None:
        self.numbers, self.chars, self.used = _Numbers(), 0, 0
        self.counts = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.uint32)

    def forget(self) -> None:
        """Give the tables' memory back, as at the end of a task: a worker lives on for other work."""
        self._reset()
        give_back()

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        ids, counts = self.encode(new)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts = np.concatenate([self.starts, self.used + run_starts(counts)[:-1]])
        self.counts = np.concatenate([self.counts, counts])
        self.used += len(ids)
        self.chars += sum(map(len, new))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one flat array, and the number of ids of each text."""
        if len(self.numbers) > MAX_CHUNKS or self.chars > MAX_CHARS:
            self._reset()
        sizes, which = self._numbered(texts)
        self._learn()
        lengths = self.counts[which]
        ids = self.ids[spread(self.starts[which], lengths)]
        ends = run_starts(lengths)[run_starts(sizes)]
        return ids, np.diff(ends)

    def _numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of chunks of each text, and the numbers of all chunks."""
        number, split = self.numbers.__getitem__, self.split
        sizes, found = [], []
        for text in texts:
            chunks = split(text)
            sizes.append(len(chunks))
            found.extend(map(number, chunks))
        return np.array(sizes, dtype=np.int64), np.array(found, dtype=np.int64)


class SpacedEncoder(ChunkEncoder):
    """The same for texts that are cut at spaces: Arrow cuts them and finds the distinct chunks of a call.

    Marks after a word and single line ends between words are pieces of their own, so that
    the table knows words and marks (see ``only_letters``). Texts with gaps of several spaces are cut one by one.
    """

    def __init__(self, keeps_space: bool, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.keeps_space = keeps_space
        super().__init__(spaced_chunks if keeps_space else bare_chunks, encode)

    def _odd(self, text: str) -> bool:
        return self.keeps_space and (text[:1] == " " or _AFTER_GAP.search(text) is not None)

    def _numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = {k: super(SpacedEncoder, self)._numbered([t])[1] for k, t in enumerate(texts) if self._odd(t)}
        usual = [k for k in range(len(texts)) if k not in odd]
        cut = pc.split_pattern(pa.array([texts[k] if self.keeps_space else texts[k].replace("\n", " ") for k in usual], pa.large_string()), " ")
        ends = run_starts(pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64))
        chunks = cut.flatten().dictionary_encode()
        codes, chunks = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64), chunks.dictionary
        numbers, parts = self._pieces(chunks)
        if self.keeps_space and len(usual):
            # a text's first chunk has no space before it: it is taken whole, as a row of its own
            leads = [self.numbers[c] for c in _strings(chunks.take(pa.array(codes[ends[:-1]])))]
            codes[ends[:-1]] = len(parts) + np.arange(len(leads))
            numbers, parts = np.concatenate([numbers, leads]), np.concatenate([parts, np.ones(len(leads), dtype=np.int64)])
        pieces = numbers[spread(run_starts(parts)[codes], parts[codes])]
        sizes = np.zeros(len(texts), dtype=np.int64)
        sizes[usual] = np.diff(run_starts(parts[codes])[ends])
        if not odd:
            return sizes, pieces
        for k, own in odd.items():
            sizes[k] = len(own)
        starts = run_starts(sizes)
        which = np.empty(int(starts[-1]), dtype=np.int64)
        which[spread(starts[usual], sizes[usual])] = pieces
        for k, own in odd.items():
            which[starts[k] : starts[k + 1]] = own
        return sizes, which

    def _pieces(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the pieces of distinct chunks, one after another, and how many pieces each has.

        A chunk whose lines all are a word and marks is cut into these and the line ends;
        any other is one piece. The first word has the space before it.
        """
        lines = pc.split_pattern(chunks, "\n")
        parts = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts, lines = run_starts(parts)[:-1], lines.flatten()
        words = pc.utf8_rtrim(lines, MARKS)
        marked = pc.not_equal(pc.binary_length(words), pc.binary_length(lines)).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(chunks)), parts)
        several = marked | (parts > 1)[owner]
        plain = np.ones(len(lines), dtype=bool)
        plain[several] = only_letters(words.filter(pa.array(several)))
        whole = np.bincount(owner[~plain], minlength=len(chunks)) > 0
        # of a line: the line end before it, its word and its marks
        first = np.zeros(len(lines), dtype=bool)
        first[firsts] = True
        cut = ~whole[owner]
        width = np.where(cut, 1 + marked + ~first, first.astype(np.int64))
        at = run_starts(width)
        numbers = np.empty(int(at[-1]), dtype=np.int64)
        lead, rest = np.flatnonzero(first), np.flatnonzero(cut & ~first)
        space = " " if self.keeps_space else ""
        numbers[at[lead]] = self._known(pc.if_else(pa.array(whole), chunks, words.take(pa.array(lead))), space)
        if len(rest):
            numbers[at[rest]] = self.numbers["\n"]
            numbers[at[rest] + 1] = self._known(words.take(pa.array(rest)), "")
        ending = np.flatnonzero(cut & marked)
        after = pa.array(ending)
        numbers[at[ending + 1] - 1] = [self.numbers[line[len(w) :]] for line, w in zip(_strings(lines.take(after)), _strings(words.take(after)))]
        return numbers, np.bincount(owner, weights=width, minlength=len(chunks)).astype(np.int64)

    def _known(self, names: pa.Array, before: str) -> np.ndarray:
        """The numbers of texts with ``before`` before each."""
        coded = names.dictionary_encode()
        names = coded.dictionary
        if before:
            names = pc.binary_join_element_wise(pa.scalar(before, names.type), names, pa.scalar("", names.type))
        known = np.fromiter(map(self.numbers.__getitem__, _strings(names)), dtype=np.int64, count=len(names))
        return known[coded.indices.to_numpy(zero_copy_only=False)]


# Words encoded in one call, and the marks that are cut off a word's end.
JOINED = 1000
MARKS = ".,!?#$%&*"


def _strings(texts: pa.Array) -> list[str]:
    """The same as ``to_pylist``, made in one go."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def only_letters(words: pa.Array) -> np.ndarray:
    """Which texts are letters in the normal form and lower case that encoders may apply.

    Encoders cut between letters and marks, so a word of those and the marks after it
    (``MARKS``) may be encoded by themselves.
    """
    plain = pc.ascii_is_alpha(words).to_numpy(zero_copy_only=False).copy()
    others = np.flatnonzero(~plain & ~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
    plain[others] = [w.isalpha() and unicodedata.normalize("NFC", w).lower().isalpha() for w in _strings(words.take(pa.array(others)))]
    return plain


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}
class _Library:
    """A tokenizer of the library that encodes many distinct pieces."""

    def __init__(self, name: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaced = keeps_space
        # ids at which a word begins (those with the letter for a space) or ends
        vocab = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, n in vocab.items():
            self.edge[n] = token.startswith("\u0120") if keeps_space else token.endswith("</w>")
        self.line_end = vocab.get("\u010a", -1)

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        counts = np.array([len(i) for i in ids], dtype=np.int64)
        return np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(counts.sum())), counts

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words by one call, told apart by their first or last ids; by one call each if that doesn't add up."""
        ids, _ = self._each([("" if self.spaced else "\n").join(words)])
        edges = np.flatnonzero(self.edge[ids])
        if len(edges) != len(words) or edges[0 if self.spaced else -1] != (0 if self.spaced else len(ids) - 1):
            return self._each(words)
        return ids, np.diff(np.r_[edges, len(ids)] if self.spaced else np.r_[-1, edges])

    def _in_lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words without a space, which line ends tell apart."""
        ids, _ = self._each(["\n".join(words)])
        edges = np.flatnonzero(ids == self.line_end)
        counts = np.diff(np.r_[-1, edges, len(ids)]) - 1
        if len(counts) != len(words) or not counts.all():
            return self._each(words)
        return ids[ids != self.line_end], counts

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in one flat array, and the number of ids of each."""
        words = pa.array(pieces, pa.large_string())
        letters, bare = only_letters(words), np.zeros(len(pieces), dtype=bool)
        if self.spaced:
            bare = letters
            letters = only_letters(pc.utf8_slice_codeunits(words, 1)) & pc.starts_with(words, " ").to_numpy(zero_copy_only=False)
        plain, lone, other = (np.flatnonzero(x).tolist() for x in (letters, bare, ~(letters | bare)))
        parts = [self._joined([pieces[k] for k in plain[lo : lo + JOINED]]) for lo in range(0, len(plain), JOINED)]
        parts += [self._in_lines([pieces[k] for k in lone[lo : lo + JOINED]]) for lo in range(0, len(lone), JOINED)]
        parts.append(self._each([pieces[k] for k in other]))
        flat, sizes = (np.concatenate(x) for x in zip(*parts))
        counts, firsts, order = np.empty_like(sizes), np.empty_like(sizes), plain + lone + other
        counts[order], firsts[order] = sizes, run_starts(sizes)[:-1]
        return flat[spread(firsts, counts)], counts


def library_encoder(name: str, keeps_space: bool) -> ChunkEncoder:
    """A worker's encoder for a tokenizer file of the tokenizers library; the tokenizer is kept between tasks."""
    key = (name, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = SpacedEncoder(keeps_space, _Library(name, keeps_space).encode)
    return _ENCODERS[key]


def documents_of(ids: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of each text as a view."""
    ends = run_starts(counts)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield ids[a:b]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with an end id after each."""
    total = counts + 1
    out = np.empty(int(total.sum()), dtype=np.uint32)
    last = np.cumsum(total) - 1
    keep = np.ones(len(out), dtype=bool)
    keep[last] = False
    out[last], out[keep] = end_id, ids
    return out, total
