"""Best-fit packing of documents into sequences by bin completion.

Documents become pieces of at most one sequence's length; only longer documents are cut.
How many pieces there are of each length is all that the search needs: that histogram has
one entry per length, however many documents there are. The search fills one sequence at
a time around the longest piece left. It enumerates undominated fillings (a piece that
fits exactly beats every other filling; a filling is dropped when another one of as many
pieces is nowhere shorter), tries them by least waste, and goes back when the waste so far
exceeds what a better result than the best known one could afford. Best-fit decreasing
gives the first known result. A filling is first repeated while its pieces last, so that the
plan has a few thousand entries, and fewer times when the search comes back. The search ends at the lower bound, or after a
documented number of steps with the best result found.

The plan is then applied to the pieces in the tasks: a piece's number within its length
tells its sequence and place. Numbers come from ``numbering``, so no length, however
common, meets in one task, and no token id is shuffled.

Defined cases: a NULL or empty text is its end id alone; repeated rows are packed each;
an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm.common import run_starts, table, text_slices, texts_between
from hedonic.llm.encoding import documents_of, library_encoder, with_end
from hedonic.llm.numbering import numbered

CAPACITY = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# Steps of the search (fillings tried, and wastes that no undominated filling has) after which the best result so far is taken.
MAX_STEPS = 20_000
# Open choices that keep their table of totals; the others make it anew when the search comes back to them.
HELD = 64


@dataclass
class Plan:
    """Fillings, each a list of lengths, longest first, with the number of sequences that get it."""

    capacity: int
    fillings: list[tuple[tuple[int, ...], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.fillings)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least: by total length, or by the pieces that cannot share with longer ones."""
    lengths = np.arange(len(counts))
    total = int((counts * lengths).sum())
    best = -(-total // capacity)
    many, mass = run_starts(counts), run_starts(counts * lengths)
    for small in range(capacity // 2 + 1):
        # pieces over capacity - small stand alone against those of small or more;
        # pieces over half stand in sequences of their own
        alone = int(many[-1] - many[capacity - small + 1])
        lo, hi = capacity // 2 + 1, capacity - small + 1
        halves = int(many[hi] - many[lo]) if hi > lo else 0
        room = halves * capacity - int(mass[hi] - mass[lo]) if hi > lo else 0
        rest = int(mass[min(lo, hi)] - mass[small])
        best = max(best, alone + halves + max(0, -(-(rest - room) // capacity)))
    return best


class _Stock:
    """Pieces left of each length, and the lengths that are left, in order."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.tolist()
        self.left = [length for length, n in enumerate(self.counts) if n and length]

    def longest(self, most: int) -> int:
        """The longest length left of at most ``most``; 0 if none."""
        at = bisect_right(self.left, most)
        return self.left[at - 1] if at else 0

    def take(self, filling: tuple[int, ...], times: int) -> None:
        for length in filling:
            self.counts[length] -= times
            if not self.counts[length]:
                del self.left[bisect_left(self.left, length)]

    def give_back(self, filling: tuple[int, ...], times: int) -> None:
        for length in filling:
            if not self.counts[length]:
                insort(self.left, length)
            self.counts[length] += times

    def times(self, filling: tuple[int, ...]) -> int:
        """How often the filling can be taken."""
        return min(self.counts[length] // filling.count(length) for length in set(filling))


def _best_fit(stock: _Stock, room: int, used: dict[int, int]) -> tuple[int, ...]:
    """The longest pieces that fit, one after another; ``used`` are those already taken."""
    out, most = [], room
    while room > 0 and (length := stock.longest(min(room, most))):
        n = min(room // length, stock.counts[length] - used.get(length, 0))
        out += [length] * n
        room -= n * length
        most = length - 1
        if most <= 0:
            break
    return tuple(out)


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> Plan:
    """Every sequence around the longest piece left, filled by the longest pieces that still fit."""
    stock, plan = _Stock(counts), Plan(capacity)
    while first := stock.longest(capacity):
        filling = (first, *_best_fit(stock, capacity - first, {first: 1}))
        times = stock.times(filling)
        stock.take(filling, times)
        plan.fillings.append((filling, times))
    return plan


class _Sums:
    """Which totals the pieces beside a longest one can have, as bits, by how many of the lengths are used."""

    held: list["_Sums"] = []

    def __init__(self, stock: _Stock, first: int, room: int):
        self.room = room
        self.lengths = stock.left[: bisect_right(stock.left, min(room, first))]
        self.most = [min(stock.counts[x] - (x == first), room // x) for x in self.lengths]
        self.bits: list[int] | None = None

    def table(self) -> list[int]:
        """The bits; of all choices that are open, only the ``HELD`` last ones keep them."""
        if self.bits is None:
            self.bits, mask = [1], (2 << self.room) - 1
            for length, rest in zip(self.lengths, self.most):
                bits, part = self.bits[-1], 1
                while rest:
                    part = min(part, rest)
                    bits |= bits << part * length & mask
                    rest, part = rest - part, part * 2
                self.bits.append(bits)
            self.held.append(self)
            if len(self.held) > HELD:
                self.held.pop(0).bits = None
        return self.bits

    def lengthens(self, at: int, waste: int, picked: tuple[int, ...]) -> bool:
        """Whether a longer piece is left that fits instead of one of ``lengths[at]``: then another filling dominates."""
        for k in range(at + 1, len(self.lengths)):
            if self.lengths[k] - self.lengths[at] > waste:
                return False
            if picked.count(self.lengths[k]) < self.most[k]:
                return True
        return False

    def exactly(self, upto: int, total: int, waste: int, picked: tuple[int, ...] = ()) -> Iterator[tuple[int, ...]]:
        """``picked`` and undominated pieces of the first ``upto`` lengths that add up to ``total``, the longest first."""
        if not total:
            yield picked
            return
        for at in range(bisect_right(self.lengths, total, 0, upto) - 1, -1, -1):
            if not self.table()[at + 1] >> total & 1:
                return
            if self.lengthens(at, waste, picked):
                continue
            length = self.lengths[at]
            for n in range(min(self.most[at], total // length), 0, -1):
                if self.table()[at] >> total - n * length & 1:
                    yield from self.exactly(at, total - n * length, waste, picked + (length,) * n)


def _fillings(stock: _Stock, first: int, capacity: int, slack: Callable[[], int]) -> Iterator[tuple[int, ...]]:
    """All undominated fillings around ``first`` that waste at most ``slack()``, least waste first; () for a waste of none."""
    room = capacity - first
    if 0 < room <= first and stock.counts[room] > (room == first):
        yield (first, room)  # fits exactly: dominates the rest
        return
    sums = _Sums(stock, first, room)
    for waste in range(room + 1):
        if waste > slack():
            return
        some = False
        for filling in sums.exactly(len(sums.lengths), room - waste, waste):
            some = True
            yield (first, *filling)
        if not some:
            yield ()


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY, max_steps: int = MAX_STEPS) -> Plan:
    """The plan for ``counts[length]`` pieces of each length, by bin completion.

    Depth-first over the fillings of the longest piece left. A branch ends when its waste
    exceeds what one sequence fewer than the best known result leaves.
    """
    counts = np.asarray(counts, dtype=np.int64)
    if len(counts) > capacity + 1 and counts[capacity + 1 :].any():
        raise ValueError("a piece is longer than a sequence")
    best, bound = best_fit_decreasing(counts, capacity), lower_bound(counts, capacity)
    total = int((counts * np.arange(len(counts))).sum())
    stock, waste, steps = _Stock(counts), 0, 0
    # one entry per choice made: the filling, its number and its waste; and the choices left
    path: list[tuple[tuple[int, ...], int, int]] = []
    choices: list[Iterator[tuple[tuple[int, ...], int]]] = []

    def slack() -> int:
        """The waste that a better result can still afford."""
        return (best.sequences - 1) * capacity - total - waste

    def choices_of(first: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Every filling as often as its pieces last, then every one fewer times."""
        for filling in _fillings(stock, first, capacity, slack):
            yield filling, stock.times(filling) if filling else 0
        for filling in _fillings(stock, first, capacity, slack) if stock.counts[first] > 1 else ():
            for times in range(stock.times(filling) - 1 if filling else 0, 0, -1):
                yield filling, times

    def enter() -> None:
        """Open the choices of the longest piece left, or take the finished result if it is better."""
        nonlocal best
        first = stock.longest(capacity)
        choices.append(choices_of(first) if first else iter(()))
        if not first and sum(n for _, n, _ in path) < best.sequences:
            best = Plan(capacity, [(filling, n) for filling, n, _ in path])

    enter()
    while choices and best.sequences > bound and steps < max_steps:
        choice = next(choices[-1], None)
        if choice is None:
            choices.pop()
            if path:
                filling, times, lost = path.pop()
                stock.give_back(filling, times)
                waste -= lost
            continue
        (filling, times), steps = choice, steps + 1
        if not times:
            continue
        lost = (capacity - sum(filling)) * times
        if lost > slack():
            continue
        stock.take(filling, times)
        waste += lost
        path.append((filling, times, lost))
        enter()
    _Sums.held.clear()
    return best


def placements(plan: Plan) -> np.ndarray:
    """Rows (length, first number, numbers, first sequence, pieces per sequence, offset), ordered by length and first number.

    Of the pieces of a length, those with numbers from ``first number`` on go to the
    sequences from ``first sequence`` on, ``pieces per sequence`` to each.
    """
    rows, given, sequence = [], {}, 0
    for filling, times in plan.fillings:
        at = 0
        for length in sorted(set(filling), reverse=True):
            each = filling.count(length)
            begin = given.get(length, 0)
            rows.append((length, begin, each * times, sequence, each, at))
            given[length] = begin + each * times
            at += each * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and its ids (little-endian, 32 bits) if wanted."""
    schema = T.StructType.fromDDL("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else ""))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, keeps_space=False)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                ids, counts = with_end(*encoder(texts_between(texts, lo, hi)), end_id)
                names, ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist(), ids.astype("<u4")
                rows = [
                    (name, k, a, len(part), zlib.crc32(part), *([part.tobytes()] if with_ids else []))
                    for name, own in zip(names, documents_of(ids, counts))
                    for k, a in enumerate(range(0, len(own), capacity))
                    for part in [own[a : a + capacity]]
                ]
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)
        encoder.forget()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def pack(parts: DataFrame, capacity: int = CAPACITY, max_steps: int = MAX_STEPS) -> DataFrame:
    """``parts`` with the sequence and the offset of each piece; ``length`` is its length."""
    spark = parts.sparkSession
    ranked = numbered(parts, "length", "_rank", "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in ranked.groupBy("length").count().collect():  # one row per length
        counts[row["length"]] = row["count"]
    # bounded by the lengths, not by the pieces: each entry of the plan uses up a length
    plan = spark.sparkContext.broadcast(placements(plan_packing(counts, capacity, max_steps)))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    names = parts.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, begin, _, sequence, each, offset = plan.value.T
        keys = (length << 48) + begin
        for batch in batches:
            own, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (own << 48) + rank, side="right") - 1
            inside = rank - begin[at]
            put = [sequence[at] + inside // each[at], offset[at] + inside % each[at] * own]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *map(pa.array, put)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Per sequence its ids, in order; ``packed`` comes from pieces with ids. A sequence is bounded by its capacity."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return rows.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("length"), F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, **options), options.get("capacity", CAPACITY))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
