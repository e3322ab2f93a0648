"""Near-duplicates by SimHash and the Jaccard similarity of their word shingles, exactly.

Documents are linked if their sets of shingles have a similarity of at least
``PARTS`` / ``WHOLE``. The closest copies come from operator 4: every set has a SimHash
fingerprint, ``simhash.links`` finds those within two bits, and the sets that these stand for
are linked if their shingles are similar enough. Fingerprints that far apart miss most pairs
of the wanted similarity (at 0.8 they differ in some nine of 64 bits), so the pairs that are
not in one component by then come from a prefix filter.

Two similar sets of n shingles and more share one of the first
n - ceil(n * PARTS / WHOLE) + 1 shingles of either one under any common order (prefix
filter), so only documents that share one of those are compared, and no pair is missed.
The order decides the cost alone: shingles that are common in a sample come last.

Equal sets are made one before anything is spread out, so copies cost one row each. A
shingle that only one set has links nothing: those that several have are known as bits in a
table of fixed size, and the others are dropped in the tasks, before the shuffle. A bit may
stand for several shingles, which keeps some more, but loses none; a count of what is
left then drops those too.

Every set has a sketch of one to two bits per shingle: for each remainder of the hashes,
whether an odd number of them has it. Two sets differ in as many shingles at least as their
sketches differ in bits, so a pair whose sketches differ too much is ruled out without its
sets, and no similar pair is. Only the sets of the pairs left are made and shuffled.

The members of a shingle are first linked to a representative, so a group of near copies
soon is one component, and only shingles with members of several components go on. The
members of one that few sets share are paired, and the distinct pairs verified. Those of a
common one are compared in blocks of bounded size, by their sketches first; the sets of those
with a partner there give each pair of blocks a spanning forest of its links. Rows stay
linear in the members, but the comparisons of a large group that isn't one component by then
grow with its square.

Defined cases: those of ``simhash``; texts without words have equal sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import give_back, words_of
from hedonic.llm.graph import components
from hedonic.llm import simhash
from hedonic.llm.simhash import JOINED_AT_MOST, LOWER, UPPER, first_of_each, shingle_hashes
from hedonic.session import written

SHINGLE = 5
# Least similarity, as a fraction of whole numbers.
PARTS, WHOLE = 4, 5
# Documents sampled for the order of shingles, and shingles that it knows as common.
SAMPLED, COMMON = 20_000, 200_000
# Shingles of more sets than this are first compared with a representative, so many times.
REPRESENTED, ROUNDS = 4, 2
# Members and shingles of a block, about.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 17
# Most bits of a table of shingles or sets: 32 MiB. Every task's machine keeps a copy on disk, so small inputs take less.
BITS = 1 << 28
# Shingles, and rows of a block, compared at a time in a task: its arrays stay small beside the block.
STEP, SLAB = 1024, 128
# Bits of the smallest sketch.
LEAST_BITS = 64


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def shingle_sets(docs: DataFrame, shingle: int, kept: dict[str, Column], text: str) -> DataFrame:
    """The ``kept`` columns, and ``set``: the distinct shingle hashes in order."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    words = docs.select(*[c.alias(n) for n, c in kept.items()], words_of(lowered).alias("_words"))
    return words.select(*kept, F.sort_array(F.array_distinct(shingle_hashes(F.col("_words"), "_words", shingle))).alias("set"))


def common_shingles(docs: DataFrame, shingle: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several sampled texts, in order, and how many texts have each."""
    every = max(1, docs.count() // SAMPLED)
    some = docs.filter(F.pmod(_text_hash(text), F.lit(every)) == 0)
    sets = shingle_sets(some, shingle, {}, text)
    # copies count each; explode would filter by the size of the set below the projections, where the words are bound anew for every shingle
    each = sets.select(F.explode_outer("set").alias("s")).filter("s IS NOT NULL")
    counts = each.groupBy("s").count().filter("count > 2")
    found = counts.orderBy(F.desc("count"), "s").limit(COMMON).orderBy("s").toArrow()  # at most COMMON rows
    return found.column("s").to_numpy(), found.column("count").to_numpy()


def sketch_of(values: np.ndarray) -> bytes:
    """For each remainder of the hashes, whether an odd number of them has it; a power of two of bits, as many as there are hashes or up to twice as many."""
    width = max(LEAST_BITS, 1 << max(len(values) - 1, 0).bit_length())
    return np.packbits((np.bincount(values & (width - 1), minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches (one a row, of bytes or of bits) as they would be with ``width`` columns."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def prefixes(sets: DataFrame, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, _hash, sid (hash of the set), size, fp (SimHash fingerprint of the set), prefix and sketch of every document."""
    shared = sets.sparkSession.sparkContext.broadcast(order)
    names = ["doc_id", "_hash", "sid"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            lists = batch.column("set")
            ends, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
            rank = np.zeros(len(values), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                rank = np.where(known[at] == values, counts[at], 0)
            firsts, sketches = [], []
            for lo, hi in zip(ends[:-1], ends[1:]):
                n = int(hi - lo)
                rare = np.argsort(rank[lo:hi], kind="stable")[: n + (-n * PARTS // WHOLE) + 1] if n else []
                firsts.append(values[lo:hi][rare] if n else values[:0])
                sketches.append(sketch_of(values[lo:hi]))
            columns = [pa.array(np.diff(ends)), pa.array(simhash.majority(lists)), pa.array(firsts, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *columns], names=[*names, "size", "fp", "prefix", "sketch"])
        give_back()

    return sets.select(*names, "set").mapInArrow(cut, "doc_id bigint, _hash bigint, sid bigint, size bigint, fp bigint, prefix array<bigint>, sketch binary")


def bit_table(keys: DataFrame, bits: int) -> bytes:
    """A table with the bits of the 64-bit numbers in column ``key``: some 64 bits for each, ``bits`` at most, put together from at most a 64th as many rows."""
    bits = min(bits, 1 << max(16, (64 * keys.count()).bit_length()))
    at = F.pmod("key", F.lit(bits))
    merged = keys.select(F.shiftright(at, 6).alias("place"), F.expr(f"shiftleft(1L, cast(pmod(key, {bits}) & 63 as int))").alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits"))
    rows, out = merged.toArrow(), np.zeros(bits // 64, dtype=np.int64)
    out[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return out.tobytes()


def postings(sets: DataFrame, bits: int) -> DataFrame:
    """Rows (key, sid, size, n, mass) of the prefixes of distinct sets, n and mass being the members of the shingle and their sizes, 2 and more."""
    shared = sets.select(F.explode("prefix").alias("key")).groupBy("key").count().filter("count > 1").select("key")
    shared = written(shared, "shared-shingles")
    table = sets.sparkSession.sparkContext.broadcast(bit_table(shared, bits))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(table.value, dtype=np.uint8)
        for batch in batches:
            lists = batch.column("prefix")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            values, owner = values[ends[0] : ends[-1]], np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            at = np.mod(values, 8 * len(seen))
            keep = (seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            own = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays([batch.column("sid").take(own), batch.column("size").take(own), pa.array(values[keep])], names=["sid", "size", "key"])

    rows = written(sets.mapInArrow(known, "sid bigint, size bigint, key bigint"), "postings")
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("mass")).filter("n > 1")
    return written(rows.join(counts, "key"), "shared-postings")


def maybe_in(keys: DataFrame, bits: int) -> Callable[[str], Column]:
    """A test whether a column of 64-bit numbers holds one of ``key``, by a table of ``bits``: never wrong for those that do."""
    table = keys.sparkSession.sparkContext.broadcast(bit_table(keys, bits))

    @F.pandas_udf("boolean")
    def test(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = np.frombuffer(table.value, dtype=np.uint8)
        for some in values:
            at = np.mod(some.to_numpy(np.int64), 8 * len(seen))
            yield pd.Series((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)

    return test


def alike(sizes: np.ndarray, others: np.ndarray, overlaps: np.ndarray) -> np.ndarray:
    """Which sets are similar enough to which others, from their sizes and pairwise overlaps."""
    return overlaps * (PARTS + WHOLE) >= PARTS * (sizes[:, None] + others[None, :])


def forest(lists: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges that connect the sets that are linked by similar pairs, each to the first one of its component."""
    n, sizes = len(lists), np.array([len(x) for x in lists], dtype=np.int64)
    values, columns, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    rows, shared = np.repeat(np.arange(n), sizes), times > 1
    place = np.cumsum(shared) - 1
    inside = shared[columns]
    rows, columns = rows[inside], place[columns[inside]]
    by_column = np.argsort(columns, kind="stable")
    rows, columns = rows[by_column], columns[by_column]
    overlaps = np.zeros((n, n), dtype=np.float32)
    for lo in range(0, int(shared.sum()), STEP):
        hi = min(lo + STEP, int(shared.sum()))
        a, b = np.searchsorted(columns, [lo, hi])
        has = np.zeros((n, hi - lo), dtype=np.float32)
        has[rows[a:b], columns[a:b] - lo] = 1
        overlaps += has @ has.T
    linked, todo, edges = np.zeros((n, n), dtype=bool), np.ones(n, dtype=bool), []
    for lo in range(0, n, SLAB):
        linked[lo : lo + SLAB] = alike(sizes[lo : lo + SLAB], sizes, overlaps[lo : lo + SLAB].astype(np.int64))
    for first in range(n):
        if not todo[first]:
            continue
        todo[first] = False
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & todo)
            todo[front] = False
            edges += [(int(k), first) for k in front]
    return edges


def may_be_alike(sizes: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Whether sets can be similar enough, from the sum of their sizes and the bits in which their sketches differ."""
    return odd * (PARTS + WHOLE) <= sizes * (WHOLE - PARTS)


def by_width(sketches: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a column of sketches with as many bytes each, and these bytes, a row for each."""
    if not len(sketches):
        return
    whole = sketches.cast(pa.large_binary())
    starts, data = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1], np.frombuffer(whole.buffers()[2], np.uint8)
    widths = np.diff(starts)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, data[starts[rows][:, None] + np.arange(width)]


def odd_bits(a: pa.Array, b: pa.Array) -> np.ndarray:
    """In how many bits the sketches of each row differ, where both have the width of the smaller."""
    out = np.zeros(len(a), dtype=np.int64)
    for rows, mine in by_width(a):
        for own, others in by_width(b.take(pa.array(rows))):
            width = min(mine.shape[1], others.shape[1])
            out[rows[own]] = np.bitwise_count(folded(mine[own], width) ^ folded(others, width)).sum(axis=1, dtype=np.int64)
    return out


def close_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The ``pairs`` (u, v) of set ids that their sketches don't rule out. ``sketches`` has (sid, size, sketch)."""
    u = sketches.select(F.col("sid").alias("u"), F.col("size").alias("m"), F.col("sketch").alias("x"))
    v = sketches.select(F.col("sid").alias("v"), F.col("size").alias("n"), F.col("sketch").alias("y"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("sizes").to_numpy()
            yield batch.select(["u", "v"]).filter(pa.array(may_be_alike(sizes, odd_bits(batch.column("x"), batch.column("y")))))

    both = pairs.join(u, "u").join(v, "v").select("u", "v", (F.col("m") + F.col("n")).alias("sizes"), "x", "y")
    return both.mapInArrow(test, "u bigint, v bigint")


def similar_pairs(pairs: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The ``pairs`` (u, v) of set ids whose sets are similar enough; only sets of pairs that the sketches leave are made."""
    close = written(close_pairs(pairs, sketches), "close-pairs")
    sets = sets_of(close.select(F.explode(F.array("u", "v")).alias("sid")))
    both = close.join(sets.select(F.col("sid").alias("u"), F.col("set").alias("x")), "u").join(sets.select(F.col("sid").alias("v"), F.col("set").alias("y")), "v")
    similar = F.size(F.array_intersect("x", "y")) * (PARTS + WHOLE) >= PARTS * (F.size("x") + F.size("y"))
    return both.filter(similar).select("u", "v")


def with_partner(sizes: np.ndarray, roots: np.ndarray, sketches: pa.Array) -> np.ndarray:
    """Which sets have one of another component that their sizes and sketches don't rule out."""
    out, classes = np.zeros(len(sizes), dtype=bool), [(rows, np.unpackbits(data, axis=1, bitorder="little")) for rows, data in by_width(sketches)]
    for k, (rows, bits) in enumerate(classes):
        ones, mine = bits.astype(np.float32), bits.sum(axis=1, dtype=np.int64)
        for others, theirs in classes[k:]:
            small = folded(theirs, bits.shape[1])
            their_ones, counts = small.astype(np.float32).T, small.sum(axis=1, dtype=np.int64)
            for lo in range(0, len(rows), SLAB):
                own = rows[lo : lo + SLAB]
                both = (ones[lo : lo + SLAB] @ their_ones).astype(np.int64)
                odd = mine[lo : lo + SLAB, None] + counts[None, :] - 2 * both
                total = sizes[own][:, None] + sizes[others][None, :]
                # sets that differ in size differ in as many shingles at least
                apart = np.maximum(odd, np.abs(sizes[own][:, None] - sizes[others][None, :]))
                near = may_be_alike(total, apart) & (roots[own][:, None] != roots[others][None, :])
                out[own] |= near.any(axis=1)
                out[others] |= near.any(axis=0)
    return out


def can_reach(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return (F.col(a) * WHOLE >= F.col(b) * PARTS) & (F.col(b) * WHOLE >= F.col(a) * PARTS)


def fingerprint_links(prints: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges (u, v) between similar sets whose fingerprints ``simhash.links`` finds. ``prints`` has (sid, fp) of distinct sets.

    A fingerprint's smallest set stands for it: the others are compared with that one, and
    it with those of linked fingerprints, so the pairs are linear in the sets and links.
    """
    least = written(prints.groupBy("fp").agg(F.min("sid").alias("least")), "fingerprints")
    a, b = least.select(F.col("fp").alias("u"), F.col("least").alias("x")), least.select(F.col("fp").alias("v"), F.col("least").alias("y"))
    between = simhash.links(least.select("fp")).join(a, "u").join(b, "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
    same = prints.join(least, "fp").filter("sid <> least").select(F.col("sid").alias("u"), F.col("least").alias("v"))
    return similar_pairs(between.unionByName(same).distinct(), sketches, sets_of)


def still_open(posts: DataFrame, edges: list[DataFrame]) -> DataFrame:
    """The rows of ``posts`` whose shingle has members of several components of the edge tables, with ``root``."""
    known = edges[0]
    for more in edges[1:]:
        known = known.unionByName(more)
    stars = components(known).select(F.col("u").alias("sid"), F.col("v").alias("root"))
    rooted = posts.join(stars, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    return written(rooted.join(mixed, "key", "left_semi"), "open-postings")


def links_to_representatives(
    posts: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], found: DataFrame, rounds: int = ROUNDS
) -> tuple[list[DataFrame], DataFrame]:
    """Edge tables with that of the edges ``found`` before, and the rows of ``posts`` whose shingle still has members of several components, with ``root``.

    In each round the members of a shingle are compared with one of them, the same one for
    most shingles of a group of near copies, so such a group takes a few pairs per member.
    Members that come into one component need no comparison any more.
    """
    edges, rooted = [found], posts.withColumn("root", F.col("sid"))
    for turn in range(rounds):
        several = rooted.filter(F.col("n") > REPRESENTED)
        first = F.min(F.struct(F.xxhash64("sid", F.lit(turn)).alias("h"), F.col("sid").alias("v"), F.col("size").alias("other"), F.col("root").alias("own"))).alias("first")
        of_key = several.groupBy("key").agg(first).select("key", "first.v", "first.other", "first.own")
        pairs = several.join(of_key, "key").filter((F.col("root") != F.col("own")) & can_reach("size", "other")).select(F.col("sid").alias("u"), "v").distinct()
        edges.append(written(similar_pairs(pairs, sketches, sets_of), "representative-edges"))
        rooted = still_open(posts, edges)
    return edges, rooted


def links(posts: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], found: DataFrame, joined_at_most: int = JOINED_AT_MOST) -> DataFrame:
    """Edges (u, v) between set ids that connect all similar sets, with those ``found`` before.

    ``posts`` has (key, sid, size, n, mass), ``sketches`` (sid, size, sketch); ``sets_of`` gives
    (sid, set) for a table of set ids.
    """
    edges, rooted = links_to_representatives(posts, sketches, sets_of, found)
    member = rooted.filter(F.col("n") <= joined_at_most)
    a, b = member.alias("a"), member.alias("b")
    apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.sid") < F.col("b.sid")) & (F.col("a.root") != F.col("b.root"))
    near = similar_pairs(a.join(b, apart & can_reach("a.size", "b.size")).select(F.col("a.sid").alias("u"), F.col("b.sid").alias("v")).distinct(), sketches, sets_of)
    for more in edges:
        near = near.unionByName(more)

    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("mass") / BLOCK_SHINGLES))
    many = rooted.filter(F.col("n") > joined_at_most).withColumn("blocks", blocks)
    dealt = many.withColumn("own", F.pmod(F.xxhash64("sid", "key"), F.col("blocks")))
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("lo"), F.greatest("own", o).alias("hi")))
    dealt = dealt.select("key", "sid", "root", F.explode(met).alias("m")).select("key", "sid", "root", "m.lo", "m.hi").join(sketches, "sid")

    def partnered(group: pa.Table) -> pa.Table:
        sizes, roots = group.column("size").to_numpy(), group.column("root").to_numpy()
        keep = with_partner(sizes, roots, group.column("sketch").combine_chunks())
        give_back()
        return group.select(["key", "lo", "hi", "sid"]).filter(pa.array(keep))

    close = written(dealt.groupBy("key", "lo", "hi").applyInArrow(partnered, "key bigint, lo bigint, hi bigint, sid bigint"), "close-members")

    def compare(group: pa.Table) -> pa.Table:
        ids = group.column("sid").to_numpy()
        whole = group.column("set").combine_chunks()
        ends, values = whole.offsets.to_numpy(), whole.values.to_numpy(zero_copy_only=False)
        edges = forest([values[a:b] for a, b in zip(ends[:-1], ends[1:])])
        give_back()
        return pa.table({"u": pa.array([ids[a] for a, _ in edges], pa.int64()), "v": pa.array([ids[b] for _, b in edges], pa.int64())})

    return near.unionByName(close.join(sets_of(close.select("sid")), "sid").groupBy("key", "lo", "hi").applyInArrow(compare, "u bigint, v bigint"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text", joined_at_most: int = JOINED_AT_MOST, bits: int = BITS) -> DataFrame:
    """The document with the smallest id (then text hash) of each group of linked ones, as ``simhash.keep_one`` gives it."""
    own = {"doc_id": F.col(doc_id).cast("long"), "_hash": _text_hash(text)}
    sets = shingle_sets(docs, shingle, own, text).withColumn("sid", F.xxhash64("set"))
    prints = written(prefixes(sets, common_shingles(docs, shingle, text)), "prefixes")
    distinct = written(prints.select("sid", "size", "fp", "prefix", "sketch").dropDuplicates(["sid"]), "distinct-sets")
    sketches = distinct.select("sid", "size", "sketch")

    def sets_of(sids: DataFrame) -> DataFrame:
        wanted = written(prints.join(sids.distinct(), "sid", "left_semi").groupBy("sid").agg(F.min("_hash").alias("_wanted")), "wanted")
        # texts that nothing is compared with stay out of the shuffle
        compared = maybe_in(wanted.select(F.col("_wanted").alias("key")), bits)
        row = docs.select(F.col(text).alias("text"), _text_hash(text).alias("_own")).filter(compared("_own"))
        few = row.join(wanted, F.col("_own") == F.col("_wanted"), "left_semi").dropDuplicates(["_own"])
        # one text of each set, so no set is there twice
        return written(shingle_sets(few, shingle, {}, "text").select(F.xxhash64("set").alias("sid"), "set"), "shingle-sets")

    found = written(fingerprint_links(distinct.select("sid", "fp"), sketches, sets_of), "fingerprint-edges")
    stars = components(links(postings(distinct, bits), sketches, sets_of, found, joined_at_most)).select(F.col("u").alias("sid"), F.col("v").alias("_root"))
    rooted = prints.select("doc_id", "_hash", "sid").join(stars, "sid", "left").select("doc_id", "_hash", F.coalesce("_root", "sid").alias("root"))
    return first_of_each(docs, rooted, doc_id, text)
