"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has bit j if over half of the hashes of the text's word shingles have it.
To find all pairs within ``distance`` bits, the 64 bits are grouped into partitions,
correlated bits together. If each partition gets a threshold and the thresholds plus one
add up to distance + 1, any such pair is within the threshold of one partition at least
(a threshold of -1 leaves a partition out). Dynamic programming spends those units where
the estimated number of candidates is least: the pairs that agree on a partition are
counted over all fingerprints, and those a few bits apart follow from how often each bit
agrees. Fingerprints are then probed by their partition values and verified.

Fingerprints are made distinct first, so copies cost nothing. A partition value shared by
many fingerprints is not joined with itself: its members, if they are linked, have a
common neighbour at half the distance, so each emits its neighbours (65 for a distance of
2) and those that meet are linked to the smallest one in a star. This loses no link and is
linear in the members. Links go into components; pairs never reach the driver.

Defined cases: a NULL text counts as empty; texts without words have fingerprint zero and
are linked like any other; fewer words than a shingle make one shingle of all; NULL ids
take their component's smallest id; repeated rows each get a row; an empty table gives
none; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import table, words_of
from hedonic.llm.graph import components
from hedonic.session import written

BITS = 64
DISTANCE = 2
SHINGLE = 3
PARTITIONS = 3
# A partition value with more fingerprints than this is linked through common neighbours.
# Joining k of them makes up to k * (k - 1) / 2 rows, their neighbours 65 * k.
JOINED_AT_MOST = 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Shingle hashes turned to bits at a time in a task.
STEP = 1 << 17


def shingle_hashes(text: Column, words: str, shingle: int) -> Column:
    """XXH64 (seed 42) of the word shingles in column ``words``."""
    n = F.size(words)
    several = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(F.col(words), i + 1, shingle))))
    one = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(n >= shingle, several).when(n > 0, one).otherwise(F.array().cast("array<bigint>"))


def majority(hashes: pa.ListArray) -> np.ndarray:
    """One fingerprint per list of hashes."""
    ends = hashes.offsets.to_numpy().astype(np.int64)
    values = hashes.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    counts = np.zeros((len(ends) - 1, BITS), dtype=np.int64)
    full = np.flatnonzero(np.diff(ends))
    starts = ends[full]
    for lo in range(0, len(values), STEP):
        hi = min(lo + STEP, len(values))
        bits = np.unpackbits(np.ascontiguousarray(values[lo:hi]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = int(np.searchsorted(starts, lo, side="right")) - 1
        last = int(np.searchsorted(starts, hi, side="left"))
        at = np.maximum(starts[first:last] - lo, 0)
        counts[full[first:last]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    set_bits = 2 * counts > np.diff(ends)[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.int64).reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text", more: dict[str, Column] | None = None) -> DataFrame:
    """Per document: doc_id, fp (64 bits as a long), and the further small columns of ``more``."""
    more = more or {}
    kept = [F.col(doc_id).cast("long").alias("doc_id"), *[c.alias(n) for n, c in more.items()]]
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    words = docs.select(*kept, words_of(lowered).alias("_words"))
    hashed = words.select("doc_id", *more, shingle_hashes(F.col("_words"), "_words", shingle).alias("_hashes"))
    names = ["doc_id", *more]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hashed.schema if f.name != "_hashes") + ", fp bigint"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = majority(batch.column("_hashes"))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(fps)], names=[*names, "fp"])

    return hashed.mapInArrow(fold, schema)


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for each two bits how many have both (summed over all of them)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for lo in range(0, len(values), STEP):
                part = np.ascontiguousarray(values[lo : lo + STEP])
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(part)
        sums = np.r_[both.astype(np.int64).reshape(-1), n]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["k", "n"])

    sums = np.zeros(BITS * BITS + 1, dtype=np.int64)
    for row in fps.select("fp").mapInArrow(count, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        sums[row["k"]] = row["n"]  # 4,097 rows, whatever the input
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, partitions: int) -> list[list[int]]:
    """Bits in partitions of nearly equal width; each takes the bit most correlated with those it has."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for k in range(partitions):
        width = len(free) // (partitions - k)
        some = sorted(free)
        group = [max(some, key=lambda b: (related[b, some].sum(), -b))]
        while len(group) < width:
            rest = sorted(free - set(group))
            group.append(max(rest, key=lambda b: (related[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    """The bits as a signed 64-bit number."""
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def estimated_candidates(n: int, both: np.ndarray, group: list[int], agreeing: float, distance: int) -> list[float]:
    """Estimated pairs within 0, 1, ..., ``distance`` bits on one partition, plus the probes made for them."""
    share = np.diag(both)[group] / max(n, 1)
    agree = np.clip(share**2 + (1 - share) ** 2, 0.5, 1 - 1e-9)
    odds = (1 - agree) / agree
    # elementary symmetric sums of the odds: pairs that differ in exactly k bits, per agreeing pair
    exactly = np.zeros(distance + 1)
    exactly[0] = 1
    for o in odds:
        exactly[1:] += exactly[:-1] * o
    probes, costs = 1.0, []
    for k in range(distance + 1):
        costs.append(max(agreeing, 1e-9) * exactly[: k + 1].sum() + n * probes)
        probes += probes * max(len(group) - k, 0) / (k + 1)
    return costs


def allocate(costs: list[list[float]], distance: int) -> list[int]:
    """Thresholds, -1 for partitions left out, of least total cost whose sum plus one each is distance + 1."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for cost in costs:
        nxt: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (total, chosen) in best.items():
            for units in range(distance + 2 - used):
                spent = total + (cost[units - 1] if units else 0.0)
                if used + units not in nxt or spent < nxt[used + units][0]:
                    nxt[used + units] = (spent, (*chosen, units - 1))
        best = nxt
    return list(best[distance + 1][1])


def _flips(fp: Column, bits: list[int], most: int) -> Column:
    """The value and all values with up to ``most`` of the given bits flipped."""
    masks = [mask_of(list(c)) for k in range(most + 1) for c in combinations(bits, k)]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS, joined_at_most: int = JOINED_AT_MOST) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` that connect all pairs within ``distance`` bits.

    Pairs within ``distance`` come out themselves or through a chain of them.
    """
    n, both = bit_counts(fps)
    groups = group_bits(n, both, partitions)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(mask_of(g)).alias("key")) for i, g in enumerate(groups)]))
    sizes = fps.select(keys.alias("k")).groupBy("k.part", "k.key").count()
    agreeing = {r["part"]: r["pairs"] for r in sizes.groupBy("part").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    costs = [estimated_candidates(n, both, g, agreeing.get(i, 0.0), distance) for i, g in enumerate(groups)]
    thresholds = allocate(costs, distance)

    def probed(i: int) -> Column:
        group, t = groups[i], thresholds[i]
        own = F.col("fp").bitwiseAND(mask_of(group))
        return F.transform(_flips(own, group, t), lambda key: F.struct(F.lit(i).alias("part"), key.alias("key"), (key == own).alias("home")))

    used = [i for i, t in enumerate(thresholds) if t >= 0]
    probes = fps.select("fp", F.explode(F.concat(*[probed(i) for i in used])).alias("p")).select("fp", "p.part", "p.key", "p.home")
    probes = written(probes, "probes")
    crowd = probes.groupBy("part", "key").agg(F.count("*").alias("n"), F.max("home").alias("met")).filter("n > 1 AND met")
    crowd = written(crowd, "buckets")
    few, many = crowd.filter(F.col("n") <= joined_at_most), crowd.filter(F.col("n") > joined_at_most)
    bucketed = probes.join(few.select("part", "key"), ["part", "key"])
    a, b = bucketed.filter("home").alias("a"), bucketed.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    # both at home meet twice, as (x, y) and (y, x): the smaller comes first
    once = ~F.col("b.home") | (F.col("a.fp") < F.col("b.fp"))
    pairs = a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key")) & once & near)
    pairs = pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).filter("u <> v")
    crowded = probes.join(many.select("part", "key"), ["part", "key"], "left_semi").select("fp").distinct()
    return pairs.unionByName(_met(crowded, distance))


def _met(fps: DataFrame, distance: int) -> DataFrame:
    """Edges between fingerprints that share a neighbour: each with the smallest one there.

    For an even distance two fingerprints are linked exactly if both are within half of it
    of some value; for an odd one, the value that both reach lies one bit further from one
    of them, so its own neighbours are checked.
    """
    half = distance // 2
    met = fps.select("fp", F.explode(_flips(F.col("fp"), list(range(BITS)), half)).alias("z"))
    if distance % 2 == 0:
        least = met.groupBy("z").agg(F.min("fp").alias("v"), F.max("fp").alias("most")).filter("v < most").select("z", "v")
        edges = met.join(least, "z").select(F.col("fp").alias("u"), "v")
    else:
        far = fps.select(F.col("fp").alias("u"), F.explode(_flips(F.col("fp"), list(range(BITS)), half + 1)).alias("z"))
        least = met.groupBy("z").agg(F.min("fp").alias("v"))
        # one from the nearer side stands for all of them: they are linked to each other
        edges = far.join(least, "z").select("u", "v").unionByName(met.join(least, "z").select(F.col("fp").alias("u"), "v"))
    return edges.filter("u <> v").distinct()


def classes(prints: DataFrame, **options) -> DataFrame:
    """Per distinct fingerprint ``fp``: its component's smallest fingerprint (``root``) and smallest doc_id (``component_id``)."""
    least = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    stars = components(links(least.select("fp"), **options)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = least.join(stars, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, F.col("root") == F.col("r")).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, **options) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    prints = written(fingerprints(docs, shingle), "prints")
    found = classes(prints, distance=distance, **options)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(found, "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The document with the smallest id (then text hash) of each component, with exactly its own columns.

    Repeated rows of one id and text are one document. Documents with a NULL id stay only
    if their component has no other id.
    """
    prints = written(fingerprints(docs, shingle, doc_id, text, {"_hash": F.xxhash64(F.coalesce(F.col(text), F.lit("")))}), "prints")
    return first_of_each(docs, prints.join(classes(prints, distance=distance, **options), "fp").select("doc_id", "_hash", "root"), doc_id, text)


def first_of_each(docs: DataFrame, rooted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The first document of each ``root``; ``rooted`` has doc_id, _hash (of the text) and root of every row."""
    rank = F.struct(F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).alias("i"), F.col("_hash").alias("h"))
    first = rooted.groupBy("root").agg(F.min(rank).alias("r")).select(F.when(F.col("r.i") < (1 << 63) - 1, F.col("r.i")).alias("_id"), F.col("r.h").alias("_h")).distinct()
    row = docs.select(F.struct("*").alias("_row"), F.col(doc_id).cast("long").alias("_own"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    kept = row.join(first, row["_own"].eqNullSafe(first["_id"]) & (row["_text"] == first["_h"]), "left_semi")
    repeated = rooted.groupBy("doc_id", "_hash").count().filter("count > 1").limit(1).count() > 0
    return (kept.dropDuplicates(["_own", "_text"]) if repeated else kept).select("_row.*")
