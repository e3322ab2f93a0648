"""A Merkle manifest of a table, with a proof for every row, by butterfly exchange.

A row's leaf is the hash of its fields. Leaves are ordered within their group and cut into
aligned blocks, the parts of the butterfly; a block's subtree is hashed in one task. Then
blocks swap subtree roots round by round: in round r a block asks the blocks whose number
differs from its own in digit r (to the base of the fanout), one for each sibling subtree,
and hashes the common parent itself. Blocks of one subtree all hash its ancestors, so each
has its siblings on the way up at once, and none has to be handed down afterwards. When
all blocks of a group have its root, the rounds go on over the digits of the group's
number, up to the root of all. A node that has fewer blocks than its siblings answers
with each of them several times.

Rounds are as many as levels above the blocks; each shuffles at most a fanout of digests
per block, and blocks are the leaves divided by ``FANOUT ** LOCAL``. A path has the digests
to the left and right of the node on each level.

Defined cases: NULL fields have a form of their own, NULL groups and keys come first; rows
with equal keys are ordered by leaf; equal rows are leaves each; a group of one leaf is
that leaf; an empty table gives no rows; further columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import ascii_lower, table
from hedonic.operators.ranking import rank_first
from hedonic.session import Lookup, join_lookup, written

FANOUT = 8
# Levels hashed inside a block, of FANOUT ** LOCAL leaves.
LOCAL = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def leaf_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 (lower-case hex) of the fields, each as its length in UTF-8 bytes, a colon and its value, or - for NULL."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _parents(nodes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(nodes[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(nodes), FANOUT)]


def _subtree(leaves: list[str], alone: bool, local: int) -> list[list[str]]:
    """The levels of a block: up to its root if it is the group's only one, else all of its ``local`` levels."""
    levels = [leaves]
    while len(levels[-1]) > 1 if alone else len(levels) <= local:
        levels.append(_parents(levels[-1]))
    return levels


def _beside(nodes: list[str]) -> list[tuple[str, str]]:
    """For each node of a level the siblings to its left and right, put together."""
    out = []
    for i in range(len(nodes)):
        first = i - i % FANOUT
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + FANOUT])))
    return out


def _blocks(batch: pa.RecordBatch, local: int) -> Iterator[tuple[int, pa.Array, list[list[str]]]]:
    """Row number, members and subtree of each block of a batch."""
    members, counts = batch.column("members"), batch.column("blocks").to_pylist()
    for i, blocks in enumerate(counts):
        own = members.slice(i, 1).flatten()
        yield i, own, _subtree(own.field("leaf").to_pylist(), blocks == 1, local)


def blocks_of(leaves: DataFrame, key: str, group: str, carried: Sequence[str], local: int) -> tuple[DataFrame, Lookup]:
    """Written blocks (g, block, blocks, members) of leaves in order, and the groups (g, blocks) by number."""
    order = [F.asc_nulls_first(group), F.asc_nulls_first(key), F.asc("leaf"), F.asc("_row")]
    placed = rank_first(leaves, order, "_number")
    sizes = placed.groupBy(group).agg(F.min("_number").alias("_first"), F.count("*").alias("_n"))
    span = FANOUT**local
    groups = rank_first(sizes, [F.asc_nulls_first(group)], "_g").select(
        group, "_first", (F.col("_g") - 1).alias("g"), F.ceil(F.col("_n") / span).cast("long").alias("blocks")
    )
    groups = Lookup(groups)
    at = F.col("_number") - F.col("_first")
    numbered = join_lookup(placed, groups, [group]).select("g", "blocks", F.floor(at / span).alias("block"), F.struct(at.alias("at"), key, "leaf", *carried).alias("m"))
    # a block has at most FANOUT ** local members
    members = numbered.groupBy("g", "block", "blocks").agg(F.sort_array(F.collect_list("m")).alias("members"))
    return written(members, "blocks"), Lookup(groups.table.select("g", F.col("blocks").alias("their_blocks")), groups.rows)


def _exchange(state: DataFrame, step: int, unit: str, total: Column, groups: Lookup | None) -> DataFrame:
    """One round: units whose number differs in the digit of ``step`` swap their nodes, and all hash the parent."""
    digit, low = F.floor(F.col(unit) / step) % FANOUT, F.col(unit) % step
    below = F.floor(F.col(unit) / (step * FANOUT)) * FANOUT
    starts = F.transform(F.sequence(F.lit(0), F.lit(FANOUT - 1)), lambda j: F.struct(j.alias("digit"), ((below + j) * step).alias("start")))
    rounds = state.filter(total > step)
    asked = rounds.select("*", total.alias("_total"), digit.cast("int").alias("_digit"), low.alias("_low"), F.explode(F.filter(starts, lambda s: s["start"] < total)).alias("_s"))
    source = F.col("_s.start") + F.col("_low") % F.least(F.lit(step), F.col("_total") - F.col("_s.start"))
    asked = asked.withColumn("path", F.when(F.col("_s.digit") == F.col("_digit"), F.col("path"))).withColumn("_source", source)
    if groups is None:
        asked = asked.withColumns({"_from_g": F.col("g"), "_from": F.col("_source")})
    else:
        # the same subtree is known to all blocks of a group: ask one with the same number, or the remainder
        side = groups.side.withColumnRenamed("g", "_from_g")
        asked = asked.withColumn("_from_g", F.col("_source")).join(side, "_from_g").withColumn("_from", F.col("block") % F.col("their_blocks")).drop("their_blocks")
    nodes = Lookup(state.select(F.col("g").alias("_their_g"), F.col("block").alias("_their"), F.col("node").alias("_node")), rows=state.count())
    met = asked.join(nodes.side, (F.col("_from_g") == F.col("_their_g")) & (F.col("_from") == F.col("_their")))
    same = [c for c in state.columns if c not in ("node", "path")]
    ring = met.groupBy(*same, "_digit").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_s.digit").alias("d"), "_node"))).alias("ring"),  # at most FANOUT
        F.first("path", ignorenulls=True).alias("path"),
    )
    digests = F.col("ring._node")
    beside = F.struct(
        F.array_join(F.slice(digests, F.lit(1), F.col("_digit")), "").alias("left"),
        F.array_join(F.slice(digests, F.col("_digit") + 2, F.lit(FANOUT)), "").alias("right"),
    )
    done = ring.select(*same, F.sha2(F.array_join(digests, ""), 256).alias("node"), F.concat("path", F.array(beside)).alias("path"))
    return written(done.unionByName(state.filter(~(total > step))), "exchange")


def _butterfly(blocks: DataFrame, groups: Lookup, local: int) -> DataFrame:
    """g, block, subroot, root and the path of each block from its own root to that of all."""

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [levels[-1][0] for _, _, levels in _blocks(batch, local)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("g", "block", "blocks")], pa.array(nodes, pa.string())], names=["g", "block", "blocks", "node"])

    state = blocks.mapInArrow(root, "g bigint, block bigint, blocks bigint, node string").withColumn("path", F.array().cast(PATH))
    state = written(state, "exchange")
    most, step = state.agg(F.max("blocks")).first()[0] or 0, 1
    while step < most:
        state = _exchange(state, step, "block", F.col("blocks"), None)
        step *= FANOUT
    state, step = state.withColumn("subroot", F.col("node")), 1
    while step < groups.rows:
        state = _exchange(state, step, "g", F.lit(groups.rows), groups)
        step *= FANOUT
    return state.select("g", "block", "subroot", F.col("node").alias("root"), F.col("path").alias("upper"))


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, carried: Mapping[str, Column] | None = None, local: int = LOCAL
) -> DataFrame:
    """Per row its key, leaf, the roots of its group and of all, its path, and the ``carried`` small columns."""
    carried = carried or {}
    own = [F.col(key).alias("_key"), F.col(group).alias("_group"), leaf_hash([F.col(f) for f in fields]).alias("leaf")]
    leaves = docs.select(*own, *[c.alias(n) for n, c in carried.items()], F.monotonically_increasing_id().alias("_row"))
    blocks, groups = blocks_of(written(leaves, "leaves"), "_key", "_group", list(carried), local)
    upper = _butterfly(blocks, groups, local).withColumnsRenamed({"g": "_g", "block": "_b"})
    whole = blocks.join(upper, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")
    names = ["_key", "leaf", *carried]
    types = {f.name: f.dataType for f in blocks.schema["members"].dataType.elementType}
    schema = ", ".join(f"`{n}` {types[n].simpleString()}" for n in names) + f", subroot string, root string, path {PATH}"

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            subroots, roots, uppers = (batch.column(c).to_pylist() for c in ("subroot", "root", "upper"))
            for i, own, levels in _blocks(batch, local):
                beside = [_beside(nodes) for nodes in levels[:-1]]
                above = [(s["left"], s["right"]) for s in uppers[i]]
                lefts, rights, n = [], [], len(own)
                for k in range(n):
                    steps = [pairs[k // FANOUT**h] for h, pairs in enumerate(beside)] + above
                    lefts += [a for a, _ in steps]
                    rights += [b for _, b in steps]
                height = len(beside) + len(above)
                sides = pa.StructArray.from_arrays([pa.array(lefts, pa.string()), pa.array(rights, pa.string())], names=["left", "right"])
                path = pa.ListArray.from_arrays(pa.array(range(0, height * n + 1, height) if height else [0] * (n + 1), pa.int32()), sides)
                columns = [*[own.field(c) for c in names], pa.array([subroots[i]] * n, pa.string()), pa.array([roots[i]] * n, pa.string()), path]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "subroot", "root", "path"])

    return whole.mapInArrow(prove, schema).withColumnRenamed("_key", key)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    seen = [F.when(tampered, ascii_lower(F.col(f))).otherwise(F.col(f)) if f == "text" else F.col(f) for f in FIELDS]
    proofs = manifest(docs, carried={"_seen": leaf_hash(seen)})
    folded = proofs.withColumn("folded_root", fold(F.col("_seen"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )

