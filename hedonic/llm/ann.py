"""Approximate nearest neighbours by cosine over sharded, robust-pruned graphs.

Equal vectors are one class in the index, with the smallest ids that any result could
need, so a vector repeated many times is one node. Classes are dealt to shards by a hash;
each shard's graph is built in one task and written once as a row. Every query is searched
in every shard, a bounded block of queries with one shard's graph per task, and the best
of all shards remain. Scores are computed in double precision on the original vectors.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite numbers take
no part, nor do those whose length isn't the most common one (the longer of equally common
ones); NULL ids take no part; repeated rows with one id and vector count once; a query
with fewer candidates gets them all; equal scores go to the smaller id; an empty table
gives no rows; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic.llm.common import table
from hedonic.llm.vamana import BATCH, Graph
from hedonic.session import written

# Classes per shard (expected), queries per block, and the width of a search.
SHARD_ROWS = 8192
QUERY_BLOCK = 32_768
SEARCH_WIDTH = 64
NEAREST = 5
QUERY_EVERY = 50


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (vec_id, v) with finite, non-zero vectors of the common length, in double precision; zeros unsigned."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != F.lit(0.0)))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0)).distinct()


def vector_classes(rows: DataFrame, members: int) -> DataFrame:
    """Per distinct vector: class_id (its smallest id), v, and (vec_id) its ``members`` smallest ids, one row each.

    The rank is limited in every task before the shuffle, so a class with most rows stays small.
    """
    order = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= members)
    return few.withColumn("class_id", F.min("vec_id").over(Window.partitionBy("v"))).drop("_r")


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.float64) if len(rows) else np.zeros((0, 0))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, exactly, with largest components near 1: squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) if len(x) else x


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that neither very small nor very large numbers leave the range
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def build_index(classes: DataFrame, shards: int) -> DataFrame:
    """Per shard one row: its class ids, vectors and graph, as bytes. ``classes`` has class_id and v."""
    placed = classes.withColumn("shard", F.pmod(F.xxhash64("class_id"), F.lit(shards)).cast("int"))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class_id")
        vectors = _matrix(rows["v"])
        graph = Graph.build(_unit(vectors))
        return pd.DataFrame({"shard": [key[0]], "class_ids": [rows["class_id"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()], "edges": [graph.to_bytes()], "entries": [graph.entries.tobytes()]})

    # rows are small, but a graph takes long: partitions of a given number aren't put together
    dealt = placed.repartition(2 * shards, "shard")
    return dealt.groupBy("shard").applyInPandas(build, "shard int, class_ids binary, vectors binary, edges binary, entries binary")


def search(index: DataFrame, queries: DataFrame, shards: int, blocks: int, nearest: int, width: int) -> DataFrame:
    """(query_id, class_id, score) of the ``nearest`` classes found in each shard, by its graph."""
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = queries.select("query_id", "q", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), everywhere.alias("shard"))
    served = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(graphs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": np.zeros(0, np.int64), "class_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(graphs) or not len(asked):
            return out
        row = graphs.iloc[0]
        ids = np.frombuffer(row["class_ids"], dtype=np.int64)
        vectors = _scaled(np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(ids), -1))
        graph = Graph(_unit(vectors), np.frombuffer(row["edges"], dtype=np.int32).reshape(len(ids), -1), np.frombuffer(row["entries"], dtype=np.int64))
        sizes, found = np.sqrt((vectors * vectors).sum(axis=1)), [out]
        for lo in range(0, len(asked), BATCH):
            some = asked.iloc[lo : lo + BATCH]
            q = _scaled(_matrix(some["q"]))
            # all nodes of the final list, so that equal similarities in single precision are ordered in double
            near = graph.search(_unit(q), max(width, nearest))[0]
            r, c = np.nonzero(near >= 0)
            node = near[r, c]
            exact = (q[r] * vectors[node]).sum(axis=1) / (np.sqrt((q * q).sum(axis=1))[r] * sizes[node])
            order = np.lexsort((ids[node], -exact, r))
            r, node, exact = r[order], node[order], exact[order]
            place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
            best = place < nearest
            found.append(pd.DataFrame({"query_id": some["query_id"].to_numpy(np.int64)[r[best]], "class_id": ids[node[best]], "score": exact[best]}))
        return pd.concat(found, ignore_index=True)

    both = served.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
    return both.applyInPandas(find, "query_id bigint, class_id bigint, score double")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    nearest: int = NEAREST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    width: int = SEARCH_WIDTH,
) -> DataFrame:
    """Per query (rows of ``vectors`` whose ``vec_id`` fulfils ``is_query``) its ``nearest`` others: query_id, rank, vec_id, score."""
    # a query may be a member of its own class: one more member, one more class
    rows = written(usable(vectors, id_col, vector_col), "vectors")
    members = written(vector_classes(rows, nearest + 1), "classes")
    classes = members.filter("vec_id = class_id").select("class_id", "v")
    shards = max(1, round(classes.count() / shard_rows))
    index = written(build_index(classes, shards), "graphs")
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    found = search(index, queries, shards, blocks, nearest + 1, width)
    pairs = found.join(members.select("class_id", "vec_id"), "class_id").filter("vec_id <> query_id").select("query_id", "vec_id", "score")
    # an id that stands for several vectors counts with its nearest one
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


# Exact, for checks at scales where all pairs are affordable: the approximate result is held against it by recall.
EXACT_SQL = """
SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
FROM embeddings a JOIN embeddings b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY score DESC, b.vec_id) <= 5
"""
