"""Forests on blocks of codes, for training rows that the ML library's trainer can't keep.

That trainer keeps a number for each vector position of each row, on disk where memory ends.
Here a row is a code per column, as in ``boosting.py``, and a tree's draw of a row is made
again from the seed whenever it is needed. All trees grow together: a job sums residuals and
counts by node and code over all blocks, for as many nodes at a time as ``SUMS`` allows, and
a split lowers the variance the most. Nothing but the blocks is kept, whatever the number of
rows, trees and levels. The trees become an ordinary ``RandomForestRegressionModel``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.models.boosting import BINS, NODES_AT_A_TIME, Block, BoostParams, Layout, Tree, _ancestors, _bests_of, _Local, _read, _value, stored_model

SUMS = 1 << 20  # of a job: nodes times cells


@dataclass(frozen=True)
class ForestParams:
    trees: int
    depth: int
    least_rows: int
    least_gain: float
    share: float
    bootstrap: bool
    columns: str
    seed: int

    @classmethod
    def of(cls, estimator: RandomForestRegressor) -> ForestParams:
        e = estimator
        return cls(
            e.getNumTrees(), e.getMaxDepth(), e.getMinInstancesPerNode(), e.getMinInfoGain(), e.getSubsamplingRate(), e.getBootstrap(), e.getFeatureSubsetStrategy(), e.getSeed()
        )

    def positions(self, width: int) -> int:
        """How many vector positions a node may split on, by the names of the ML library."""
        name = self.columns.lower()
        if name == "auto":
            name = "all" if self.trees == 1 else "onethird"
        named = {"all": width, "onethird": math.ceil(width / 3), "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width)))}
        if name in named:
            return named[name]
        return min(int(name), width) if name.isdigit() else math.ceil(float(name) * width)


# Variance falls by the second-order gain without penalties, divided by the rows.
_PLAIN = BoostParams(rate=1.0, l2=0.0, min_child_weight=1.0)


def _drawn(block: Block, params: ForestParams, tree: int) -> np.ndarray:
    """The rows of a tree: one that is drawn twice is there twice."""
    rng, n = np.random.default_rng([params.seed & (2**63 - 1), tree, block.number]), len(block.label)
    if params.bootstrap:
        return np.repeat(np.arange(n), rng.poisson(params.share, n))
    return np.arange(n) if params.share >= 1 else np.flatnonzero(rng.random(n) < params.share)


def _sums(blocks: DataFrame, layout: Layout, params: ForestParams, base: float, trees: dict[int, Tree], nodes: Sequence[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Residuals and counts by node and cell, in one job; ``nodes`` are pairs of tree and node."""
    shape, by_tree = (2, len(nodes), layout.cells), {}
    for k, (t, n) in enumerate(nodes):
        by_tree.setdefault(t, []).append((k, n))
    ways = {t: _ancestors(trees[t], [n for _, n in some]) for t, some in by_tree.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for block, _, _ in _read(batches, layout):
            own = _Local([block], layout)
            own.begin(base, _PLAIN, 0)
            for t, some in by_tree.items():
                own.rows = {0: _drawn(block, params, t)}
                own.drawn = {0: len(own.rows[0])}
                g, h = own.sums(trees[t], ways[t], [n for _, n in some])
                places = [k for k, _ in some]
                out[0, places] += g
                out[1, places] += h
        place = np.flatnonzero(out[1])
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(out[0].ravel()[place]), pa.array(out[1].ravel()[place])], names=["place", "g", "h"])

    found = blocks.mapInArrow(add, "place bigint, g double, h double").groupBy("place").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((2, shape[1] * shape[2]))
    for k, name in enumerate(("g", "h")):
        out[k, found.column("place").to_numpy()] = found.column(name).to_numpy()
    return out[0].reshape(shape[1:]), out[1].reshape(shape[1:])


def grow(blocks: DataFrame, layout: Layout, params: ForestParams) -> list[Tree]:
    """The trees, grown level by level."""
    row = blocks.agg(F.sum("total"), F.sum("rows")).first()
    if not row[1]:
        raise ValueError("a forest needs training rows")
    base = row[0] / row[1]
    if math.isnan(base):
        raise ValueError("labels must not be NULL or NaN")
    trees = {t: Tree() for t in range(params.trees)}
    for tree in trees.values():
        tree.add(0.0, 0.0)
    asked = params.positions(layout.width)
    level, at_a_time = [(t, 0) for t in trees], max(1, SUMS // layout.cells)
    for depth in range(params.depth + 1):
        deeper: list[tuple[int, int]] = []
        for lo in range(0, len(level), at_a_time):
            some = level[lo : lo + at_a_time]
            own = {t: trees[t] for t, _ in some}
            # the roots of trees without a split have their mean from here too
            deeper += _split(some, trees, *_sums(blocks, layout, params, base, own, some), base, layout, params, asked, depth)
        level = deeper
        if not level:
            break
    return [tree.packed() for tree in trees.values()]


def _split(
    nodes: Sequence[tuple[int, int]], trees: dict[int, Tree], g: np.ndarray, h: np.ndarray, base: float, layout: Layout, params: ForestParams, asked: int, depth: int
) -> list[tuple[int, int]]:
    """Give each node its best split, and return the children that may be split in turn."""
    limits = BoostParams(rate=1.0, l2=0.0, min_child_weight=float(params.least_rows))
    out = []
    for lo in range(0, len(nodes), NODES_AT_A_TIME):
        some = nodes[lo : lo + NODES_AT_A_TIME]
        open_cells = layout.open
        if asked < layout.width:
            allowed = np.zeros((len(some), layout.width), dtype=bool)
            for k, (t, n) in enumerate(some):
                allowed[k, np.random.default_rng([params.seed & (2**63 - 1), t, n]).permutation(layout.width)[:asked]] = True
            open_cells = layout.open & allowed[:, layout.position]
        found = _bests_of(g[lo : lo + len(some)], h[lo : lo + len(some)], layout, open_cells, limits)
        for (t, n), (cell, gain, left_g, left_h, total_g, total_h) in zip(some, found):
            tree = trees[t]
            if n == 0:
                tree.value[0], tree.count[0] = base + (_value(total_g, total_h, _PLAIN) if total_h else 0.0), total_h
            lowered = gain / total_h if total_h else -np.inf
            if depth >= params.depth or not (lowered > 1e-12 and lowered >= params.least_gain):
                continue
            column = int(layout.column[cell])
            tree.column[n], tree.code[n], tree.cell[n], tree.gain[n] = column, int(cell - layout.offsets[column]), cell, lowered
            tree.left[n] = tree.add(base + _value(left_g, left_h, _PLAIN), left_h)
            tree.right[n] = tree.add(base + _value(total_g - left_g, total_h - left_h, _PLAIN), total_h - left_h)
            if depth + 1 < params.depth:
                out += [(t, child) for child in (tree.left[n], tree.right[n]) if tree.count[child] >= 2 * params.least_rows]
    return out


def mean_ratio(blocks: DataFrame, layout: Layout, trees: Sequence[Tree]) -> float:
    """The mean of exp(label - prediction) over the training rows, in one pass over the blocks."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _ in _read(batches, layout):
            own = _Local([block], layout)
            own.margin = np.zeros(len(block.label))
            for tree in trees:
                own.rows, own.drawn = {0: np.arange(len(block.label))}, {0: 0}
                own.finish(tree, [n for n in range(len(tree.column)) if tree.column[n] >= 0])
            with np.errstate(over="ignore"):
                total = float(np.exp(block.label - own.margin / len(trees)).sum())
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([len(block.label)])], names=["total", "rows"])

    row = blocks.mapInArrow(compared, "total double, rows bigint").agg(F.sum("total"), F.sum("rows")).first()
    return row[0] / row[1]


def as_forest(spark: SparkSession, trees: Sequence[Tree], layout: Layout, estimator: RandomForestRegressor) -> RandomForestRegressionModel:
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}
    given = {p.name: v for p, v in estimator._paramMap.items()} | {"maxBins": BINS}
    return stored_model(spark, RandomForestRegressionModel, "RandomForestRegressor_hist", 0.0, trees, layout, given, defaults)


def fit(spark: SparkSession, estimator: RandomForestRegressor, layout: Layout, blocks: DataFrame, compared: bool) -> tuple[RandomForestRegressionModel, float | None]:
    """The model that the estimator stands for, and with ``compared`` the mean of exp(label - prediction)."""
    trees = grow(blocks, layout, ForestParams.of(estimator))
    return as_forest(spark, trees, layout, estimator), mean_ratio(blocks, layout, trees) if compared else None
