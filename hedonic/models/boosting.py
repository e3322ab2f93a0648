"""Second-order boosting of regression trees on histograms.

Rows are binned once: a number is coded by the cut points below it (at most ``BINS`` - 1
sketched quantiles), a category by its slot. Blocks of codes and labels are written to the
shared folder and are all that training reads. A tree grows level by level: gradients and
counts are summed by node and code for the smaller child of each split, the sibling is the
parent less that, and a split's gain follows the usual second-order formula with L2, L1, a
least gain and a least child weight (the Hessian of squared error is one per row). Gradients
are summed with 24 bits, the sign among them, as in single precision: one sum then holds
the gradients of a cell and its count. Columns of few codes are summed together in large nodes.

Rows up to ``TASK_ROWS`` are one task's work: the loop over trees then runs in that task and
a fit is one job. More rows are spread over tasks, and each level is a job that sums over
all blocks; margins are carried along with the blocks, kept after each tree and written
every ``CHECKPOINT_TREES`` trees. Both give the same trees, up to the order of sums. The loop
holds the sums of one level: nodes times codes, whatever the number of rows.

The trees become an ordinary ``GBTRegressionModel``, so predicting, saving and importances
stay in the JVM. Prefixes of one fit stand for smaller numbers of trees.
"""

from __future__ import annotations

import json
import time
from array import array
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Any, ClassVar

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.session import remove, scratch_path, written

BINS = 256
SKETCH_ACCURACY = 10_000
BLOCK_ROWS = 1 << 16
TASK_ROWS = 1 << 22
STEP_ROWS = 1 << 14  # rows summed at a time: their cells fit the cache, and their sums are exact
GRADIENT_BITS = 23
ONE_ROW = 2.0**39  # what a row adds to a sum besides its gradient, so that the sum tells both: 2^14 rows stay below 2^53
JOINT_CELLS = 1 << 12  # columns are summed together up to so many combinations of their codes
NODES_AT_A_TIME = 64
CHECKPOINT_TREES = 10
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class BoostParams:
    """Parameters under their usual names; ``columns`` is the share of vector positions that a tree may split on."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    l2: float = 1.0
    l1: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    columns: float = 1.0
    seed: int = 0

    NAMES: ClassVar[dict[str, str]] = {
        "n_estimators": "rounds",
        "max_depth": "depth",
        "learning_rate": "rate",
        "reg_lambda": "l2",
        "reg_alpha": "l1",
        "gamma": "gamma",
        "min_child_weight": "min_child_weight",
        "subsample": "subsample",
        "colsample_bytree": "columns",
        "random_state": "seed",
    }

    @classmethod
    def of(cls, params: Mapping[str, Any]) -> BoostParams:
        known = {cls.NAMES[k]: v for k, v in params.items() if k in cls.NAMES and v is not None}
        return cls(**{k: int(v) if k in ("rounds", "depth", "seed") else float(v) for k, v in known.items()})


@dataclass
class Layout:
    """How vectors are coded: cut points of the numeric positions, then the widths of one-hot columns."""

    cuts: list[np.ndarray]
    widths: list[int]

    def __post_init__(self):
        self.sizes = np.array([len(c) + 1 for c in self.cuts] + [w + 1 for w in self.widths], dtype=np.int64)
        self.offsets = np.r_[0, np.cumsum(self.sizes)]
        self.cells = int(self.offsets[-1])
        self.numeric = len(self.cuts)
        self.width = self.numeric + sum(self.widths)
        # the vector position of each cell, and whether a split can be made there: not after
        # the last bin, and not on the slot of unknown categories
        self.position = np.zeros(self.cells, dtype=np.int64)
        self.open = np.ones(self.cells, dtype=bool)
        at = self.numeric
        for c in range(len(self.sizes)):
            lo, hi = self.offsets[c], self.offsets[c + 1]
            self.open[hi - 1] = False
            if c < self.numeric:
                self.position[lo:hi] = c
            else:
                self.position[lo : hi - 1] = np.arange(at, at + hi - lo - 1)
                at += hi - lo - 1
        self.column = np.repeat(np.arange(len(self.sizes)), self.sizes)
        # columns whose codes go together in one number, small ones with small ones
        self.bundles: list[list[int]] = []
        for c in np.argsort(self.sizes, kind="stable").tolist():
            if not self.bundles or int(np.prod(self.sizes[[*self.bundles[-1], c]])) > JOINT_CELLS:
                self.bundles.append([])
            self.bundles[-1].append(c)
        self.joint_sizes = np.array([np.prod(self.sizes[b]) for b in self.bundles], dtype=np.int64)
        self.joint_offsets = np.r_[0, np.cumsum(self.joint_sizes)]

    def apart(self, joint: np.ndarray) -> np.ndarray:
        """Sums by cell from sums by combination."""
        out = np.empty(self.cells)
        for b, columns in enumerate(self.bundles):
            cube = joint[self.joint_offsets[b] : self.joint_offsets[b + 1]].reshape(self.sizes[columns])
            for axis, c in enumerate(columns):
                others = tuple(a for a in range(len(columns)) if a != axis)
                out[self.offsets[c] : self.offsets[c + 1]] = cube.sum(axis=others)
        return out


@dataclass
class Block:
    codes: list[np.ndarray]
    label: np.ndarray
    margin: np.ndarray
    number: int


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has column -1."""

    column: list[int] = field(default_factory=list)
    code: list[int] = field(default_factory=list)
    cell: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    count: list[float] = field(default_factory=list)

    def packed(self) -> Tree:
        """The same in arrays, which take a fraction of the memory."""
        return Tree(**{name: array("d" if name in _FLOATS else "q", column) for name, column in vars(self).items()})

    def add(self, value: float, count: float) -> int:
        for column, x in ((self.column, -1), (self.code, -1), (self.cell, -1), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, -1.0), (self.count, count)):
            column.append(x)
        return len(self.value) - 1


def _draw(block: Block, params: BoostParams, tree: int) -> np.ndarray:
    return np.random.default_rng([params.seed, tree, block.number]).random(len(block.label)) < params.subsample


def _score(g: np.ndarray, h: np.ndarray, params: BoostParams) -> np.ndarray:
    """Without meaning where there is no weight; such cells are never taken."""
    if params.l1:
        g = np.sign(g) * np.maximum(np.abs(g) - params.l1, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return g * g / (h + params.l2)


def _value(g: float, h: float, params: BoostParams) -> float:
    shrunk = np.sign(g) * max(abs(g) - params.l1, 0)
    return float(-params.rate * shrunk / (h + params.l2)) if h + params.l2 > 0 else 0.0


def _bests(
    sums: Sequence[tuple[np.ndarray, np.ndarray]], layout: Layout, open_cells: np.ndarray, params: BoostParams
) -> Iterator[tuple[int, float, float, float, float, float]]:
    """For each node its best cell (the first among equal ones) with the gain, the left child's sums and the node's."""
    for lo in range(0, len(sums), NODES_AT_A_TIME):
        yield from _bests_of(*(np.stack(x) for x in zip(*sums[lo : lo + NODES_AT_A_TIME])), layout, open_cells, params)


def _bests_of(g: np.ndarray, h: np.ndarray, layout: Layout, open_cells: np.ndarray, params: BoostParams) -> Iterator[tuple[int, float, float, float, float, float]]:
    total_g, total_h = g[:, : layout.sizes[0]].sum(axis=1), h[:, : layout.sizes[0]].sum(axis=1)
    left_g, left_h = total_g[:, None] - g, total_h[:, None] - h
    for c in range(layout.numeric):
        span = slice(layout.offsets[c], layout.offsets[c + 1])
        left_g[:, span], left_h[:, span] = np.cumsum(g[:, span], axis=1), np.cumsum(h[:, span], axis=1)
    right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
    least = max(params.min_child_weight, 1)
    gain = _score(left_g, left_h, params) + _score(right_g, right_h, params) - _score(total_g, total_h, params)[:, None]
    gain[~(open_cells & (left_h >= least) & (right_h >= least))] = -np.inf
    cell, node = np.argmax(gain, axis=1), np.arange(len(g))
    return zip(cell.tolist(), gain[node, cell].tolist(), left_g[node, cell].tolist(), left_h[node, cell].tolist(), total_g.tolist(), total_h.tolist())


class _Local:
    """Sums over blocks that one task holds, with the rows of each node side by side."""

    def __init__(self, blocks: list[Block], layout: Layout):
        self.blocks, self.layout = blocks, layout
        self.codes = [np.concatenate([b.codes[c] for b in blocks]) if blocks else np.zeros(0, np.uint8) for c in range(len(layout.sizes))]
        self.label, self.margin = (np.concatenate([np.zeros(0), *[getattr(b, name) for b in blocks]]) for name in ("label", "margin"))
        # what is held once need not be held by block too
        at = 0
        for b in blocks if len(blocks) > 1 else ():
            b.codes, b.margin, b.label = [], np.zeros(0), self.label[at : at + len(b.label)]
            at += len(b.label)

    @cached_property
    def cells(self) -> np.ndarray:
        """The cells of a row together, so that a row is fetched once for all columns."""
        out = np.empty((len(self.label), len(self.codes)), dtype=np.int32)
        for c, codes in enumerate(self.codes):
            np.add(codes, self.layout.offsets[c], out=out[:, c], casting="unsafe")
        return out

    @cached_property
    def joint(self) -> np.ndarray:
        """The same for the combinations of columns."""
        layout = self.layout
        out = np.empty((len(self.label), len(layout.bundles)), dtype=np.int32)
        for b, columns in enumerate(layout.bundles):
            place = np.zeros(len(self.label), dtype=np.int32)
            for c in columns:
                place *= np.int32(layout.sizes[c])
                place += self.codes[c].astype(np.int32)
            np.add(place, layout.joint_offsets[b], out=out[:, b], casting="unsafe")
        return out

    def totals(self) -> tuple[float, int]:
        return sum(float(b.label.sum()) for b in self.blocks), sum(len(b.label) for b in self.blocks)

    def begin(self, base: float | None, params: BoostParams, number: int) -> None:
        if base is not None:
            self.margin = np.full(len(self.label), base)
        self.weight, self.unit = self.margin - self.label, None
        most = np.abs(self.weight).max(initial=0.0)
        if np.isfinite(most):
            self.unit = float(np.ldexp(1.0, int(np.frexp(most)[1]) - GRADIENT_BITS))
            self.weight = np.rint(self.weight / self.unit) + ONE_ROW
        # the rows of each node, those that are drawn first, and how many these are
        self.rows = {0: np.arange(len(self.label))}
        self.drawn = {0: len(self.label)}
        if params.subsample < 1 and self.blocks:
            drawn = np.concatenate([_draw(b, params, number) for b in self.blocks])
            self.rows[0] = np.concatenate([np.flatnonzero(drawn), np.flatnonzero(~drawn)])
            self.drawn[0] = int(np.count_nonzero(drawn))

    def route(self, tree: Tree, fresh: Sequence[int]) -> None:
        """Give the rows of the nodes ``fresh`` to their children."""
        for n in fresh:
            rows, drawn, c = self.rows.pop(n), self.drawn.pop(n), tree.column[n]
            codes = self.codes[c].take(rows)
            # numbers up to the cut go left; of a category, all others do
            goes_left = codes <= tree.code[n] if c < self.layout.numeric else codes != tree.code[n]
            for child, places in ((tree.left[n], np.flatnonzero(goes_left)), (tree.right[n], np.flatnonzero(~goes_left))):
                self.rows[child], self.drawn[child] = rows.take(places), int(places.searchsorted(drawn))

    def sums(self, tree: Tree, fresh: Sequence[int], wanted: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and counts of the drawn rows by wanted node and cell."""
        self.route(tree, fresh)
        layout, (g, h) = self.layout, np.zeros((2, len(wanted), self.layout.cells))
        lists = [self.rows[n][: self.drawn[n]] for n in wanted]
        lo = 0
        while lo < len(lists):
            # as many nodes at a time as have some thousand rows together, a large one in pieces
            hi, held = lo + 1, len(lists[lo])
            while hi < len(lists) and held + len(lists[hi]) <= STEP_ROWS:
                held, hi = held + len(lists[hi]), hi + 1
            rows = np.concatenate(lists[lo:hi])
            if len(rows) > STEP_ROWS:
                one_g, one_h = self._added(self.joint, rows, None, int(layout.joint_offsets[-1]))
                g[lo], h[lo] = layout.apart(one_g), layout.apart(one_h)
            else:
                at = np.repeat(np.arange(hi - lo, dtype=np.int32) * np.int32(layout.cells), [len(x) for x in lists[lo:hi]])
                some_g, some_h = self._added(self.cells, rows, at, (hi - lo) * layout.cells)
                g[lo:hi], h[lo:hi] = some_g.reshape(hi - lo, -1), some_h.reshape(hi - lo, -1)
            lo = hi
        return g, h

    def _added(self, cells: np.ndarray, rows: np.ndarray, at: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Gradients and counts of the rows by cell; ``at`` is added to a row's cells."""
        g, h = np.zeros((2, size))
        for i in range(0, len(rows), STEP_ROWS):
            some = rows[i : i + STEP_ROWS]
            place = cells.take(some, axis=0)
            if at is not None:
                place += at[i : i + STEP_ROWS, None]
            both = np.bincount(place.ravel(), np.repeat(self.weight[some], cells.shape[1]), size)
            if self.unit is None:  # without a number for every row
                count = np.bincount(place.ravel(), minlength=size)
            else:
                count = np.rint(both / ONE_ROW)
                both = (both - count * ONE_ROW) * self.unit
            h += count
            g += both
        return g, h

    def finish(self, tree: Tree, fresh: Sequence[int], ratio: bool = False) -> None:
        self.route(tree, fresh)
        for n, rows in self.rows.items():
            self.margin[rows] += tree.value[n]
        if ratio:
            with np.errstate(over="ignore"):
                self.ratio = float(np.exp(self.label - self.margin).sum())


class _Spread:
    """Sums over blocks in many tasks: a job per level, and margins kept after each tree."""

    def __init__(self, blocks: DataFrame, layout: Layout):
        self.state, self.layout, self.kept, self.trees = blocks, layout, [], 0

    def totals(self) -> tuple[float, int]:
        row = self.state.agg(F.sum("total"), F.sum("rows")).first()
        return row[0] or 0.0, row[1] or 0

    def begin(self, base: float | None, params: BoostParams, number: int) -> None:
        self.params, self.number = params, number
        if base is not None:
            def start(block: Block) -> np.ndarray:
                return np.full(len(block.label), base)

            self._keep(start)

    def _keep(self, margin) -> None:
        layout = self.layout

        def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, batch, i in _read(batches, layout):
                at = batch.schema.get_field_index("margin")
                yield batch.slice(i, 1).set_column(at, "margin", pa.array([margin(block).tobytes()], pa.binary()))

        state = self.state.mapInArrow(update, self.state.schema)
        self.trees += 1
        if self.trees % CHECKPOINT_TREES == 0:
            self.state, kept = written(state, "boost-margins"), None
            self.let_go()
        else:
            # filled by the next job over the blocks, the sums of the next tree
            self.state = kept = state.persist(StorageLevel.MEMORY_AND_DISK)
        self.kept.append(kept)

    def let_go(self) -> None:
        """Margins that later ones have taken the place of."""
        for kept in self.kept:
            if kept is not None and kept is not self.state:
                kept.unpersist()
        self.kept = [kept for kept in self.kept if kept is self.state]

    def sums(self, tree: Tree, fresh: Sequence[int], wanted: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        layout, params, number = self.layout, self.params, self.number
        shape, splits = (2, len(wanted), layout.cells), _ancestors(tree, wanted)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shape)
            for block, _, _ in _read(batches, layout):
                own = _Local([block], layout)
                own.begin(None, params, number)
                own.route(tree, splits)
                out += np.stack(own.sums(tree, [], wanted))
            place = np.flatnonzero(out[1])
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(out[0].ravel()[place]), pa.array(out[1].ravel()[place])], names=["place", "g", "h"])

        # sums by cell meet in the shuffle, so that the loop receives one level's cells once
        found = self.state.mapInArrow(add, "place bigint, g double, h double").groupBy("place").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        g, h, place = np.zeros(shape[1] * shape[2]), np.zeros(shape[1] * shape[2]), found.column("place").to_numpy()
        g[place], h[place] = found.column("g").to_numpy(), found.column("h").to_numpy()
        self.let_go()
        return g.reshape(shape[1:]), h.reshape(shape[1:])

    def finish(self, tree: Tree, fresh: Sequence[int], ratio: bool = False) -> None:
        layout, params, number = self.layout, self.params, self.number
        last = number + 1 == params.rounds
        if last and not ratio:
            return  # nothing follows the last tree
        splits = [n for n in range(len(tree.column)) if tree.column[n] >= 0]

        def moved(block: Block) -> np.ndarray:
            own = _Local([block], layout)
            own.begin(None, replace(params, subsample=1.0), number)
            own.finish(tree, splits)
            return own.margin

        def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, _, _ in _read(batches, layout):
                with np.errstate(over="ignore"):
                    total = float(np.exp(block.label - moved(block)).sum())
                yield pa.RecordBatch.from_arrays([pa.array([total])], names=["total"])

        if ratio:
            self.ratio = self.state.mapInArrow(compared, "total double").agg(F.sum("total")).first()[0]
        if not last:
            self._keep(moved)


def _ancestors(tree: Tree, nodes: Sequence[int]) -> list[int]:
    """The split nodes on the way from the root to ``nodes``, parents first."""
    parent = {child: n for n in range(len(tree.column)) if tree.column[n] >= 0 for child in (tree.left[n], tree.right[n])}
    found = set()
    for n in nodes:
        while n in parent and parent[n] not in found:
            n = parent[n]
            found.add(n)
    return sorted(found)  # children are numbered after their parents


def _grow(work: _Local | _Spread, layout: Layout, params: BoostParams, number: int, base: float | None, ratio: bool = False) -> Tree:
    """One tree on the current margins, which are then moved by it; with ``ratio`` labels and moved margins are compared."""
    work.begin(base, params, number)
    open_cells = layout.open
    if params.columns < 1:
        drawn = np.random.default_rng([params.seed, number]).permutation(layout.width)[: max(1, int(params.columns * layout.width))]
        allowed = np.zeros(layout.width, dtype=bool)
        allowed[drawn] = True
        open_cells = layout.open & allowed[layout.position]
    tree = Tree()
    g, h = work.sums(Tree(value=[0.0], column=[-1]), [], [0])
    held, level, fresh = {0: (g[0], h[0])}, [0], []
    tree.add(_value(g[0][: layout.sizes[0]].sum(), h[0][: layout.sizes[0]].sum(), params), h[0][: layout.sizes[0]].sum())
    for depth in range(params.depth):
        fresh, small = [], []
        found = _bests([held[n] for n in level], layout, open_cells, params)
        for n, (cell, gain, left_g, left_h, total_g, total_h) in zip(level, found):
            if not gain > max(params.gamma, LEAST_GAIN):
                held.pop(n)
                continue
            column = int(layout.column[cell])
            tree.column[n], tree.code[n], tree.cell[n], tree.gain[n] = column, int(cell - layout.offsets[column]), cell, gain
            tree.left[n] = tree.add(_value(left_g, left_h, params), left_h)
            tree.right[n] = tree.add(_value(total_g - left_g, total_h - left_h, params), total_h - left_h)
            fresh.append(n)
            small.append(tree.left[n] if 2 * left_h <= total_h else tree.right[n])
        if not fresh or depth + 1 == params.depth:
            break
        g, h = work.sums(tree, fresh, small)
        level = []
        for k, n in enumerate(fresh):
            whole = held.pop(n)
            other = tree.right[n] if small[k] == tree.left[n] else tree.left[n]
            held[small[k]], held[other] = (g[k], h[k]), (whole[0] - g[k], whole[1] - h[k])
            # a child of fewer rows than two children need is a leaf
            level += [child for child in (tree.left[n], tree.right[n]) if tree.count[child] >= 2 * max(params.min_child_weight, 1)]
        if not level:
            fresh = []
            break
    work.finish(tree, fresh if params.depth else [], ratio)
    return tree


class Trees(list[Tree]):
    """Trees in order, and for each asked number of them the mean of exp(label - margin) over all rows, where there are any."""

    ratios: dict[int, float]


def _boost(work: _Local | _Spread, layout: Layout, params: BoostParams, ends: Sequence[int] = ()) -> tuple[float, Trees]:
    total, rows = work.totals()
    base, trees = total / rows if rows else 0.0, Trees()
    trees.ratios = {}
    for t in range(params.rounds):
        trees.append(_grow(work, layout, params, t, base if t == 0 else None, t + 1 in ends).packed())
        if t + 1 in ends and rows:
            trees.ratios[t + 1] = work.ratio / rows
    return base, trees


# --- from vectors to blocks -----------------------------------------------------------


def _dense(batch: pa.RecordBatch, numeric: int, widths: Sequence[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers (rows x numeric) and the slot of each category (its width where none is set) of a batch of vectors."""
    vectors = batch.column("features")
    sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
    values, indices = vectors.field("values"), vectors.field("indices")
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.values.to_numpy(zero_copy_only=False)[values.offsets[0].as_py() : values.offsets[len(values)].as_py()]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(flat)) - first
    if sparse.any():
        known = indices.values.to_numpy(zero_copy_only=False)[indices.offsets[0].as_py() : indices.offsets[len(indices)].as_py()]
        place[sparse[owner]] = known
    out = np.zeros((len(sizes), numeric))
    of_numbers = place < numeric
    out[owner[of_numbers], place[of_numbers]] = flat[of_numbers]
    slots, lo = [], numeric
    for width in widths:
        inside = (place >= lo) & (place < lo + width) & (flat != 0)
        slot = np.full(len(sizes), width, dtype=np.int64)
        slot[owner[inside]] = place[inside] - lo
        slots.append(slot)
        lo += width
    return out, slots


def fit_layout(vectors: DataFrame, numeric: int, widths: Sequence[int], bins: int = BINS) -> Layout:
    """Cut points of the numeric positions: sketched quantiles, all positions in one pass."""

    def melt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, _ = _dense(batch, numeric, [])
            columns = [pa.array(np.tile(np.arange(numeric, dtype=np.int32), len(numbers))), pa.array(numbers.ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["position", "value"])

    found = {}
    if numeric:
        long = vectors.select("features").mapInArrow(melt, "position int, value double")
        probs = [F.lit(i / bins) for i in range(1, bins)]
        rows = long.groupBy("position").agg(F.percentile_approx("value", F.array(*probs), SKETCH_ACCURACY).alias("q"), F.max("value").alias("most")).collect()
        found = {r["position"]: np.unique([q for q in r["q"] if q < r["most"]]) for r in rows}  # one row per position
    return Layout([np.asarray(found.get(p, []), dtype=np.float64) for p in range(numeric)], list(widths))


_BLOCK_SCHEMA = "number bigint, rows bigint, total double, codes array<binary>, label binary, margin binary"


def bin_rows(vectors: DataFrame, layout: Layout, label: str = "label") -> DataFrame:
    """Blocks of codes and labels, written once."""
    spread = vectors.select("features", F.col(label).cast("double").alias("label"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        held: list[tuple[list[np.ndarray], np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal n
            codes = [np.concatenate([h[0][c] for h in held]) for c in range(len(layout.sizes))]
            label = np.concatenate([h[1] for h in held])
            held.clear()
            n += 1
            row = [[(part << 32) + n], [len(label)], [float(label.sum())], [[c.tobytes() for c in codes]], [label.tobytes()], [b""]]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["number", "rows", "total", "codes", "label", "margin"])

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(lo, BLOCK_ROWS)
                numbers, slots = _dense(some, layout.numeric, layout.widths)
                codes = [np.searchsorted(cuts, numbers[:, p], side="left") for p, cuts in enumerate(layout.cuts)] + slots
                held.append(([c.astype(_kind(int(layout.sizes[k]))) for k, c in enumerate(codes)], some.column("label").to_numpy(zero_copy_only=False)))
                if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                    yield flush()
        if held:
            yield flush()

    return written(spread.mapInArrow(pack, _BLOCK_SCHEMA), "boost-blocks")


def _kind(size: int) -> np.dtype:
    return np.dtype(np.uint8 if size <= 256 else np.uint16 if size <= 65536 else np.uint32)


def _read(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple[Block, pa.RecordBatch, int]]:
    for batch in batches:
        for i in range(batch.num_rows):
            codes = [np.frombuffer(c.as_py(), dtype=_kind(int(layout.sizes[k]))) for k, c in enumerate(batch.column("codes")[i])]
            label, margin = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.float64) for c in ("label", "margin"))
            yield Block(codes, label, margin, batch.column("number")[i].as_py()), batch, i


def boost(blocks: DataFrame, layout: Layout, params: BoostParams, task_rows: int = TASK_ROWS, ends: Sequence[int] = ()) -> tuple[float, Trees]:
    """The mean label and the trees. Up to ``task_rows`` rows the whole loop runs in one task, beyond it a job sums each level.

    ``ends`` are the numbers of trees after which labels and margins are compared.
    """
    rows = blocks.agg(F.sum("rows")).first()[0] or 0
    if rows > task_rows:
        work = _Spread(blocks, layout)
        out = _boost(work, layout, params, ends)
        work.state = None
        work.let_go()
        return out

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((block for block, _, _ in _read(batches, layout)), key=lambda b: b.number)
        base, trees = _boost(_Local(held, layout), layout, params, ends)
        for t, tree in enumerate(trees):
            nodes = len(tree.value)
            columns = {"tree": [t] * nodes, "base": [base] * nodes, "ratio": [trees.ratios.get(t + 1)] * nodes, **vars(tree)}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.float64() if k in _FLOATS else pa.int64()) for k, v in columns.items()})

    schema = ", ".join(f"`{c}` {'double' if c in _FLOATS else 'bigint'}" for c in ["tree", "base", "ratio", *vars(Tree())])
    found = blocks.coalesce(1).mapInArrow(fit, schema).toArrow()
    trees = Trees(Tree().packed() for _ in range(params.rounds))
    trees.ratios = {}
    for batch in found.to_batches():
        number = batch.column("tree").to_numpy()
        columns = {name: batch.column(name).to_numpy() for name in vars(Tree())}
        # a tree's nodes come together, but a batch may end among them
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else []
        for lo, hi in zip(starts, [*starts[1:], len(number)]):
            for name, column in vars(trees[number[lo]]).items():
                column.frombytes(columns[name][lo:hi].tobytes())
            ratio = batch.column("ratio")[lo].as_py()
            if ratio is not None:
                trees.ratios[int(number[lo]) + 1] = ratio
    return (found.column("base")[0].as_py() if len(found) else 0.0), trees


_FLOATS = {"base", "ratio", "value", "gain", "count"}

# --- trees as a model -----------------------------------------------------------------

_DEFAULTS = {
    "cacheNodeIds": False, "checkpointInterval": 10, "featuresCol": "features", "impurity": "variance", "labelCol": "label", "leafCol": "",
    "maxBins": BINS, "maxDepth": 5, "maxMemoryInMB": 256, "minInfoGain": 0.0, "minInstancesPerNode": 1, "minWeightFractionPerNode": 0.0, "predictionCol": "prediction", "seed": 0,
}
_BOOSTED_DEFAULTS = {"featureSubsetStrategy": "all", "lossType": "squared", "maxIter": 20, "stepSize": 0.1, "subsamplingRate": 1.0, "validationTol": 0.01}


def _node_table(base: float, trees: Sequence[Tree], layout: Layout) -> pa.Table:
    """The nodes as the ML library stores them, a column of all trees at a time."""
    for tree in trees:
        if not tree.value:
            tree.add(0.0, 0.0)
    sizes = [len(tree.value) for tree in trees]
    flat = {k: np.concatenate([np.asarray(getattr(tree, k)) for tree in trees]) for k in vars(trees[0])}
    number = np.concatenate([np.arange(n) for n in sizes])
    split, cell = flat["column"] >= 0, flat["cell"].astype(np.int64)
    threshold = np.full(layout.cells, 0.5)  # of categories; a number's cells are its cut points, and a last one without
    for c, cuts in enumerate(layout.cuts):
        threshold[layout.offsets[c] : layout.offsets[c] + len(cuts)] = cuts
    value = flat["value"].astype(np.float64)
    value[: sizes[0]] += base
    count, unused = flat["count"].astype(np.float64), np.full(len(number), -1, dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(split)], pa.int32()), pa.array(threshold[cell[split]], pa.float64()))
    stats = np.zeros((len(number), 3))
    stats[:, 0] = count
    stats = pa.ListArray.from_arrays(pa.array(np.arange(len(number) + 1) * 3, pa.int32()), pa.array(stats.ravel()))
    splits = {"featureIndex": pa.array(np.where(split, layout.position[cell], -1), pa.int32()), "leftCategoriesOrThreshold": lists, "numCategories": pa.array(unused)}
    data = {
        "id": pa.array(number, pa.int32()), "prediction": pa.array(value), "impurity": pa.array(np.zeros(len(number))), "impurityStats": stats,
        "rawCount": pa.array(count.astype(np.int64)), "gain": pa.array(flat["gain"], pa.float64()), "leftChild": pa.array(flat["left"], pa.int32()),
        "rightChild": pa.array(flat["right"], pa.int32()), "split": pa.StructArray.from_arrays(list(splits.values()), list(splits)),
    }
    owner = pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))
    return pa.table({"treeID": owner, "nodeData": pa.StructArray.from_arrays(list(data.values()), list(data))})


def stored_model(
    spark: SparkSession, kind: type, uid: str, base: float, trees: Sequence[Tree], layout: Layout, given: Mapping[str, Any], defaults: Mapping[str, Any]
) -> Any:
    """The trees as a model of the ML library, by way of its stored form; ``base`` is part of the first tree."""
    nodes, n = _node_table(base, trees, layout), len(trees)
    path, now = scratch_path(spark, "trees-model"), int(time.time() * 1000)

    def described(name: str, uid: str, given: Mapping[str, Any], defaults: Mapping[str, Any], **more: Any) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.regression.{name}", "timestamp": now, "sparkVersion": spark.version, "uid": uid, "paramMap": given, "defaultParamMap": defaults, **more})

    try:
        whole = described(kind.__name__, uid, given, defaults, numFeatures=layout.width, numTrees=n)
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        each = [(t, described("DecisionTreeRegressionModel", f"dtr_hist_{t}", {"maxDepth": given["maxDepth"]}, _DEFAULTS), 1.0) for t in range(n)]
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(nodes).write.parquet(f"{path}/data")
        return kind.load(path)
    finally:
        remove(spark, path)


def as_model(spark: SparkSession, base: float, trees: Sequence[Tree], layout: Layout, params: BoostParams) -> GBTRegressionModel:
    """The trees of a boosted fit as a model."""
    given = {"maxDepth": min(params.depth, 30), "maxIter": max(params.rounds, 1), "stepSize": params.rate, "subsamplingRate": params.subsample, "seed": params.seed}
    return stored_model(spark, GBTRegressionModel, "GBTRegressor_hist", base, trees or [Tree()], layout, given, {**_DEFAULTS, **_BOOSTED_DEFAULTS})


def binned(vectors: DataFrame, numeric: int, widths: Sequence[int], label: str = "label") -> tuple[Layout, DataFrame]:
    """The layout of the vectors and their blocks, which any number of fits can read."""
    layout = fit_layout(vectors, numeric, widths)
    return layout, bin_rows(vectors, layout, label)


def fit_stages(
    spark: SparkSession, layout: Layout, blocks: DataFrame, params: BoostParams, stages: Sequence[int], compared: bool = False
) -> tuple[list[GBTRegressionModel], Callable[[int], GBTRegressionModel], dict[int, float]]:
    """One fit of ``params.rounds`` trees as a model of each part between two stages, whose sums are the first so many trees, and a way to models of those.

    With ``compared``, also the mean of exp(label - prediction) after each stage, by its number of trees.
    """
    ends = sorted(set(stages))
    base, trees = boost(blocks, layout, params, TASK_ROWS, ends if compared else ())
    parts = [as_model(spark, base if lo == 0 else 0.0, trees[lo:hi], layout, replace(params, rounds=hi - lo)) for lo, hi in zip([0, *ends], ends)]
    return parts, lambda n: as_model(spark, base, trees[:n], layout, replace(params, rounds=n)), trees.ratios
