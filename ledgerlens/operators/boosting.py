"""Second-order boosted trees on binned columns, grown by Spark aggregates.

Every input is cut once at 254 estimated quantiles; a row keeps one byte per input (the last
value is for missing numbers), its label, weight and score. Rows that agree in all bytes,
label and weight stay alike in every round, so they are kept once, with their number. A
round fits one tree to the gradients and hessians of the logistic loss. A pass sums both by
node, input and bin in the tasks, Spark adds the sums in a tree, and the driver, which sees
one number per cell, picks the splits. Of two siblings only the one with fewer rows is summed; the other is the
difference to the parent. Leaves are worth -G / (H + L2) times the step size.

`level` growth splits every node of a depth that gains, down to `maxDepth`: one pass a
depth. `leaf` growth splits the leaf of greatest gain until there are `maxLeaves`, at any
depth; each pass serves all leaves that may be next, so there is at most one pass a depth
here, too, and the tree is the same as if they were asked for one by one.

A round's tree often has the splits of the one before. The first pass of a round therefore
sums the nodes that the last tree asked for, too; where the new tree splits alike, the sums
are known, and another pass is for the rest only. As long as less than half of a tree's nodes
are found so, no pass sums ahead.

Rows are cached as blocks of arrays by column, so a pass is one short stage of as many tasks as
there are cores, or more where a task would get beyond `TASK_ROWS` rows. A row keeps the node of
the last tree that it fell in. A pass starts there: it walks a row only below the splits that
both trees have, and only on the way to asked nodes. Each row is summed once, at the deepest
asked node; the sums of the nodes above follow. A tree that has no other splits than the last
one adds its values per node, and the cached rows stay as they are; only after other splits are
they walked and cached anew. Every `STORE_EVERY` times that they are, they are checkpointed in
the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasMaxIter, HasStepSize, HasWeightCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import drop_path, shared_dir

BINS = 256
MISSING = BINS - 1
EDGES = BINS - 2
STORE_EVERY = 10
TASK_ROWS = 1 << 20
BLOCK_ROWS = 1 << 16
FLAT_TASKS = 16  # the sums of so many tasks are added on the driver alone
LEAST_GAIN, ALIKE = 1e-6, 1e-10
LEVEL, LEAF = "level", "leaf"


# ---- one tree


@dataclass
class Tree:
    """Nodes by number; node 0 is the root. A row goes left if its bin is at most `cut`."""

    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, column: int, cut: int, missing_left: bool) -> tuple[int, int]:
        at = len(self.column)
        for _ in range(2):
            for values, empty in zip(self._lists(), (-1, 0, False, -1, -1, 0.0)):
                values.append(empty)
        self.column[node], self.cut[node], self.missing_left[node] = column, cut, missing_left
        self.left[node], self.right[node] = at, at + 1
        return at, at + 1

    def _lists(self) -> tuple[list, ...]:
        return self.column, self.cut, self.missing_left, self.left, self.right, self.value

    def walk(self, bins: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per depth the rows of bins that get there, and the node of each."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            yield rows, node[rows]
            rows = rows[np.array(self.left)[node[rows]] >= 0]
            self._step(bins, node, rows)

    def _step(self, bins: np.ndarray, node: np.ndarray, rows: np.ndarray) -> None:
        """Moves these rows from their nodes to the children."""
        column, cut, missing_left, left, right = (np.array(x) for x in self._lists()[:5])
        at = node[rows]
        b = bins[rows, column[at]]
        goes_left = np.where(b == MISSING, missing_left[at], b <= cut[at])
        node[rows] = np.where(goes_left, left[at], right[at])

    def walk_on(self, bins: np.ndarray, node: np.ndarray, goes_on: np.ndarray | None = None) -> np.ndarray:
        """Where rows get from these nodes; `goes_on` tells per node if its rows go on, else all but leaves do."""
        goes_on = np.array(self.left) >= 0 if goes_on is None else goes_on
        rows = np.flatnonzero(goes_on[node])
        while len(rows):
            self._step(bins, node, rows)
            rows = rows[goes_on[node[rows]]]
        return node

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        return self.walk_on(bins, np.zeros(len(bins), np.int64))

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves_of(bins)]

    def alike(self, other: Tree) -> dict[int, int]:
        """Nodes with the same splits above them in both trees: number here -> number there."""
        out = {0: 0}
        for n in range(len(self.column)):
            m = out.get(n)
            if m is not None and self.left[n] >= 0 and other.left[m] >= 0 and self._split_at(n) == other._split_at(m):
                out[self.left[n]], out[self.right[n]] = other.left[m], other.right[m]
        return out

    def within(self, other: Tree) -> np.ndarray:
        """Per node the deepest node there that has all its rows, as the splits above both tell."""
        same, out = self.alike(other), np.zeros(len(self.column), np.int64)
        for n in range(len(self.column)):
            if self.left[n] >= 0:
                for child in (self.left[n], self.right[n]):
                    out[child] = same.get(child, out[n])
        return out

    def finer(self, other: Tree) -> bool:
        """Whether a leaf here lies in one leaf there, as the splits tell."""
        leaves = np.array(self.left) < 0
        return bool((np.array(other.left)[self.within(other)[leaves]] < 0).all())

    def shape(self) -> tuple:
        return tuple(map(tuple, self._lists()[:5]))

    def _split_at(self, node: int) -> tuple[int, int, bool]:
        return self.column[node], self.cut[node], self.missing_left[node]

    def kept(self, inner: set[int]) -> Tree:
        """The tree with only these nodes split, numbered anew."""
        out, todo = Tree(), [(0, 0)]
        while todo:
            node, new = todo.pop()
            out.value[new] = self.value[node]
            if node in inner:
                pair = out.split(new, self.column[node], self.cut[node], self.missing_left[node])
                todo += zip((self.left[node], self.right[node]), pair)
        return out


@dataclass(frozen=True)
class Split:
    gain: float
    column: int
    cut: int
    missing_left: bool
    left: np.ndarray  # gradient, hessian and rows of that side
    right: np.ndarray


@dataclass(frozen=True)
class Rules:
    growth: str = LEVEL
    max_depth: int = 6
    max_leaves: int = 31
    l2: float = 1.0
    least_hessian: float = 1.0
    least_rows: int = 1


def best_split(cells: np.ndarray, rules: Rules) -> Split | None:
    """The split of greatest gain of a node; `cells`: (3, columns, bins) sums.

    Of equal gains the first column, then the lowest cut, then missing to the right.
    """
    total = cells[:, 0].sum(-1)
    below = np.cumsum(cells[:, :, :EDGES], -1)
    left = np.stack([below, below + cells[:, :, MISSING:]], -1)  # missing right, or left
    right = total[:, None, None, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sum(s[0] ** 2 / (s[1] + rules.l2) for s in (left, right)) - total[0] ** 2 / (total[1] + rules.l2)
    for side in (left, right):
        gain = np.where((side[1] >= rules.least_hessian) & (side[2] >= max(1, rules.least_rows)), gain, -np.inf)
    best = gain.max()
    if not best > LEAST_GAIN:
        return None
    # Sums come in any order, so what differs in the last digits counts as equal.
    column, cut, missing_left = np.unravel_index(np.argmax(gain >= best * (1 - ALIKE)), gain.shape)
    best = float(f"{best:.9g}")
    at = (slice(None), column, cut, missing_left)
    return Split(best, int(column), int(cut), bool(missing_left), left[at].copy(), right[at].copy())


#: Sums of the asked nodes' cells under a tree: node -> (3, columns, bins).
Histograms = Callable[[Tree, list[int]], dict[int, np.ndarray]]


class _Growing:
    """A tree whose nodes get their sums from passes."""

    def __init__(self, histograms: Histograms, rules: Rules, rate: float):
        self.histograms, self.rules, self.rate = histograms, rules, rate
        self.tree, self.cells, self.splits = Tree(), {}, {}
        self._learn(0, histograms(self.tree, [0])[0])
        self._worth(0, self.cells[0][:, 0].sum(-1))

    def _learn(self, node: int, cells: np.ndarray) -> None:
        self.cells[node], self.splits[node] = cells, best_split(cells, self.rules)

    def _worth(self, node: int, sums: np.ndarray) -> None:
        self.tree.value[node] = float(-sums[0] / (sums[1] + self.rules.l2)) * self.rate if sums[1] + self.rules.l2 else 0.0

    def divide(self, node: int) -> tuple[int, int]:
        s = self.splits[node]
        pair = self.tree.split(node, s.column, s.cut, s.missing_left)
        for child, sums in zip(pair, (s.left, s.right)):
            self._worth(child, sums)
        return pair

    def learn_children(self, nodes: list[int]) -> None:
        """One pass for the children of divided nodes."""
        smaller = {}
        for n in nodes:
            s, pair = self.splits[n], (self.tree.left[n], self.tree.right[n])
            smaller[n] = pair if s.left[2] <= s.right[2] else pair[::-1]
        found = self.histograms(self.tree, [few for few, _ in smaller.values()])
        for n, (few, many) in smaller.items():
            self._learn(few, found[few])
            self._learn(many, self.cells.pop(n) - found[few])


def grow(histograms: Histograms, rules: Rules, rate: float) -> Tree:
    g = _Growing(histograms, rules, rate)
    return _by_level(g) if rules.growth == LEVEL else _by_leaf(g)


def _by_level(g: _Growing) -> Tree:
    nodes = [0]
    for depth in range(1, g.rules.max_depth + 1):
        nodes = [n for n in nodes if g.splits[n]]
        if not nodes:
            break
        pairs = [g.divide(n) for n in nodes]
        if depth < g.rules.max_depth:
            g.learn_children(nodes)
            nodes = [c for p in pairs for c in p]
    return g.tree


def _by_leaf(g: _Growing) -> Tree:
    """Best first. A pass is for every leaf that is next as far as the gains are known."""
    while True:
        inner, unknown, leaves, ready = set(), [], [0], 1
        while ready < g.rules.max_leaves:
            gaining = [n for n in leaves if g.splits[n]]
            if not gaining:
                break
            best = max(gaining, key=lambda n: (g.splits[n].gain, -n))
            leaves.remove(best)
            ready += 1
            if g.tree.left[best] < 0:
                unknown.append(best)
            else:
                inner.add(best)
                leaves += [g.tree.left[best], g.tree.right[best]]
        if not unknown:
            return g.tree.kept(inner)
        for n in unknown:
            g.divide(n)
        g.learn_children(unknown)


# ---- passes over rows

ROWS = "bins binary, label double, weight double, score double"
BLOCK_FIELDS = ("bins", "label", "weight", "rows", "score")
BLOCKS = ", ".join(f"{f} binary" for f in BLOCK_FIELDS)
# Bins (rows, columns), label, summed weight, rows, score; the node, too, once there was a tree.
Block = tuple[np.ndarray, ...]


def _octets(packed: pa.Array) -> np.ndarray:
    ends = np.frombuffer(packed.buffers()[1], np.int32, len(packed) + 1, packed.offset * 4)
    return np.frombuffer(packed.buffers()[2], np.uint8)[ends[0] : ends[-1]]


def edges_of(rows: DataFrame, inputs: Sequence[str]) -> list[np.ndarray]:
    """Cuts per input: at most EDGES values that occur, near even quantiles of all rows."""
    shares = [(i + 1) / (EDGES + 1) for i in range(EDGES)]
    known = [F.percentile_approx(_number(c), shares, 20_000).alias(f"e{i}") for i, c in enumerate(inputs)]
    row = rows.agg(*known).first()
    return [np.unique(np.array(e or [], float)) for e in row]


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def to_bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """A row's bin: how many cuts are below its value."""
    out = np.empty(values.shape, np.uint8, "F")
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(values[:, j]), MISSING, np.searchsorted(e, values[:, j], "left"))
    return out


def binned(rows: DataFrame, inputs: Sequence[str], edges: Sequence[np.ndarray], label: str, weight: str, score: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(list(edges))  # EDGES numbers per input
    n = len(inputs)

    def pack(batches):
        for batch in batches:
            values = np.stack([batch.column(j).to_numpy(zero_copy_only=False).astype(float) for j in range(n)], 1)
            bins = to_bins(values, shared.value)
            ends = pa.py_buffer(np.arange(0, n * len(bins) + 1, n, dtype=np.int32).tobytes())
            packed = pa.Array.from_buffers(pa.binary(), len(bins), [None, ends, pa.py_buffer(bins.tobytes())])
            base = pa.array(np.full(len(bins), score))
            yield pa.record_batch([packed, batch.column(n), batch.column(n + 1), base], ["bins", "label", "weight", "score"])

    numbers = [_number(c).alias(f"x{i}") for i, c in enumerate(inputs)]
    kept = rows.select(*numbers, F.col(label).cast("double").alias("label"), F.col(weight).cast("double").alias("weight"))
    return kept.mapInArrow(pack, ROWS)


def slopes(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the weighted logistic loss."""
    p = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
    return weight * (p - label), weight * p * (1 - p)


def cell_sums(
    bins: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, rows: np.ndarray | None = None
) -> np.ndarray:
    """(3, slots, columns, bins): gradient, hessian and rows; a negative slot is not summed."""
    out = np.zeros((3, slots, bins.shape[1], BINS))
    inside = np.flatnonzero(slot >= 0)
    _add_cells(out, bins, inside, slot[inside], [None if w is None else w[inside] for w in (g, h, rows)])
    return out


def _add_cells(out: np.ndarray, bins: np.ndarray, at: np.ndarray | None, slot: np.ndarray, weights: Sequence) -> None:
    """Adds the rows of bins `at` these places (None: all) to the cells of their slots."""
    first, slots = slot.astype(np.int64) * BINS, out.shape[1]
    for j in range(bins.shape[1]):
        cell = first + (bins[:, j] if at is None else bins[:, j][at])
        for k, w in enumerate(weights):
            out[k, :, j] += np.bincount(cell, w, slots * BINS).reshape(slots, BINS)


def _asked(tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Per node the place in `nodes` of the deepest one that is it or above it (-1: none), and
    whether one is below it; pairs of places, (one, the next above it), from below."""
    size, place = len(tree.column), {n: i for i, n in enumerate(nodes)}
    deepest, below, above = np.full(size, -1), np.zeros(size, bool), []
    for n in range(size):
        if n in place:
            if deepest[n] >= 0:
                above.append((place[n], int(deepest[n])))
            deepest[n] = place[n]
        if tree.left[n] >= 0:
            deepest[[tree.left[n], tree.right[n]]] = deepest[n]
    for n in reversed(range(size)):
        if tree.left[n] >= 0:
            below[n] = any(c in place or below[c] for c in (tree.left[n], tree.right[n]))
    return deepest, below, above[::-1]


def _numbers(block: Block, worth: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bins, label, weight, rows, score with the worth of the node added, and node."""
    bins, label, weight, rows, score, *node = block
    node = node[0] if node else np.zeros(len(bins), np.uint8)
    return bins, label, weight, rows, score + worth[node], node


def _pass(
    blocks: RDD[Block], columns: int, tree: Tree, nodes: list[int], walked: Tree = Tree(), worth: np.ndarray = np.zeros(1)
) -> dict[int, np.ndarray]:
    """One aggregate over all rows; per asked node, input and bin one number comes back.

    Asked nodes may lie above each other. The blocks' nodes are those of `walked`, of whose
    worth their scores are short.
    """
    start = walked.within(tree)
    deepest, below, above = _asked(tree, nodes)

    def summed(part):
        total = np.zeros((3, len(nodes), columns, BINS))
        for block in part:
            bins, label, weight, rows, score, node = _numbers(block, worth)
            slot, at = deepest[tree.walk_on(bins, start[node], below)], None
            if len(slot) and slot.min() < 0:
                at = np.flatnonzero(slot >= 0)
                slot, label, weight, rows, score = (x[at] for x in (slot, label, weight, rows, score))
            g, h = slopes(score, label, weight)
            _add_cells(total, bins, at, slot, (g, h, None if (rows == 1).all() else rows.astype(float)))
        yield total

    tasks = blocks.getNumPartitions()
    sums = blocks.mapPartitions(summed)
    out = sums.treeReduce(np.add, 1 if tasks <= FLAT_TASKS else 2) if tasks else next(summed(()))
    for i, over in above:
        out[:, over] += out[:, i]
    return {n: out[:, i] for i, n in enumerate(nodes)}


class _Ahead:
    """Sums for round after round; the first pass of one also sums what the last tree asked for."""

    def __init__(self):
        self.tree, self.asked, self.worth = Tree(), [0], True

    def histograms(self, sums: Histograms) -> Histograms:
        """The sums of a new round, for a tree that grows from its root."""
        last, had, asked = self.tree, set(self.asked), []
        known = sums(last, self.asked) if self.worth else {}

        def ask(tree: Tree, nodes: list[int]) -> dict[int, np.ndarray]:
            there = tree.alike(last)
            found = {n: known[there[n]] for n in nodes if there.get(n) in known}
            rest = [n for n in nodes if n not in found]
            asked.extend(nodes)
            self.tree, self.asked = tree, asked
            self.worth = 2 * sum(there.get(n) in had for n in asked) >= len(asked)
            return found | sums(tree, rest) if rest else found

        return ask


def _rescored(blocks: RDD[Block], walked: Tree, worth: np.ndarray, tree: Tree) -> RDD[Block]:
    """Blocks whose nodes are those of `tree`, with the worth of the nodes before in the scores."""
    start, small = walked.within(tree), np.min_scalar_type(len(tree.column))

    def moved(block: Block) -> Block:
        bins, *numbers, node = _numbers(block, worth)
        return bins, *numbers, tree.walk_on(bins, start[node]).astype(small)

    return blocks.map(moved)


def tasks_for(rows: int, cores: int) -> int:
    """A task a core, as far as each gets some rows; more when one would get too many."""
    return max(1, min(cores, -(-rows // 4096)), -(-rows // TASK_ROWS))


def _small(numbers: np.ndarray) -> np.ndarray:
    """In a byte each, if they are whole and fit."""
    fits = len(numbers) and (numbers == np.clip(np.round(numbers), 0, 255)).all()
    return numbers.astype(np.uint8) if fits else numbers


def blocks_of(rows: DataFrame, columns: int) -> RDD[Block]:
    """The rows of `binned`, each kind once, as arrays by column, a block for BLOCK_ROWS rows or some more."""

    def block(batches) -> pa.RecordBatch:
        bins = np.concatenate([_octets(b.column(0)).reshape(-1, columns) for b in batches])
        label, weight, score, many = (
            np.concatenate([b.column(k).to_numpy().astype(float) for b in batches]) for k in range(1, 5)
        )
        arrays = np.asfortranarray(bins).ravel("F"), label, weight * many, many, score
        return pa.record_batch([pa.array([a.tobytes()], pa.binary()) for a in arrays], list(BLOCK_FIELDS))

    def pack(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held += [batch] if batch.num_rows else []
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block(held)
                held = []
        if held:
            yield block(held)

    def unpack(row) -> Block:
        bins, *numbers = row
        label, weight, many, score = (np.frombuffer(x) for x in numbers)
        return np.frombuffer(bins, np.uint8).reshape(columns, -1).T, _small(label), weight, _small(many), score

    kinds = rows.groupBy("bins", "label", "weight", "score").agg(F.count("*").alias("many")).persist()
    try:
        tasks = tasks_for(kinds.count(), rows.sparkSession.sparkContext.defaultParallelism)
        dealt = kinds.repartition(tasks).mapInArrow(pack, BLOCKS).rdd.map(unpack)
        return _stored(dealt.persist(StorageLevel.MEMORY_AND_DISK))
    finally:
        kinds.unpersist()


def _stored(blocks: RDD[Block]) -> RDD[Block]:
    """Blocks that are new, computed and checkpointed."""
    blocks.checkpoint()
    blocks.count()
    return blocks


def boost(first: RDD[Block], columns: int, rounds: int, rate: float, rules: Rules, spark: SparkSession) -> list[Tree]:
    """Trees of up to `rounds` rounds; ends early when no split gains any more.

    `first` as `blocks_of` makes them; they are left as they are.
    """
    trees, ahead, held, made, path = [], _Ahead(), [], 0, None
    blocks, walked, worth = first, Tree(), np.zeros(1)
    try:
        for _ in range(rounds):
            sums = lambda t, nodes: _pass(blocks, columns, t, nodes, walked, worth)  # noqa: B023, E731
            tree = grow(ahead.histograms(sums), rules, rate)
            for old in held[:-1]:
                old.unpersist()
            held = held[-1:]
            if tree.left[0] < 0:
                break
            trees.append(tree)
            if walked.finer(ahead.tree):
                worth = worth + np.array(tree.value)[walked.within(tree)]
                continue
            blocks = _rescored(blocks, walked, worth, ahead.tree).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(blocks)
            walked = ahead.tree
            worth, made = np.array(tree.value)[walked.within(tree)], made + 1
            if made % STORE_EVERY == 0:
                old, path = path, _stored(blocks).getCheckpointFile()
                _drop(spark, old)
    finally:
        for old in held:
            old.unpersist()
        _drop(spark, path)
    return trees


def _drop(spark: SparkSession, path: str | None) -> None:
    if path:
        drop_path(spark, path)


@dataclass(frozen=True)
class Prepared:
    """What a fit starts from: log odds of all rows, cuts and blocks."""

    base: float
    edges: list[np.ndarray]
    blocks: RDD[Block]


class Share:
    """Fits of the same rows with the same weights, also at once, are prepared for once.

    The blocks stay until it is closed.
    """

    def __init__(self):
        self.lock, self.made = threading.Lock(), []

    def prepared(self, rows: DataFrame, inputs: Sequence[str], label: str, weight: str) -> Prepared:
        kept = rows.select(*[F.col(c) for c in inputs], F.col(label), F.col(weight))
        with self.lock:
            for known, value in self.made:
                if known.columns == kept.columns and known.sameSemantics(kept):
                    return value
            shared_dir(rows.sparkSession)
            edges = edges_of(kept, inputs)
            of = lambda y: F.sum(F.when(F.col(label) == y, F.col(weight)))
            ones, zeros = (float(x or 0) for x in kept.agg(of(1), of(0)).first())
            base = float(np.log(ones / zeros)) if ones and zeros else 0.0
            packed = binned(kept, inputs, edges, label, weight, base)
            value = Prepared(base, edges, blocks_of(packed, len(inputs)))
            self.made.append((kept, value))
            return value

    def close(self) -> None:
        for known, value in self.made:
            value.blocks.unpersist()
            _drop(known.sparkSession, value.blocks.getCheckpointFile())
        self.made = []


# ---- as an estimator


class _Settings(HasInputCols, HasLabelCol, HasWeightCol, HasMaxIter, HasStepSize):
    growth = Param(Params._dummy(), "growth", "level or leaf", TypeConverters.toString)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of level growth", TypeConverters.toInt)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of leaf growth", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "L2 penalty on leaf values", TypeConverters.toFloat)
    minHessian = Param(Params._dummy(), "minHessian", "least sum of hessians on a side", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "least rows on a side", TypeConverters.toInt)

    def getMaxDepth(self) -> int:
        return self.getOrDefault(self.maxDepth)

    def rules(self) -> Rules:
        get = self.getOrDefault
        return Rules(get(self.growth), get(self.maxDepth), get(self.maxLeaves), get(self.l2), get(self.minHessian), get(self.minRows))


class BoostedTrees(Estimator, _Settings):
    """Binary classifier; see the module for the method. Labels are 0 and 1."""

    share: Share | None = None

    def __init__(self, **settings):
        super().__init__()
        self._setDefault(
            labelCol="label", maxIter=200, stepSize=0.1, growth=LEVEL, maxDepth=6, maxLeaves=31, l2=1.0, minHessian=1.0, minRows=1
        )
        self._set(**settings)

    def setMaxIter(self, value: int) -> BoostedTrees:
        return self._set(maxIter=value)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        rules = self.rules()
        if rules.growth not in (LEVEL, LEAF):
            raise ValueError(f"growth {rules.growth!r} is neither {LEVEL!r} nor {LEAF!r}")
        inputs, label = self.getInputCols(), self.getLabelCol()
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        rows = dataset if weight else dataset.withColumn("_one", F.lit(1.0))
        weight = weight or "_one"
        share = self.share or Share()
        try:
            start = share.prepared(rows, inputs, label, weight)
            settings = len(inputs), self.getMaxIter(), self.getStepSize(), rules
            trees = boost(start.blocks, *settings, dataset.sparkSession)
        finally:
            if share is not self.share:
                share.close()
        return self._copyValues(BoostedTreesModel(start.base, start.edges, trees))


NODES = "tree int, node int, column int, cut int, missing_left boolean, left int, right int, value double"
CUTS = "column int, edges array<double>"


def margins(values: np.ndarray, base: float, edges: Sequence[np.ndarray], trees: Sequence[Tree]) -> np.ndarray:
    """Log odds of rows of input values."""
    bins, out = to_bins(values, edges), np.full(len(values), base)
    alike: dict[tuple, list[Tree]] = {}  # trees of the same splits are walked once
    for t in trees:
        alike.setdefault(t.shape(), []).append(t)
    for same in alike.values():
        out += np.sum([t.value for t in same], 0)[same[0].leaves_of(bins)]
    return out


class BoostedTreesModel(Model, _Settings, MLWritable, MLReadable):
    """Adds `probability` (a vector) and `prediction`."""

    def __init__(self, base: float = 0.0, edges: Sequence[np.ndarray] = (), trees: Sequence[Tree] = ()):
        super().__init__()
        self.base, self.edges, self.trees = base, list(edges), list(trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        inputs = self.getInputCols()
        # Trees and cuts: their size is bounded by rounds, leaves and inputs.
        shared = dataset.sparkSession.sparkContext.broadcast((self.base, self.edges, self.trees))

        @F.pandas_udf("double")
        def margin(*columns: pd.Series) -> pd.Series:
            values = np.stack([c.to_numpy(float) for c in columns], 1)
            return pd.Series(margins(values, *shared.value))

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        scored = dataset.withColumn("_margin", margin(*[_number(c) for c in inputs]))
        return scored.withColumns(
            {"probability": array_to_vector(F.array(1 - p, p)), "prediction": (F.col("_margin") > 0).cast("double")}
        ).drop("_margin")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, m = self.sparkSession, self.model
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"base": m.base})
        nodes = [
            (t, n, *(x[n] for x in tree._lists())) for t, tree in enumerate(m.trees) for n in range(len(tree.column))
        ]
        spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/nodes")
        cuts = [(i, [float(x) for x in e]) for i, e in enumerate(m.edges)]
        spark.createDataFrame(cuts, CUTS).coalesce(1).write.parquet(f"{path}/cuts")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        trees: list[Tree] = []
        for r in spark.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if r.node == 0:
                trees.append(Tree([], [], [], [], [], []))
            for values, value in zip(trees[-1]._lists(), r[2:]):
                values.append(value)
        cuts = spark.read.schema(CUTS).parquet(f"{path}/cuts").orderBy("column").collect()
        model = BoostedTreesModel(metadata["base"], [np.array(r.edges, float) for r in cuts], trees)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
