"""Forests and boosted trees grown over binned rows, handed over as models of Spark ML.

Features are cut into at most ``maxBins`` bins at quantiles of all rows; the rows are kept as
blocks of one byte per feature. A pass over the blocks grows one level of all open trees: tasks
count the statistics of every (node, feature, bin) tree by tree, so that what is being counted
stays in a core's cache; sums of the tasks meet by tree, where the best cut of each node is found,
and only cuts reach the driver. Rows with no weight in a tree are not touched, and draws, columns
of a node and the order of sums depend on the seed and the layout of the rows alone.

Blocks carry no node numbers: a row's node follows from the cuts found so far.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import groupby
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.sources.shared import new_path

#: Rows that are counted together.
BLOCK_ROWS = 1 << 15
#: Points by which a partition describes the distribution of a feature.
SUMMARY_POINTS = 1 << 10
#: Rows that are boosted within one task: a pass counts one tree a learner, so a job for each costs more.
ROWS_OF_ONE_TASK = 1 << 17
#: Tasks whose sums of a boosted level the driver adds itself; those of more tasks meet by tree first.
TASKS_ADDED_BY_DRIVER = 32
#: Boosted trees after which the chain of margins is cut.
CUT_LINEAGE_AFTER = 25


class Block(NamedTuple):
    part: int
    number: int
    #: A row per feature.
    bins: np.ndarray
    #: A row per target.
    targets: np.ndarray
    #: A row per target, while boosting.
    margins: np.ndarray | None = None


# --- bins ----------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def summary(values: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their counts, or that many points in their place."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) <= points:
        return distinct, counts
    place = (np.cumsum(counts) - 1) * points // len(values)
    last = np.flatnonzero(np.diff(place, append=place[-1] + 1))
    return distinct[last], np.add.reduceat(counts, np.concatenate([[0], last[:-1] + 1]))


def thresholds(values: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """Cuts half-way between neighbours: between all values if they are few, else at quantiles."""
    distinct, inverse = np.unique(values, return_inverse=True)
    upto = np.cumsum(np.bincount(inverse, counts))
    if len(distinct) <= max_bins:
        at = np.arange(len(distinct) - 1)
    else:
        at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, max_bins) / max_bins))
        at = at[at < len(distinct) - 1]
    with np.errstate(invalid="ignore"):
        cuts = distinct[at] / 2 + distinct[at + 1] / 2
    return np.unique(cuts[np.isfinite(cuts)])


def feature_cuts(rows: DataFrame, max_bins: int) -> tuple[list[np.ndarray], int]:
    """The cuts of every feature of ``x``, and the number of rows."""

    def summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(b, "x") for b in batches if b.num_rows]
        if parts:
            found = [summary(column, SUMMARY_POINTS) for column in np.concatenate(parts).T]
            yield pa.record_batch(
                [range(len(found)), [v.tobytes() for v, _ in found], [c.astype("i8").tobytes() for _, c in found]],
                ["feature", "distinct", "counts"],
            )

    described = rows.select("x").mapInArrow(summaries, "feature bigint, distinct binary, counts binary").collect()
    if not described:
        raise ValueError("no rows to learn from")
    per_feature = [
        [np.concatenate([np.frombuffer(r[column], kind) for r in described if r.feature == f]) for column, kind in (("distinct", "f8"), ("counts", "i8"))]
        for f in range(max(r.feature for r in described) + 1)
    ]
    return [thresholds(v, c, max_bins) for v, c in per_feature], int(per_feature[0][1].sum())


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> RDD:
    """Rows of features ``x`` and targets ``y`` as blocks."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, number = TaskContext.get().partitionId(), [], 0

        def block() -> pa.RecordBatch:
            x, y = (np.concatenate(m) for m in zip(*held))
            bins = np.stack([np.searchsorted(c, column).astype(np.uint8) for c, column in zip(cuts, x.T)])
            targets = np.ascontiguousarray(y.T, dtype="f8")
            return pa.record_batch([[part], [number], [len(x)], [bins.tobytes()], [targets.tobytes()]], ["part", "number", "n", "bins", "targets"])

        for batch in batches:
            if batch.num_rows:
                held.append((_matrix(batch, "x"), _matrix(batch, "y")))
            if sum(len(x) for x, _ in held) >= BLOCK_ROWS:
                yield block()
                held, number = [], number + 1
        if held:
            yield block()

    packed = rows.mapInArrow(blocks, "part bigint, number bigint, n bigint, bins binary, targets binary")
    return packed.rdd.map(
        lambda r: Block(r.part, r.number, np.frombuffer(r.bins, np.uint8).reshape(-1, r.n), np.frombuffer(r.targets, "f8").reshape(-1, r.n))
    )


# --- counting --------------------------------------------------------------------


def drawn(n: int, share: float, with_replacement: bool, key: Sequence[int]) -> np.ndarray:
    """How often each of n rows is drawn: from 16 random bits a row, by the draw's distribution."""
    bits = np.random.default_rng(list(key)).integers(0, 1 << 16, n, dtype=np.uint16)
    return _draws(share, with_replacement).take(bits)


_TABLES: dict[tuple[float, bool], np.ndarray] = {}


def _draws(share: float, with_replacement: bool) -> np.ndarray:
    if (share, with_replacement) not in _TABLES:
        point = (np.arange(1 << 16) + 0.5) / (1 << 16)
        if with_replacement:
            chances = [np.exp(-share)]
            while len(chances) < 64:
                chances.append(chances[-1] * share / len(chances))
            table = np.searchsorted(np.cumsum(chances), point)
        else:
            table = point < share
        _TABLES[share, with_replacement] = table.astype(np.uint8)
    return _TABLES[share, with_replacement]


def descend(bins: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row reaches after so many levels; the children of node i are 2i + 1 and 2i + 2."""
    flat, n = bins.reshape(-1), bins.shape[1]
    node = np.zeros(len(rows), np.intp)
    for _ in range(levels):
        right = flat.take(feature.take(node) * n + rows) > cut.take(node)
        node += node + 1 + right
    return node


@dataclass(frozen=True)
class Shape:
    """What the trees of an ensemble have in common."""

    n_features: int
    n_bins: int
    #: Number of classes, or 0 if the trees fit numbers.
    classes: int
    max_depth: int
    n_columns: int
    seed: int

    @property
    def n_stats(self) -> int:
        return self.classes or 3

    def size(self, stats: np.ndarray) -> np.ndarray:
        return stats.sum(-1) if self.classes else stats[..., 0]

    def mass(self, stats: np.ndarray) -> np.ndarray:
        """Impurity times number of rows: Gini over class counts, variance over count, sum and squares."""
        n = np.maximum(self.size(stats), 1)
        if self.classes:
            return self.size(stats) - (stats.astype("f8") ** 2).sum(-1) / n
        return np.maximum(stats[..., 2] - stats[..., 1] ** 2 / n, 0.0)

    def scale(self, stats: np.ndarray) -> np.ndarray:
        """What masses are rounded against."""
        return self.size(stats) if self.classes else stats[..., 2]


class Tree:
    """Cuts and statistics of one tree; nodes in heap order."""

    def __init__(self, shape: Shape, number: int):
        self.shape, self.number = shape, number
        n_cuts, n_nodes = (1 << shape.max_depth) - 1, (2 << shape.max_depth) - 1
        self.feature, self.cut, self.gain = np.full(n_cuts, -1, np.intp), np.full(n_cuts, 255, np.uint8), np.zeros(n_cuts)
        self.stats = np.zeros((n_nodes, shape.n_stats))
        #: Nodes of the current level that may be cut.
        self.open = [0] if shape.max_depth else []

    def add(self, level: int, found: Cuts) -> None:
        opened = []
        for i, node in enumerate(self.open):
            self.stats[node] = found.own[i]
            if found.feature[i] < 0:
                continue
            self.feature[node], self.cut[node], self.gain[node] = found.feature[i], found.cut[i], found.gain[i]
            for child, stats in ((2 * node + 1, found.left[i]), (2 * node + 2, found.right[i])):
                self.stats[child] = stats
                if level + 1 < self.shape.max_depth and self.shape.mass(stats) > 1e-12 * self.shape.scale(stats):
                    opened.append(child)
        self.open = opened

    def is_leaf(self, node: int) -> bool:
        return node >= len(self.feature) or self.feature[node] < 0

    def predictions(self) -> np.ndarray:
        if self.shape.classes:
            return self.stats.argmax(-1).astype("f8")
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1)


class Route(NamedTuple):
    """How a tree's rows reach the open nodes of a level; ``slot`` numbers them, others are -1."""

    number: int
    feature: np.ndarray
    cut: np.ndarray
    slot: np.ndarray
    nodes: list[int]


def route(tree: Tree) -> Route:
    slot = np.full(len(tree.feature), -1, np.intp)
    slot[tree.open] = np.arange(len(tree.open))
    return Route(tree.number, np.maximum(tree.feature, 0), tree.cut, slot, tree.open)


def level_sums(shape: Shape, way: Route, level: int, blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Statistics by feature, open node and bin, over blocks of bins, weights and target."""
    n, classes = len(way.nodes), shape.classes
    size = n * shape.n_bins * (classes or 1)
    sums = np.zeros((shape.n_features, 1 if classes else 3, size))
    for bins, weights, target in blocks:
        rows = np.flatnonzero(weights)
        slot = way.slot.take(descend(bins, rows, way.feature, way.cut, level))
        if slot.size and slot.min() < 0:
            inside = slot >= 0
            rows, slot = rows[inside], slot[inside]
        weight, y = weights.take(rows).astype("f8"), target.take(rows)
        if classes:
            first, values = slot * (shape.n_bins * classes) + y.astype(np.intp), [weight]
        else:
            first, values = slot * shape.n_bins, [weight, weight * y, weight * y * y]
        for f in range(shape.n_features):
            place = bins[f].take(rows).astype(np.intp)
            if classes:
                place *= classes
            place += first
            for k, value in enumerate(values):
                sums[f, k] += np.bincount(place, value, size)
    if classes:
        return sums.astype(np.int32).reshape(shape.n_features, n, shape.n_bins, classes)
    return np.moveaxis(sums.reshape(shape.n_features, 3, n, shape.n_bins), 1, -1)


class Cuts(NamedTuple):
    """Per open node its best cut (feature -1: none), gain and statistics of itself and both sides."""

    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    own: np.ndarray
    left: np.ndarray
    right: np.ndarray


def best_cuts(shape: Shape, way: Route, sums: np.ndarray) -> Cuts:
    """The cut of each node that takes most impurity away, among the columns drawn for the node."""
    left = np.cumsum(sums, axis=2)
    own = left[:1, :, -1:]
    left = left[:, :, :-1]
    right = left[:, :, -1:] + sums[:, :, -1:] - left
    n = np.maximum(shape.size(own), 1)
    gain = (shape.mass(own) - shape.mass(left) - shape.mass(right)) / n
    gain[(shape.size(left) <= 0) | (shape.size(right) <= 0)] = -np.inf
    for i, node in enumerate(way.nodes):
        order = np.random.default_rng([shape.seed, way.number, node]).permutation(shape.n_features)
        gain[order[shape.n_columns:], i] = -np.inf
    by_node = np.moveaxis(gain, 1, 0).reshape(len(way.nodes), -1)
    feature, cut = np.divmod(by_node.argmax(-1), gain.shape[-1])
    at = np.arange(len(way.nodes))
    best, own = by_node.max(-1), own[0, :, 0]
    taken = best * shape.size(own) > 1e-12 * shape.scale(own)
    return Cuts(np.where(taken, feature, -1), cut, best, own, left[feature, at, cut], right[feature, at, cut])


# --- forests ---------------------------------------------------------------------


def _columns(strategy: str, n_features: int) -> int:
    return n_features if strategy == "all" else min(n_features, ceil(float(strategy) * n_features))


def _shape(estimator, cuts: list[np.ndarray], classes: int) -> Shape:
    widest = max(map(len, cuts)) + 1
    columns = _columns(estimator.getFeatureSubsetStrategy(), len(cuts))
    # one bin more than needed keeps a cut to look at where every feature is constant
    return Shape(len(cuts), max(widest, 2), classes, estimator.getMaxDepth(), columns, estimator.getSeed())


def found_by_tree(pairs: RDD, shape: Shape, ways: dict[int, Route], tasks: int) -> list[tuple[int, Cuts]]:
    """Best cuts from ((tree, part), sums): the sums of a tree meet in one task and are added in order of the parts."""

    def cuts(sorted_pairs: Iterator) -> Iterator[tuple[int, Cuts]]:
        for number, same in groupby(sorted_pairs, lambda pair: pair[0][0]):
            total = None
            for _, sums in same:
                total = sums if total is None else total + sums
            yield number, best_cuts(shape, ways[number], total)

    return pairs.repartitionAndSortWithinPartitions(tasks, lambda key: key[0]).mapPartitions(cuts).collect()


def grow_forest(blocks: RDD, shape: Shape, n_trees: int, share: float, with_replacement: bool) -> list[Tree]:
    trees = [Tree(shape, t) for t in range(n_trees)]
    tasks = blocks.getNumPartitions()
    for level in range(shape.max_depth):
        ways = {tree.number: route(tree) for tree in trees if tree.open}
        if not ways:
            break

        def counted(held: Iterator[Block], level: int = level, ways: dict = ways) -> Iterator:
            held = list(held)
            for number, way in ways.items() if held else ():
                weighed = (
                    (b.bins, drawn(b.bins.shape[1], share, with_replacement, (shape.seed, number, b.part, b.number)), b.targets[0])
                    for b in held
                )
                yield (number, held[0].part), level_sums(shape, way, level, weighed)

        for number, found in found_by_tree(blocks.mapPartitions(counted), shape, ways, tasks):
            trees[number].add(level, found)
    return trees


def _forest(estimator, dataset: DataFrame, classes: int) -> tuple[list[Tree], list[np.ndarray]]:
    rows = dataset.select(
        vector_to_array(estimator.getFeaturesCol()).alias("x"), F.array(F.col(estimator.getLabelCol()).cast("double")).alias("y")
    )
    cuts, _ = feature_cuts(rows, estimator.getMaxBins())
    blocks = binned(rows, cuts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shape = _shape(estimator, cuts, classes)
        return grow_forest(blocks, shape, estimator.getNumTrees(), estimator.getSubsamplingRate(), estimator.getBootstrap()), cuts
    finally:
        blocks.unpersist()


def _n_classes(dataset: DataFrame, label: str) -> int:
    named = dataset.schema[label].metadata.get("ml_attr", {}).get("vals")
    return len(named) if named else int(dataset.agg(F.max(label)).first()[0]) + 1


class ForestClassifier(RandomForestClassifier):
    """A random forest classifier whose trees are grown here."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        classes = max(2, _n_classes(dataset, self.getLabelCol()))
        trees, cuts = _forest(self, dataset, classes)
        return self._copyValues(as_model(dataset.sparkSession, RandomForestClassificationModel, trees, [1.0] * len(trees), cuts, {"numClasses": classes}))


class ForestRegressor(RandomForestRegressor):
    """A random forest regressor whose trees are grown here."""

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        trees, cuts = _forest(self, dataset, 0)
        return self._copyValues(as_model(dataset.sparkSession, RandomForestRegressionModel, trees, [1.0] * len(trees), cuts))


# --- boosting --------------------------------------------------------------------


def residual(target: np.ndarray, margin: np.ndarray, is_class: bool) -> np.ndarray:
    """Negative gradient of the logistic loss over -1 and 1, or of the squared error."""
    if is_class:
        return 4 * target / (1 + np.exp(np.minimum(2 * target * margin, 700)))
    return 2 * (target - margin)


def _leaf_values(tree: Tree) -> np.ndarray:
    """Predictions of the deepest nodes; rows leave a leaf above them to the left."""
    values = tree.predictions()
    for node in range(len(tree.feature)):
        if tree.is_leaf(node):
            values[2 * node + 1] = values[2 * node + 2] = values[node]
    return values


def boosted(dataset: DataFrame, learners: Sequence[tuple[GBTClassifier | GBTRegressor, Column]]) -> list[Model]:
    """Boosted models of several targets (true or false for a classifier), grown side by side.

    The next tree of every learner comes from the same passes; the options are the first
    learner's. Margins are kept with the blocks, so a tree costs a pass per level whatever its
    number. A table that one task holds is boosted within one task, as a pass there costs less than a job.
    """
    spark, first = dataset.sparkSession, learners[0][0]
    is_class = [isinstance(learner, GBTClassifier) for learner, _ in learners]
    targets = [F.when(t, 1.0).otherwise(-1.0) if c else t.cast("double") for c, (_, t) in zip(is_class, learners)]
    rows = dataset.select(vector_to_array(first.getFeaturesCol()).alias("x"), F.array(*targets).alias("y"))
    cuts, n_rows = feature_cuts(rows, first.getMaxBins())
    boosting = Boosting(_shape(first, cuts, 0), is_class, first.getMaxIter(), first.getSubsamplingRate(), first.getStepSize())
    blocks = binned(rows, cuts).map(lambda b: b._replace(margins=np.zeros_like(b.targets)))
    if n_rows <= ROWS_OF_ONE_TASK:
        grown = blocks.coalesce(1).mapPartitions(lambda held: boosting.grow(HeldBlocks(boosting, list(held)))).collect()
    else:
        grown = list(boosting.grow(SpreadBlocks(boosting, blocks)))
    weights = [1.0] + [boosting.rate] * (len(grown) - 1)
    models = []
    for i, (learner, _) in enumerate(learners):
        kind = GBTClassificationModel if is_class[i] else GBTRegressionModel
        models.append(learner._copyValues(as_model(spark, kind, [trees[i] for trees in grown], weights, cuts)))
    return models


@dataclass(frozen=True)
class Boosting:
    shape: Shape
    #: Per learner whether it tells a class from the rest.
    is_class: list[bool]
    turns: int
    share: float
    rate: float

    def grow(self, blocks: HeldBlocks | SpreadBlocks) -> Iterator[list[Tree]]:
        """Turn by turn a tree of each learner."""
        for turn in range(self.turns):
            trees = [Tree(replace(self.shape, seed=self.shape.seed + turn), i) for i in range(len(self.is_class))]
            for level in range(self.shape.max_depth):
                ways = {tree.number: route(tree) for tree in trees if tree.open}
                if not ways:
                    break
                for i, found in blocks.found(turn, level, ways, trees[0].shape):
                    trees[i].add(level, found)
            if turn + 1 < self.turns:
                ended = [(np.maximum(t.feature, 0), t.cut, _leaf_values(t)) for t in trees]
                blocks.advance(turn, self.advancing(ended, self.rate if turn else 1.0))
            yield trees
        blocks.end()

    def advancing(self, ended: list[tuple], rate: float) -> Callable[[Block], Block]:
        """Adds to the margins what the turn's trees predict."""

        def advanced(block: Block) -> Block:
            rows = np.arange(block.bins.shape[1])
            steps = [value.take(descend(block.bins, rows, feature, cut, self.shape.max_depth)) for feature, cut, value in ended]
            return block._replace(margins=block.margins + rate * np.stack(steps))

        return advanced

    def counting(self, turn: int, level: int, ways: dict[int, Route]) -> Callable[[Iterable[Block]], Iterator]:
        def weighed(block: Block, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            weights = drawn(block.bins.shape[1], self.share, False, (self.shape.seed, turn, i, block.part, block.number))
            target = block.targets[i]
            return block.bins, weights, residual(target, block.margins[i], self.is_class[i]) if turn else target

        def counted(held: Iterable[Block]) -> Iterator:
            held = list(held)
            for i, way in ways.items() if held else ():
                yield (i, held[0].part), level_sums(self.shape, way, level, (weighed(b, i) for b in held))

        return counted


def _added(pairs: Iterable, shape: Shape, ways: dict[int, Route]) -> list[tuple[int, Cuts]]:
    totals: dict[int, np.ndarray] = {}
    for (i, _), sums in sorted(pairs, key=lambda pair: pair[0]):
        totals[i] = totals[i] + sums if i in totals else sums
    return [(i, best_cuts(shape, ways[i], total)) for i, total in totals.items()]


class HeldBlocks:
    """Blocks in the memory of one task."""

    def __init__(self, boosting: Boosting, blocks: list[Block]):
        self.boosting, self.blocks = boosting, blocks

    def found(self, turn: int, level: int, ways: dict[int, Route], shape: Shape) -> list[tuple[int, Cuts]]:
        return _added(self.boosting.counting(turn, level, ways)(self.blocks), shape, ways)

    def advance(self, turn: int, advanced: Callable[[Block], Block]) -> None:
        self.blocks = [advanced(b) for b in self.blocks]

    def end(self) -> None:
        self.blocks = []


class SpreadBlocks:
    """Blocks spread over tasks; margins of a turn are kept until those of the next are there."""

    def __init__(self, boosting: Boosting, blocks: RDD):
        self.boosting, self.blocks, self.former = boosting, blocks.persist(StorageLevel.MEMORY_AND_DISK), None

    def found(self, turn: int, level: int, ways: dict[int, Route], shape: Shape) -> list[tuple[int, Cuts]]:
        pairs = self.blocks.mapPartitions(self.boosting.counting(turn, level, ways))
        tasks = self.blocks.getNumPartitions()
        found = found_by_tree(pairs, shape, ways, len(ways)) if tasks > TASKS_ADDED_BY_DRIVER else _added(pairs.collect(), shape, ways)
        self._forget_former()
        return found

    def advance(self, turn: int, advanced: Callable[[Block], Block]) -> None:
        self._forget_former()
        self.former, self.blocks = self.blocks, self.blocks.map(advanced).persist(StorageLevel.MEMORY_AND_DISK)
        if (turn + 1) % CUT_LINEAGE_AFTER == 0:
            self.blocks.localCheckpoint()
            self.blocks.count()
            self._forget_former()

    def end(self) -> None:
        self._forget_former()
        self.blocks.unpersist()

    def _forget_former(self) -> None:
        if self.former is not None:
            self.former.unpersist()
            self.former = None


# --- models ----------------------------------------------------------------------


def _node_rows(tree: Tree, cuts: list[np.ndarray]) -> list[dict]:
    """Nodes parents first, as in the files of Spark ML; two leaves that predict the same become one."""
    shape, predictions = tree.shape, tree.predictions()
    rows: list[dict] = []

    def add(node: int) -> int:
        stats, number = tree.stats[node], len(rows)
        size = float(shape.size(stats))
        row = {
            "id": number, "prediction": float(predictions[node]), "impurity": float(shape.mass(stats)) / max(size, 1.0),
            "impurityStats": stats.tolist(), "rawCount": int(size), "gain": -1.0, "leftChild": -1, "rightChild": -1,
            "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1},
        }
        rows.append(row)
        if not tree.is_leaf(node):
            left = add(2 * node + 1)
            right = add(2 * node + 2)
            if right == left + 1 == len(rows) - 1 and rows[left]["prediction"] == rows[right]["prediction"]:
                del rows[left:]
            else:
                f = int(tree.feature[node])
                row |= {"gain": float(tree.gain[node]), "leftChild": left, "rightChild": right}
                row["split"] = {"featureIndex": f, "leftCategoriesOrThreshold": [float(cuts[f][tree.cut[node]])], "numCategories": -1}
        return number

    add(0)
    return rows


_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct(
    [
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
        ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT),
    ]
)


def as_model(spark: SparkSession, kind: type, trees: Sequence[Tree], weights: Sequence[float], cuts: list[np.ndarray], more: dict | None = None) -> Model:
    """The trees as a model of Spark ML, through the files such a model is saved in."""
    path = new_path(spark, "grown")
    package = "classification" if "Classification" in kind.__name__ else "regression"
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {}}
    one = "Classification" if trees[0].shape.classes else "Regression"
    impurity = {"impurity": "gini" if trees[0].shape.classes else "variance"}
    whole = about | {
        "class": f"org.apache.spark.ml.{package}.{kind.__name__}", "uid": path.rsplit("/", 1)[1], "paramMap": impurity,
        "numFeatures": len(cuts), "numTrees": len(trees), **(more or {}),
    }
    spark.sparkContext.parallelize([json.dumps(whole)], 1).saveAsTextFile(f"{path}/metadata")
    each = [
        json.dumps(about | {"class": f"org.apache.spark.ml.{one.lower()}.DecisionTree{one}Model", "uid": f"tree-{i}", "paramMap": impurity})
        for i in range(len(trees))
    ]
    listed = pa.table({"_1": pa.array(range(len(trees)), pa.int32()), "_2": each, "_3": pa.array(weights, pa.float64())})
    spark.createDataFrame(listed).coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, row) for i, tree in enumerate(trees) for row in _node_rows(tree, cuts)]
    table = pa.table({"treeID": pa.array([i for i, _ in nodes], pa.int32()), "nodeData": pa.array([row for _, row in nodes], _NODE)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)
