"""Boosted trees on sparse features: the model of Spark's ``GBTClassifier`` by work that grows with the entries.

Spark's learner holds and adds up every feature of every row, also where the value is zero. Here the rows are written
once in blocks that list, for each bin of each feature, the rows whose value falls there; the bin of zero is not
listed, as its sums are those of the node less the other bins. A level of a tree is one job: tasks sum their blocks into
histograms, which are added and searched by ranges of bins. The driver holds thresholds, trees and a best split per
node and range. Thresholds, splits, leaves, pruning and residuals follow ``GBTClassifier``, so the trees are the same but for
rounding and for the sample of 10,000 rows that both take thresholds from if there are more.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.vectors import sparse_entries
from reviewlens.session import stage

# Executors need not have this package: what they run goes to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block, which are numbered by 16 bits, and about how many entries it has at most.
BLOCK_ROWS = 65_536
BLOCK_ENTRIES = 8_000_000
#: Entries that are added to the histograms at a time.
SLICE_ENTRIES = 1_000_000
#: Bins of a range that one task searches.
RANGE_CELLS = 65_536
#: Bytes of the histograms of a task; nodes beyond them wait for another job.
HISTOGRAM_BYTES = 256 * 2**20
#: Bytes of binned rows, four for each feature of a row, up to which Spark's learner is the faster one.
SPARK_BYTES = 2**30
#: The rows from which thresholds are taken at least, and the impurity below which a node is pure, as in Spark.
THRESHOLD_ROWS = 10_000
EPSILON = np.finfo(float).eps


@dataclass
class Node:
    """``total`` is rows, weight, weighted sum of targets and of their squares."""

    total: np.ndarray
    level: int
    split: tuple[int, int] | None = None
    gain: float = 0.0
    children: tuple[int, int] | None = None

    @property
    def mean(self) -> float:
        return float(self.total[2] / self.total[1])

    @property
    def impurity(self) -> float:
        _, weight, first, second = self.total
        return float((second - first * first / weight) / weight)


@dataclass
class Cells:
    """Bins of all features one after the other: ``first`` has the place of a feature's first bin and, last, their number."""

    thresholds: list[np.ndarray]
    first: np.ndarray = field(init=False)
    zero: np.ndarray = field(init=False)

    def __post_init__(self):
        self.first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in self.thresholds])])
        self.zero = np.array([np.searchsorted(t, 0.0) for t in self.thresholds], np.int64)

    def ranges(self, most: int) -> list[tuple[int, int]]:
        """Neighbouring features, from one to before another, of at most ``most`` bins or a single one."""
        found, low = [], 0
        for high in range(1, len(self.thresholds) + 1):
            if high == len(self.thresholds) or self.first[high + 1] - self.first[low] > most:
                found.append((low, high))
                low = high
        return found


def suits(estimator: GBTClassifier) -> bool:
    """Whether the parameters are ones this module follows."""
    return (
        estimator.getSubsamplingRate() == 1.0
        and estimator.getFeatureSubsetStrategy() in ("all", "auto")
        and estimator.getMinWeightFractionPerNode() == 0.0
        and estimator.getMaxDepth() > 0
        and not estimator.isDefined("validationIndicatorCol")
    )


def fit_gbt(estimator: GBTClassifier, train: DataFrame) -> Model | None:
    """The fitted model, or None where Spark's own learner is to be used.

    These are: parameters, weights, labels or values this module does not follow (Spark says what is wrong with
    them), categorical features, features of which a quarter or more are not zero, and rows of ``SPARK_BYTES`` or less.
    """
    features, weight = estimator.getFeaturesCol(), estimator.getWeightCol() if estimator.isDefined("weightCol") else ""
    attributes = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if not suits(estimator) or {"binary", "nominal"} & set(attributes):
        return None
    columns = train.select(
        F.col(estimator.getLabelCol()).cast("double").alias("label"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
        F.col(features).alias("features"),
    )
    summary = _summary(columns)
    values = summary["rows"] * (summary["width"] or 0)
    if summary["unfit"] or summary["entries"] is None or summary["entries"] * 4 > values or values * 4 <= SPARK_BYTES:
        return None
    rows = sparse_entries(columns, "features", ["label", "weight"])
    cells = Cells(_thresholds(rows, summary, estimator.getMaxBins(), estimator.getSeed()))
    cores = train.sparkSession.sparkContext.defaultParallelism
    partitions = max(min(cores, math.ceil(summary["entries"] / SLICE_ENTRIES)), math.ceil(summary["rows"] / BLOCK_ROWS))
    blocks = stage(rows.repartition(partitions).mapInArrow(_packed(cells), _BLOCK), "boosting-blocks")
    trees: list[list[Node]] = []
    for _ in range(estimator.getMaxIter()):
        trees.append(_grown(blocks, cells, trees, estimator))
    _leaf_totals(blocks, cells, trees, estimator.getStepSize())
    return _spark_model(estimator, train, trees, cells, summary["width"])


def _summary(columns: DataFrame) -> dict:
    vector = F.unwrap_udt("features")
    values = vector["values"]
    unfit = (
        F.coalesce(~F.col("label").isin(0.0, 1.0), F.lit(True))
        | F.coalesce((F.col("weight") <= 0) | F.col("weight").isin(float("inf"), float("nan")), F.lit(True))
        | F.coalesce(F.exists(values, lambda v: v.isin(float("nan"), float("inf"), float("-inf"))), F.lit(True))
    )
    width = F.coalesce(vector["size"], F.size(values))
    found = columns.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("weight").alias("weight"),
        F.sum(F.size(values)).alias("entries"),
        F.max(width).alias("width"),
        (F.count_if(unfit) + F.when(F.min(width) < F.max(width), 1).otherwise(0)).alias("unfit"),
    )
    return found.toArrow().to_pylist()[0]


# --- thresholds ------------------------------------------------------------------------------------


def _thresholds(rows: DataFrame, summary: dict, max_bins: int, seed: int) -> list[np.ndarray]:
    """Ascending thresholds of every feature. At most ``max_bins - 1`` numbers a feature reach the driver."""
    share = min(1.0, max(max_bins * max_bins, THRESHOLD_ROWS) / summary["rows"])
    sample = rows if share == 1.0 else rows.sample(False, share, seed)
    entry = F.explode(F.arrays_zip("indices", "values")).alias("entry")
    entries = sample.select("weight", entry).select("weight", F.col("entry.indices").alias("feature"), F.col("entry.values").alias("value"))
    counted = entries.filter("value <> 0").groupBy("feature", "value").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    splits = min(max_bins, summary["rows"]) - 1
    parted = counted.repartition(rows.sparkSession.sparkContext.defaultParallelism, "feature")
    found = parted.mapInArrow(_feature_thresholds(share * summary["weight"], splits), "feature int, thresholds array<double>")
    thresholds = [np.empty(0)] * summary["width"]
    for row in found.toArrow().to_pylist():
        thresholds[row["feature"]] = np.array(row["thresholds"])
    return thresholds


def _feature_thresholds(weight: float, splits: int) -> Callable:
    def find(batches):
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        table = table.sort_by([("feature", "ascending"), ("value", "ascending")])
        feature, value, weights, n = (table[name].to_numpy() for name in ("feature", "value", "weight", "n"))
        starts = np.flatnonzero(np.diff(feature, prepend=-1))
        ends = [*starts[1:], len(feature)]
        found = [value_thresholds(value[a:b], weights[a:b], int(n[a:b].sum()), weight, splits) for a, b in zip(starts, ends)]
        arrays = pa.array(found, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(feature[starts], pa.int32()), arrays], names=["feature", "thresholds"])

    return find


def value_thresholds(values: np.ndarray, weights: np.ndarray, count: int, weight: float, splits: int) -> list[float]:
    """Thresholds of a feature from its distinct values but zero, as ``RandomForest.findSplitsForContinuousFeature``."""
    zeros = weight - weights.sum()
    if zeros > EPSILON * count * 100:
        place = np.searchsorted(values, 0.0)
        values, weights = np.insert(values, place, 0.0), np.insert(weights, place, zeros)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= splits:
        return middle.tolist()
    stride, found, current = weight / (splits + 1), [], weights[0]
    target = stride
    for place in range(1, len(values)):
        previous, current = current, current + weights[place]
        if abs(previous - target) < abs(current - target):
            found.append(float(middle[place - 1]))
            target += stride
    return found


# --- blocks ----------------------------------------------------------------------------------------

_BLOCK = "labels binary, weights binary, ends binary, places binary"


def _packed(cells: Cells) -> Callable:
    """Function from rows to blocks: labels, weights, and the rows of each bin, where bin ``i`` ends at ``ends[i]``."""
    first, zero, total = cells.first, cells.zero, int(cells.first[-1])
    thresholds = np.concatenate([*cells.thresholds, np.empty(1)])
    start = first[:-1] - np.arange(len(zero))
    steps = max((len(t) for t in cells.thresholds), default=0).bit_length()

    def binned(feature, value):
        """Number of the feature's thresholds below the value, by bisection of all entries at a time."""
        low, high = start[feature], start[feature] + np.diff(first)[feature] - 1
        for _ in range(steps):
            middle = (low + high) // 2
            below = (low < high) & (thresholds[middle] < value)
            low, high = np.where(below, middle + 1, low), np.where(below, high, np.minimum(middle, high))
        return low - start[feature]

    def block(held):
        import pyarrow as pa

        labels, weights, entry_cells, places = (np.concatenate(column) for column in zip(*held))
        order = np.argsort(entry_cells, kind="stable")
        ends = np.cumsum(np.bincount(entry_cells, minlength=total)).astype(np.int32)
        parts = [labels.astype(np.int8), weights, ends, places[order]]
        arrays = [pa.array([part.tobytes()], pa.binary()) for part in parts]
        return pa.RecordBatch.from_arrays(arrays, names=["labels", "weights", "ends", "places"])

    def pack(batches):
        held, rows, entries = [], 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                if held and (rows + part.num_rows > BLOCK_ROWS or entries > BLOCK_ENTRIES):
                    yield block(held)
                    held, rows, entries = [], 0, 0
                column = {name: part.column(part.schema.get_field_index(name)) for name in part.schema.names}
                sizes = column["values"].value_lengths().to_numpy(zero_copy_only=False)
                feature, value = (column[name].flatten().to_numpy(zero_copy_only=False) for name in ("indices", "values"))
                places = np.repeat(np.arange(rows, rows + part.num_rows), sizes).astype(np.uint16)
                bins = binned(feature, value)
                listed = bins != zero[feature]
                labels, weights = (column[name].to_numpy(zero_copy_only=False) for name in ("label", "weight"))
                held.append((labels, weights, (first[feature] + bins)[listed].astype(np.int32), places[listed]))
                rows, entries = rows + part.num_rows, entries + int(listed.sum())
        if held:
            yield block(held)

    return pack


# --- trees -----------------------------------------------------------------------------------------


@dataclass
class Route:
    """A tree as the tasks need it: ``(node, from bin, to bin, other child)`` by level, the child of the rest, means."""

    levels: list[list[tuple[int, int, int, int]]]
    rest: np.ndarray
    means: np.ndarray

    def leaves(self, ends: np.ndarray, places: np.ndarray, rows: int) -> np.ndarray:
        """The node that each row of a block comes to."""
        node = np.zeros(rows, np.int32)
        for level in self.levels:
            turned = []
            for parent, low, high, other in level:
                listed = places[ends[low - 1] if low else 0 : ends[high - 1] if high else 0]
                turned.append((listed[node[listed] == parent], other))
            node = self.rest[node]
            for listed, other in turned:
                node[listed] = other
        return node


def _route(tree: Sequence[Node], cells: Cells) -> Route:
    levels: list[list] = [[] for _ in range(max(node.level for node in tree))]
    rest = np.arange(len(tree), dtype=np.int32)
    for number, node in enumerate(tree):
        if node.children:
            (feature, cut), (left, right) = node.split, node.children
            middle = int(cells.first[feature] + cut + 1)
            if cells.zero[feature] <= cut:
                rest[number], turned = left, (middle, int(cells.first[feature + 1]), right)
            else:
                rest[number], turned = right, (int(cells.first[feature]), middle, left)
            levels[node.level].append((number, *turned))
    return Route(levels, rest, np.array([node.mean for node in tree]))


def _arrays(block: dict) -> tuple[np.ndarray, ...]:
    kinds = {"labels": np.int8, "weights": np.float64, "ends": np.int32, "places": np.uint16}
    labels, weights, ends, places = (np.frombuffer(block[name], kind) for name, kind in kinds.items())
    return labels * 2.0 - 1.0, weights, ends, places


def _residuals(labels: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree learns: the labels at first, then the negative gradient of the logistic loss."""
    return labels if margin is None else 4.0 * labels / (1.0 + np.exp(2.0 * labels * margin))


def _steps(routes: Sequence[Route], step: float, labels: np.ndarray, ends: np.ndarray, places: np.ndarray):
    """For each tree its targets and the leaf of each row; at last the targets of the next tree and None."""
    margin = None
    for number, route in enumerate(routes):
        leaf = route.leaves(ends, places, len(labels))
        yield _residuals(labels, margin), leaf
        margin = route.means[leaf] if margin is None else margin + step * route.means[leaf]
    yield _residuals(labels, margin), None


def _totals(weights: np.ndarray, targets: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Rows, weight, weighted sum of targets and of their squares by group."""
    sums = [weights, weights * targets, weights * targets * targets]
    return np.array([np.bincount(group, s, groups) for s in (None, *sums)])


def _grown(blocks: DataFrame, cells: Cells, trees: Sequence[Sequence[Node]], estimator: GBTClassifier) -> list[Node]:
    """The next tree, level by level."""
    routes = [_route(tree, cells) for tree in trees]
    tree = [Node(np.ones(4), 0)]
    at_once = max(1, HISTOGRAM_BYTES // (24 * int(cells.first[-1])))
    for level in range(estimator.getMaxDepth()):
        open_nodes = [number for number, node in enumerate(tree) if node.level == level]
        for low in range(0, len(open_nodes), at_once):
            _split(blocks, cells, routes, tree, open_nodes[low : low + at_once], estimator)
    return tree


def _split(blocks: DataFrame, cells: Cells, routes: Sequence[Route], tree: list[Node], open_nodes: Sequence[int], estimator) -> None:
    """Gives each of the ``open_nodes`` its best split and its children, if it has a split."""
    ranges = cells.ranges(RANGE_CELLS)
    histograms = _histograms(cells, routes, _route(tree, cells), open_nodes, ranges, estimator.getStepSize())
    search = _best_split(cells, ranges, estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
    schema = "node int, part int, feature int, cut int, gain double, left binary, total binary"
    sums = blocks.mapInArrow(histograms, "node int, part int, filled binary, sums binary, total binary")
    tasks = min(len(open_nodes) * len(ranges), blocks.sparkSession.sparkContext.defaultParallelism)
    found = sums.repartition(tasks, "node", "part").groupBy("node", "part").applyInArrow(search, schema)
    best: dict[int, dict] = {}
    for row in sorted(found.toArrow().to_pylist(), key=lambda r: (r["node"], -r["gain"], r["part"])):
        best.setdefault(row["node"], row)
    for number in open_nodes:
        node, row = tree[number], best[number]
        node.total = np.frombuffer(row["total"])
        if not row["gain"] > 0 or abs(node.impurity) < EPSILON:
            continue
        left = np.frombuffer(row["left"])
        node.split, node.gain, node.children = (row["feature"], row["cut"]), row["gain"], (len(tree), len(tree) + 1)
        tree += [Node(total, node.level + 1) for total in (left, node.total - left)]


def _histograms(
    cells: Cells, routes: Sequence[Route], growing: Route, open_nodes: Sequence[int], ranges: Sequence[tuple[int, int]], step: float
) -> Callable:
    """Function from blocks to the sums of a task: of the node, and of the range's bins that are filled."""
    bins, slots = int(cells.first[-1]), len(open_nodes)
    slot_of = np.full(len(growing.rest), slots)
    slot_of[list(open_nodes)] = np.arange(slots)
    first = cells.first

    def add(sums, ends, places, weights, targets, slot):
        """``sums`` has rows, weighted targets and, if not all are one, weights, by bin and slot."""
        width, low = slots + 1, 0
        columns = [None, weights * targets, weights][: len(sums)]
        while low < bins:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + SLICE_ENTRIES, "right")))
            listed = places[before : ends[high - 1]]
            cell = np.repeat(np.arange(high - low), np.diff(ends[low:high], prepend=before))
            place = cell * width + slot[listed]
            for total, column in zip(sums, columns):
                counted = np.bincount(place, None if column is None else column[listed], (high - low) * width)
                total[low:high] += counted.reshape(-1, width)[:, :slots]
            low = high

    def histograms(batches):
        import pyarrow as pa

        totals, sums = np.zeros((4, slots)), None
        for batch in batches:
            for row in range(batch.num_rows):
                labels, weights, ends, places = _arrays(batch.slice(row, 1).to_pylist()[0])
                *_, (targets, _) = _steps(routes, step, labels, ends, places)
                slot = slot_of[growing.leaves(ends, places, len(labels))]
                totals += _totals(weights, targets, slot, slots + 1)[:, :slots]
                if sums is None:
                    sums = np.zeros((2, bins, slots))
                if len(sums) == 2 and not (weights == 1.0).all():
                    sums = np.concatenate([sums, sums[:1]])
                add(sums, ends, places, weights, targets, slot)
        if sums is None:
            return
        for part, (low, high) in enumerate(ranges):
            for s, node in enumerate(open_nodes):
                own = sums[:, first[low] : first[high], s]
                filled = np.flatnonzero(own[0])
                data = [filled.astype(np.int32).tobytes(), own[:, filled].tobytes(), totals[:, s].tobytes()]
                columns = [pa.array([n], pa.int32()) for n in (node, part)] + [pa.array([d], pa.binary()) for d in data]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "part", "filled", "sums", "total"])

    return histograms


def _best_split(cells: Cells, ranges: Sequence[tuple[int, int]], least_rows: int, least_gain: float) -> Callable:
    """Function from the sums of a node and range to its best split; of equal gains the first counts."""
    first, zero = cells.first, cells.zero

    def search(key, table):
        import pyarrow as pa

        node, part = (k.as_py() for k in key)
        low, high = ranges[part]
        starts, bins = first[low:high] - first[low], np.diff(first[low : high + 1])
        # Rows, weighted targets and weights, by bin and of the node.
        sums, total = np.zeros((3, bins.sum())), np.zeros(4)
        for one in table.to_pylist():
            filled, values = np.frombuffer(one["filled"], np.int32), np.frombuffer(one["sums"])
            total += np.frombuffer(one["total"])
            values = values.reshape(-1, len(filled)) if len(filled) else np.zeros((3, 0))
            sums[:, filled] += values[[0, 1, len(values) - 1 if len(values) > 2 else 0]]
        whole = total[[0, 2, 1]][:, None]
        sums[:, starts + zero[low:high]] = whole - np.add.reduceat(sums, starts, axis=1)
        # Sums up to each bin, bin by bin of all features that have it.
        order = np.argsort(-bins, kind="stable")
        for place in range(1, bins.max()):
            there = starts[order[: np.searchsorted(-bins[order], -place, "left")]] + place
            sums[:, there] += sums[:, there - 1]
        rest = whole - sums
        allowed = (sums[0] >= max(least_rows, 1)) & (rest[0] >= max(least_rows, 1))
        allowed[starts + bins - 1] = False
        with np.errstate(divide="ignore", invalid="ignore"):
            squares = sums[1] ** 2 / sums[2] + rest[1] ** 2 / rest[2] - total[2] ** 2 / total[1]
        gain = np.where(allowed, squares / total[1], -np.inf)
        gain[gain < least_gain] = -np.inf
        best = int(gain.argmax())
        feature = int(np.searchsorted(starts, best, "right")) - 1
        row = {
            "node": node,
            "part": part,
            "feature": low + feature,
            "cut": best - int(starts[feature]),
            "gain": float(gain[best]),
            "left": np.array([*sums[[0, 2, 1], best], 0.0]).tobytes(),
            "total": total.tobytes(),
        }
        types = [pa.int32()] * 4 + [pa.float64()] + [pa.binary()] * 2
        return pa.table([pa.array([value], kind) for value, kind in zip(row.values(), types)], names=list(row))

    return search


def _leaf_totals(blocks: DataFrame, cells: Cells, trees: Sequence[Sequence[Node]], step: float) -> None:
    """Completes the totals of the leaves, of which a split tells all but the squares."""
    routes = [_route(tree, cells) for tree in trees]

    def totals(batches):
        import pyarrow as pa

        sums = [np.zeros((4, len(route.rest))) for route in routes]
        for batch in batches:
            for row in range(batch.num_rows):
                labels, weights, ends, places = _arrays(batch.slice(row, 1).to_pylist()[0])
                for total, (targets, leaf) in zip(sums, _steps(routes, step, labels, ends, places)):
                    total += _totals(weights, targets, leaf, total.shape[1])
        for number, total in enumerate(sums):
            nodes = total.shape[1]
            columns = [pa.array([number] * nodes, pa.int32()), pa.array(range(nodes), pa.int32()), *(pa.array(t) for t in total)]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "node", "a", "b", "c", "d"])

    found = blocks.mapInArrow(totals, "tree int, node int, a double, b double, c double, d double")
    added = found.groupBy("tree", "node").agg(*(F.sum(name).alias(name) for name in "abcd"))
    for row in added.toArrow().to_pylist():
        node = trees[row["tree"]][row["node"]]
        if not node.children:
            node.total = np.array([row[name] for name in "abcd"])


# --- Spark's model ---------------------------------------------------------------------------------


def _spark_model(estimator: GBTClassifier, train: DataFrame, trees: Sequence[Sequence[Node]], cells: Cells, width: int) -> Model:
    """The trees as Spark's own model, which scores, prints and saves them."""
    context = train.sparkSession.sparkContext
    jvm, gateway = context._jvm, context._gateway
    ml, parts = jvm.org.apache.spark.ml, jvm.org.apache.spark.ml.tree

    def array(kind, values):
        made = gateway.new_array(kind, len(values))
        for place, value in enumerate(values):
            made[place] = value
        return made

    def leaf(mean, impurity, calculator):
        return (mean, None), parts.LeafNode(mean, impurity, calculator)

    def node(tree, number):
        """``((mean, split), node)``; equal leaves are one."""
        own = tree[number]
        rows, weight, first, second = map(float, own.total)
        calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(array(jvm.double, [weight, first, second]), int(rows))
        if not own.children:
            return leaf(own.mean, own.impurity, calculator)
        (left, left_node), (right, right_node) = (node(tree, child) for child in own.children)
        if left[1] is None and right[1] is None and left[0] == right[0]:
            return leaf(left[0], own.impurity, calculator)
        feature, cut = own.split
        split = parts.ContinuousSplit(feature, float(cells.thresholds[feature][cut]))
        return (own.mean, split), parts.InternalNode(own.mean, own.impurity, float(own.gain), left_node, right_node, split, calculator)

    regression, identify = ml.regression.DecisionTreeRegressionModel, ml.util.Identifiable
    fitted = [regression(identify.randomUID("dtr"), node(tree, 0)[1], width) for tree in trees]
    weights = [1.0] + [float(estimator.getStepSize())] * (len(trees) - 1)
    estimator._transfer_params_to_java()
    learner = estimator._java_obj
    made = ml.classification.GBTClassificationModel(
        learner.uid(), array(regression, fitted), array(jvm.double, weights), width, 2
    )
    learner.copyValues(made.setParent(learner), ml.param.ParamMap())
    return estimator._copyValues(estimator._create_model(made))
