"""Second-order boosted trees for a 0/1 target, grown level by level on Spark.

Rows are stored once as blocks of bin numbers. For each level of a tree the blocks add up their
gradients and hessians per node, feature and bin; one shuffle brings the sums of a feature
together, where its best split of every node is found, and the driver picks the best feature.
What reaches the driver is one row for each node and feature.

* A number goes left below a cut point. Cut points are exact quantiles, or all values where
  there are no more than bins.
* Categories are ordered by gradient over hessian in each node and split as two sets.
* Missing numbers (null, NaN), null categories, and categories that a node has not met take the
  side that was better for the missing rows of the training data, right where it makes no
  difference.
* Leaf weights are Newton steps with an L2 penalty, kept within ``max_delta_step``; a side needs
  ``min_child_weight`` of hessian, a split a gain above ``gamma``.

Sums are taken over whole numbers (gradients times a power of two), so they do not depend on the
order of rows, tasks or retries, and training twice gives the same trees. Nothing is drawn at
random.
"""

from __future__ import annotations

import base64
import json
import math
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from parcelflow.operators.prefix import global_rank
from parcelflow.plans.metrics import predicted_class
from parcelflow.schemas import CATEGORICAL_INPUTS, NUMERIC_INPUTS
from parcelflow.session import checkpoint_folder, materialize

# Functions that run in tasks travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block; block sums stay exact in a double.
BLOCK_ROWS = 4096
#: Most binary places of a gradient.
PLACES = 40
#: After so many trees the blocks are written again with their margins.
REFRESH = 10
#: A split has to gain more than rounding.
LEAST_GAIN = 1e-6
#: Marks of a column between which its values are counted, and rows they are taken from.
MARKS = 4096
MARK_ROWS = 200_000
#: Categories of a column that are sent to every task.
FEW_CATEGORIES = 200_000


@dataclass(frozen=True)
class NewtonConfig:
    """``ratio`` weighs positive rows; ``base_score`` is the weighted share of positives unless
    given. ``random_state`` is recorded with a run and changes nothing."""

    learning_rate: float = 0.1
    n_estimators: int = 100
    max_depth: int = 3
    random_state: int = 42
    gamma: float = 0.0
    min_child_weight: float = 10.0
    max_delta_step: float = 1.0
    ratio: float = 1.0
    reg_lambda: float = 1.0
    max_bins: int = 256
    threshold: float = 0.5
    base_score: float | None = None


@dataclass
class Node:
    """A split, or a leaf where ``feature`` is negative. ``cut`` numbers the cut point; the
    sets hold codes of categories."""

    gradient: float
    hessian: float
    feature: int = -1
    cut: int = -1
    default_left: bool = False
    gain: float = 0.0
    children: tuple[int, int] = (-1, -1)
    left_set: np.ndarray | None = None
    right_set: np.ndarray | None = None
    weight: float = 0.0


@dataclass(frozen=True)
class Layout:
    """Cut points of the numbers and how many categories each category column has."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    sizes: tuple[int, ...]

    def bins(self, feature: int) -> int:
        n = len(self.numbers)
        return len(self.cuts[feature]) + 1 if feature < n else self.sizes[feature - n]

    @property
    def features(self) -> int:
        return len(self.numbers) + len(self.categories)

    def name(self, feature: int) -> str:
        return (*self.numbers, *self.categories)[feature]


def _score(gradient, hessian, config: NewtonConfig):
    """Optimal step and what it gains."""
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.where(hessian > 0, -gradient / (hessian + config.reg_lambda), 0.0)
    if config.max_delta_step > 0:
        step = np.clip(step, -config.max_delta_step, config.max_delta_step)
    return step, -(2 * gradient * step + (hessian + config.reg_lambda) * step**2)


def _best_split(sums: np.ndarray, scale: float, ordered: bool, config: NewtonConfig):
    """Best split of one node by one feature, or None. ``sums``: gradient and hessian of every
    bin as whole numbers, the last row for missing values. Where bins are not ``ordered`` they
    are categories."""
    total = sums.sum(axis=0)
    order = np.arange(len(sums) - 1)
    if not ordered:
        order = np.flatnonzero(sums[:-1, 1] > 0)
        ratio = sums[order, 0] / scale / (sums[order, 1] / scale + config.reg_lambda)
        order = order[np.lexsort((order, ratio))]
    below = np.cumsum(sums[order], axis=0)[:-1]
    if not len(below):
        return None
    _, whole = _score(total[0] / scale, total[1] / scale, config)
    best = None
    for missing_left in (False, True):
        left = below + sums[-1] if missing_left else below
        right = total - left
        _, of_left = _score(left[:, 0] / scale, left[:, 1] / scale, config)
        _, of_right = _score(right[:, 0] / scale, right[:, 1] / scale, config)
        gain = of_left + of_right - whole
        enough = max(config.min_child_weight * scale, 1)
        gain[(left[:, 1] < enough) | (right[:, 1] < enough)] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > max(config.gamma, LEAST_GAIN) and (best is None or gain[at] > best[0]):
            best = float(gain[at]), at, missing_left, left[at], right[at], order
        if not sums[-1, 1]:
            break
    return best


def _margins(trees: list[list[Node]], layout: Layout, codes: list[np.ndarray]) -> Iterator[np.ndarray]:
    """What each tree adds to the rows whose bins are ``codes``."""
    for tree in trees:
        weights = np.array([node.weight for node in tree])
        yield weights[_places(tree, layout, codes)]


def _places(tree: list[Node], layout: Layout, codes: list[np.ndarray]) -> np.ndarray:
    """The node of ``tree`` that every row has come to."""
    at = np.zeros(len(codes[0]), np.int32)
    for number, node in enumerate(tree):
        if node.feature < 0:
            continue
        rows = np.flatnonzero(at == number)
        own = codes[node.feature][rows]
        if node.left_set is None:
            left = (own <= node.cut) & (own >= 0)
            known = own >= 0
        else:
            left = np.isin(own, node.left_set)
            known = left | np.isin(own, node.right_set)
        left |= ~known & node.default_left
        at[rows] = np.where(left, *node.children)
    return at


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


# --- blocks of rows --------------------------------------------------------------

_BLOCKS = "numbers binary, categories binary, target binary, margin binary"


def _codes(row, layout: Layout) -> list[np.ndarray]:
    """Bins of every feature; -1 is missing."""
    n = len(row[2])
    numbers = np.frombuffer(row[0], "<i2").reshape(len(layout.numbers), n)
    categories = np.frombuffer(row[1], "<i4").reshape(len(layout.categories), n)
    return [*numbers, *categories]


def _binned(batch: pa.RecordBatch, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the numbers, and codes of the categories, feature by feature."""
    n = batch.num_rows
    numbers = np.empty((len(layout.numbers), n), "<i2")
    for i, (name, cuts) in enumerate(zip(layout.numbers, layout.cuts)):
        values = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
        bins = np.searchsorted(np.array(cuts), values, "right")
        numbers[i] = np.where(np.isnan(values), -1, bins)
    categories = np.empty((len(layout.categories), n), "<i4")
    for i, name in enumerate(layout.categories):
        categories[i] = batch.column(f"{name}_code").fill_null(-1).to_numpy(zero_copy_only=False)
    return numbers, categories


def _to_blocks(layout: Layout, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(begin, BLOCK_ROWS)
                numbers, categories = _binned(own, layout)
                target = own.column("target").to_numpy(zero_copy_only=False).astype("i1")
                start = np.full(own.num_rows, margin)
                cells = (numbers, categories, target, start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in cells],
                    names=["numbers", "categories", "target", "margin"],
                )

    return run


def _refreshed(layout: Layout, trees: list[list[Node]]):
    """Blocks with the margins of more trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                codes = _codes(row, layout)
                margin = np.frombuffer(row[3]).copy()
                for more in _margins(trees, layout, codes):
                    margin += more
                margins.append(margin.tobytes())
            columns = [*batch.columns[:3], pa.array(margins, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


_SUMS = "feature int, keys binary, gradients binary, hessians binary"


def _sums(layout: Layout, done: list[list[Node]], tree: list[Node], open_nodes: list[int],
          scale: float, ratio: float):
    """Gradient and hessian per open node, feature and bin, added up over a task's blocks."""
    k = len(open_nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(len(tree), -1)
        slot[open_nodes] = np.arange(k)
        totals = [np.zeros((2, k * (layout.bins(f) + 1)), np.int64) for f in range(layout.features)]
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                codes = _codes(row, layout)
                margin = np.frombuffer(row[3]).copy()
                for more in _margins(done, layout, codes):
                    margin += more
                target = np.frombuffer(row[2], "i1")
                p = _sigmoid(margin)
                weight = np.where(target == 1, ratio, 1.0) * scale
                g = np.rint((p - target) * weight)
                h = np.rint(p * (1 - p) * weight)
                node = slot[_places(tree, layout, codes)]
                rows = np.flatnonzero(node >= 0)
                if not len(rows):
                    continue
                node, g, h = node[rows], g[rows], h[rows]
                for f, total in enumerate(totals):
                    bins = layout.bins(f)
                    own = codes[f][rows]
                    key = node * (bins + 1) + np.where(own < 0, bins, own)
                    used = total.shape[1]
                    if used <= 4 * BLOCK_ROWS:
                        total[0] += np.bincount(key, g, used).astype(np.int64)
                        total[1] += np.bincount(key, h, used).astype(np.int64)
                    else:
                        np.add.at(total[0], key, g.astype(np.int64))
                        np.add.at(total[1], key, h.astype(np.int64))
        rows = []
        for f, total in enumerate(totals):
            keys = np.flatnonzero(total[0] | total[1])
            if len(keys):
                rows.append((f, keys.astype("<i8").tobytes(), *[t[keys].tobytes() for t in total]))
        if rows:
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
                names=["feature", "keys", "gradients", "hessians"],
            )

    return run


_SPLITS = (
    "feature int, slot int, gain double, cut int, default_left boolean, sums array<double>,"
    " left_set binary, right_set binary"
)


def _splits(layout: Layout, k: int, scale: float, config: NewtonConfig):
    """Best split of every open node by each feature; a row without gain tells the node's sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for feature, keys, *parts in zip(*[c.to_pylist() for c in batch.columns]):
                if feature not in totals:
                    totals[feature] = np.zeros((2, k * (layout.bins(feature) + 1)), np.int64)
                keys = np.frombuffer(keys, "<i8")
                for total, part in zip(totals[feature], parts):
                    total[keys] += np.frombuffer(part, np.int64)
        rows = []
        for feature, total in totals.items():
            sums = total.reshape(2, k, -1)
            for slot in range(k):
                own = sums[:, slot].T
                whole = (own.sum(axis=0) / scale).tolist()
                ordered = feature < len(layout.numbers)
                best = _best_split(own, scale, ordered, config)
                if best is None:
                    rows.append((feature, slot, None, None, None, whole, None, None))
                    continue
                gain, at, missing_left, left, right, order = best
                sides = [None, None]
                if not ordered:
                    sides = [np.sort(x).astype("<i4").tobytes() for x in (order[: at + 1], order[at + 1 :])]
                numbers = [*whole, *(left / scale).tolist(), *(right / scale).tolist()]
                rows.append((feature, slot, gain, at, missing_left, numbers, *sides))
        if rows:
            schema = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(),
                      pa.list_(pa.float64()), pa.binary(), pa.binary()]
            names = ["feature", "slot", "gain", "cut", "default_left", "sums", "left_set", "right_set"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), schema)], names=names
            )

    return run


def _level(blocks: DataFrame, layout: Layout, done, tree, open_nodes, scale, config) -> list:
    """One row for each open node and feature."""
    sums = blocks.mapInArrow(_sums(layout, done, tree, open_nodes, scale, config.ratio), _SUMS)
    tasks = min(layout.features, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (
        sums.repartition(tasks, "feature")
        .mapInArrow(_splits(layout, len(open_nodes), scale, config), _SPLITS)
        .collect()
    )


def _grown(blocks: DataFrame, layout: Layout, done, scale: float, config: NewtonConfig) -> list[Node]:
    """One more tree."""
    tree, open_nodes = [Node(0.0, 0.0)], [0]
    for depth in range(max(config.max_depth, 1)):
        rows = _level(blocks, layout, done, tree, open_nodes, scale, config)
        grown = []
        for slot, number in enumerate(open_nodes):
            own = [r for r in rows if r["slot"] == slot]
            if not own:
                continue
            node = tree[number]
            node.gradient, node.hessian = own[0]["sums"][:2]
            own = [r for r in own if r["gain"] is not None]
            if not own or not config.max_depth:
                continue
            best = min(own, key=lambda r: (-r["gain"], r["feature"]))
            node.feature, node.cut, node.gain = best["feature"], best["cut"], best["gain"]
            node.default_left = best["default_left"]
            if best["left_set"] is not None:
                node.left_set = np.frombuffer(best["left_set"], "<i4")
                node.right_set = np.frombuffer(best["right_set"], "<i4")
            node.children = (len(tree), len(tree) + 1)
            grown += node.children
            tree += [Node(*best["sums"][2:4]), Node(*best["sums"][4:6])]
        open_nodes = grown
        if not open_nodes:
            break
    for node in tree:
        step, _ = _score(np.float64(node.gradient), np.float64(node.hessian), config)
        node.weight = float(step) * config.learning_rate if node.feature < 0 else 0.0
    return tree


# --- cut points and categories ---------------------------------------------------


def cut_points(
    rows: DataFrame, columns: Sequence[str], bins: int, n: int | None = None
) -> dict[str, list[float]]:
    """Where each column is cut: all values but the least where there are no more than ``bins``,
    else the first value of every ``bins``-th part of the rows. Null and NaN don't count.

    Every row is counted at or between marks, values of a sample of the ``n`` rows. Only values
    between two marks where a part may begin are then counted one by one, so the cut points are
    exact whatever the sample holds.
    """
    if not columns:
        return {}
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in columns])
    marks = _marks(rows, columns, rows.count() if n is None else n)
    counted = rows.mapInArrow(_slot_counts(columns, marks), "name int, slot int, n long")
    sizes = [np.zeros(2 * len(m) + 1, np.int64) for m in marks]
    for r in counted.groupBy("name", "slot").agg(F.sum("n").alias("n")).collect():
        sizes[r["name"]][r["slot"]] = r["n"]
    open_slots, unsure, looked = [], [], []
    for name, own in enumerate(sizes):
        before, total = np.cumsum(own) - own, int(own.sum())
        unsure.append(np.count_nonzero(own[1::2]) <= bins)
        is_open, part = np.zeros(len(own), bool), -1
        for slot in np.flatnonzero(own).tolist():
            last = (int(before[slot]) + int(own[slot]) - 1) * bins // total
            if slot % 2 == 0 and (unsure[name] or last > part):
                is_open[slot] = True
                looked.append((name, slot, int(before[slot]), total, bool(unsure[name])))
            part = int(before[slot]) * bins // total
        open_slots.append(is_open)
    # Values at which a part begins, with the rows before them.
    starts: list[list[tuple[float, int]]] = []
    for own, at in zip(sizes, marks):
        before = np.cumsum(own) - own
        starts.append([(float(v), int(before[2 * i + 1])) for i, v in enumerate(at) if own[2 * i + 1]])
    if looked:
        for r in _looked_into(rows, columns, marks, open_slots, looked, bins).collect():
            starts[r["name"]].append((r["value"], r["n_before"]))
    found: dict[str, list[float]] = {}
    for name, column in enumerate(columns):
        places, total = sorted(starts[name]), int(sizes[name].sum())
        if not (unsure[name] and len(places) <= bins):
            places = [(v, n_before * bins // total) for v, n_before in places]
            places = [x for before, x in zip([(0.0, -1), *places], places) if x[1] > before[1]]
        found[column] = [v for v, _ in places][1:]
    return found


def _marks(rows: DataFrame, columns: Sequence[str], n: int) -> list[np.ndarray]:
    """Values of a sample, evenly spaced by rank, of each column."""
    sample = rows.sample(min(1.0, MARK_ROWS / max(n, 1)), seed=0)
    pairs = [F.struct(F.lit(i).alias("name"), F.col(c).alias("value")) for i, c in enumerate(columns)]
    values = sample.select(F.inline(F.array(*pairs))).where("value IS NOT NULL AND NOT isnan(value)")
    # A buffer holds a column of the sample.
    held = values.groupBy("name").agg(
        F.sort_array(F.collect_list(F.col("value") + F.lit(0.0))).alias("held")
    )
    spaced = F.transform(
        F.sequence(F.lit(0), F.lit(MARKS)),
        lambda i: F.get("held", ((F.size("held") - 1) * (i / F.lit(MARKS))).cast("int")),
    )
    marks = [np.array([])] * len(columns)
    for r in held.select("name", F.array_distinct(spaced).alias("marks")).collect():
        marks[r["name"]] = np.array(r["marks"])
    return marks


def _slots(values: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a column, and for each one twice the number of marks below it, one more for a
    number that is a mark."""
    values = values.to_numpy(zero_copy_only=False).astype(float)
    # -0.0 and 0.0 are one value.
    values = values[~np.isnan(values)] + 0.0
    below = np.searchsorted(marks, values, "left")
    return values, 2 * below + (np.append(marks, np.nan)[below] == values)


def _slot_counts(columns: Sequence[str], marks: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(2 * len(m) + 1, np.int64) for m in marks]
        for batch in batches:
            for column, own, total in zip(columns, marks, totals):
                total += np.bincount(_slots(batch.column(column), own)[1], minlength=len(total))
        for name, total in enumerate(totals):
            slots = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots), name, np.int32)), pa.array(slots.astype(np.int32)),
                 pa.array(total[slots])],
                names=["name", "slot", "n"],
            )

    return run


def _open_values(
    columns: Sequence[str], marks: list[np.ndarray], open_slots: list[np.ndarray], used: list[int]
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in used:
                values, slots = _slots(batch.column(columns[name]), marks[name])
                wanted = open_slots[name][slots]
                values, slots = values[wanted], slots[wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), name, np.int32)), pa.array(slots.astype(np.int32)),
                     pa.array(values)],
                    names=["name", "slot", "value"],
                )

    return run


def _looked_into(rows, columns, marks, open_slots, looked, bins: int) -> DataFrame:
    """``name, value, n_before``: where a part begins inside a slot, or the first ``bins`` and one
    values of slots of columns that may have no more."""
    used = sorted({name for name, *_ in looked})
    values = rows.select(*[columns[name] for name in used]).mapInArrow(
        _open_values(columns, marks, open_slots, used), "name int, slot int, value double"
    )
    counts = values.groupBy("name", "slot", "value").agg(F.count("*").alias("n"))
    slots = rows.sparkSession.createDataFrame(
        looked, "name int, slot int, before long, total long, unsure boolean"
    )
    # The rows between two marks: about one in ``MARKS``.
    here = W.partitionBy("name", "slot").orderBy("value")
    placed = (
        counts.join(F.broadcast(slots), ["name", "slot"])
        .withColumn("n_before", F.col("before") + F.sum("n").over(here) - F.col("n"))
        .withColumn("part", F.expr(f"n_before * {bins} div total"))
        .select(
            "name", "value", "n_before", "unsure", "part",
            F.lag("part").over(here).alias("last_part"), F.row_number().over(here).alias("place"),
        )
    )
    begins = F.col("last_part").isNull() | (F.col("part") > F.col("last_part"))
    return placed.where(begins | (F.col("unsure") & (F.col("place") <= bins + 1))).select(
        "name", "value", "n_before"
    )


def category_codes(rows: DataFrame, column: str) -> DataFrame:
    """``column`` and ``<column>_code``: a number from 0 for every category, in their order."""
    return materialize(
        global_rank(rows.where(F.col(column).isNotNull()).select(column).distinct(), [column], "code")
        .select(column, F.col("code").cast("int").alias(f"{column}_code"))
    )


def _coded(rows: DataFrame, codes: dict[str, DataFrame], sizes: Sequence[int]) -> DataFrame:
    for (column, table), size in zip(codes.items(), sizes):
        # A shuffle by a column of few categories would send the rows of each to one task.
        rows = rows.join(F.broadcast(table) if size <= FEW_CATEGORIES else table, column, "left")
    return rows


def _prepared(train: DataFrame, config: NewtonConfig, numbers, categories):
    """Cut points, starting margin, categories, blocks of rows, and what gradients are
    multiplied by."""
    spark = train.sparkSession
    inputs = [F.col(c).cast("double").alias(c) for c in numbers]
    inputs += [F.col(c).cast("string").alias(c) for c in categories]
    known = F.col("target").cast("int").alias("target")
    rows = materialize(train.where(F.col("target").isNotNull()).select(*inputs, known))
    counted = rows.agg(F.count("target").alias("n"), F.sum("target").alias("positives")).first()
    n, positives = counted["n"], counted["positives"] or 0
    if not n:
        raise ValueError("There are no rows to learn from.")
    share = config.base_score
    if share is None:
        share = positives * config.ratio / (positives * config.ratio + n - positives)
        share = min(max(share, 1e-7), 1 - 1e-7)
    base = math.log(share / (1 - share))
    cuts = cut_points(rows, numbers, config.max_bins, n)
    codes = {c: category_codes(rows, c) for c in categories}
    layout = Layout(
        tuple(numbers),
        tuple(categories),
        tuple(tuple(cuts[c]) for c in numbers),
        tuple(t.count() for t in codes.values()),
    )
    # Whole numbers must hold the sum over all rows.
    largest = math.ceil(n * max(config.ratio, 1.0))
    scale = float(2 ** min(PLACES, 62 - largest.bit_length()))
    blocks = _stored(_coded(rows, codes, layout.sizes).mapInArrow(_to_blocks(layout, base), _BLOCKS), spark)
    return layout, base, codes, blocks, scale


def first_splits(
    train: DataFrame,
    config: NewtonConfig = NewtonConfig(),
    numbers: Sequence[str] = tuple(NUMERIC_INPUTS),
    categories: Sequence[str] = tuple(CATEGORICAL_INPUTS),
) -> DataFrame:
    """``feature, gain``: what the best first split by each feature gains, for features that
    have one. The first tree splits by the largest."""
    layout, _, _, blocks, scale = _prepared(train, config, numbers, categories)
    found = _level(blocks, layout, [], [Node(0.0, 0.0)], [0], scale, config)
    rows = [(layout.name(r["feature"]), r["gain"]) for r in found if r["gain"] is not None]
    return train.sparkSession.createDataFrame(rows, "feature string, gain double")


@dataclass
class NewtonModel:
    """Trees over numbers and categories; predicts for any rows with the same columns."""

    config: NewtonConfig
    layout: Layout
    base_margin: float
    codes: dict[str, DataFrame]
    trees: list[list[Node]] = field(default_factory=list)

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        config: NewtonConfig = NewtonConfig(),
        numbers: Sequence[str] = tuple(NUMERIC_INPUTS),
        categories: Sequence[str] = tuple(CATEGORICAL_INPUTS),
    ) -> NewtonModel:
        """Train on rows with the inputs and a ``target`` of 0 or 1."""
        spark = train.sparkSession
        layout, base, codes, blocks, scale = _prepared(train, config, numbers, categories)
        model = cls(config, layout, base, codes)
        fresh: list[list[Node]] = []
        for _ in range(config.n_estimators):
            tree = _grown(blocks, layout, fresh, scale, config)
            model.trees.append(tree)
            fresh = [*fresh, tree]
            if len(fresh) == REFRESH:
                blocks = _stored(blocks.mapInArrow(_refreshed(layout, fresh), _BLOCKS), spark)
                fresh = []
        return model

    def _scored(self, rows: DataFrame) -> DataFrame:
        inputs = [F.col(c).cast("double").alias(c) for c in self.layout.numbers]
        texts = [F.col(c).cast("string").alias(c) for c in self.layout.categories]
        kept = F.struct(*rows.columns).alias("_row")
        return _coded(rows.select(kept, *inputs, *texts), self.codes, self.layout.sizes).select(
            "_row", *self.layout.numbers, *[f"{c}_code" for c in self.layout.categories]
        )

    def predict(self, rows: DataFrame, keep: tuple[str, ...] = ("order_id",)) -> DataFrame:
        """``keep`` columns with ``probability`` and the ``predicted`` class."""
        layout, trees, base = self.layout, self.trees, self.base_margin

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers, categories = _binned(batch, layout)
                margin = np.full(batch.num_rows, base)
                for more in _margins(trees, layout, [*numbers, *categories]):
                    margin += more
                columns = [batch.column("_row"), pa.array(_sigmoid(margin))]
                yield pa.RecordBatch.from_arrays(columns, names=["_row", "probability"])

        coded = self._scored(rows)
        schema = T.StructType([coded.schema["_row"], T.StructField("probability", T.DoubleType())])
        scored = coded.mapInArrow(run, schema)
        return scored.select(*[F.col(f"_row.{c}").alias(c) for c in keep], "probability").withColumn(
            "predicted", predicted_class(self.config.threshold)
        )

    def evaluation_curve(self, rows: DataFrame) -> DataFrame:
        """``tree, loss``: log loss on rows with a ``target`` after each tree (0: before the
        first), all from one pass; training never stops early."""
        layout, trees, base = self.layout, self.trees, self.base_margin

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, n = np.zeros(len(trees) + 1), 0
            eps = np.finfo(float).eps
            for batch in batches:
                numbers, categories = _binned(batch, layout)
                positive = batch.column("target").to_numpy(zero_copy_only=False) == 1
                margin = np.full(batch.num_rows, base)
                added = _margins(trees, layout, [*numbers, *categories])
                n += batch.num_rows
                for i in range(len(trees) + 1):
                    if i:
                        margin += next(added)
                    p = np.clip(_sigmoid(margin), eps, 1 - eps)
                    sums[i] -= np.where(positive, np.log(p), np.log(1 - p)).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array(sums), pa.array([n] * len(sums))],
                names=["tree", "loss", "n"],
            )

        known = self._scored(rows.where(F.col("target").isNotNull()))
        known = known.select("*", F.col("_row.target").cast("int").alias("target")).drop("_row")
        parts = known.mapInArrow(run, "tree int, loss double, n long")
        return parts.groupBy("tree").agg(
            F.try_divide(F.sum("loss"), F.sum("n").cast("double")).alias("loss")
        )

    def splits(self, spark: SparkSession) -> DataFrame:
        """Every node of every tree; ``left_categories`` and ``right_categories`` hold codes."""
        rows = []
        for number, tree in enumerate(self.trees):
            for i, x in enumerate(tree):
                is_leaf, numeric = x.feature < 0, 0 <= x.feature < len(self.layout.numbers)
                rows.append((
                    number, i, None if is_leaf else self.layout.name(x.feature),
                    self.layout.cuts[x.feature][x.cut] if numeric else None,
                    None if is_leaf else x.default_left, None if is_leaf else x.gain,
                    None if is_leaf else x.children[0], None if is_leaf else x.children[1],
                    x.gradient, x.hessian, x.weight if is_leaf else None,
                    None if x.left_set is None else x.left_set.tolist(),
                    None if x.right_set is None else x.right_set.tolist(),
                ))
        return spark.createDataFrame(
            rows,
            "tree int, node int, feature string, below double, default_left boolean, gain double,"
            " left int, right int, gradient double, hessian double, weight double,"
            " left_categories array<int>, right_categories array<int>",
        )

    def save(self, path: str) -> None:
        """Store trees, cut points, categories and configuration below ``path``."""
        spark = SparkSession.getActiveSession()
        for column, table in self.codes.items():
            table.write.mode("overwrite").parquet(f"{path}/codes/{column}")

        def plain(node: Node) -> dict:
            told = asdict(node)
            for side in ("left_set", "right_set"):
                if told[side] is not None:
                    told[side] = base64.b64encode(told[side].astype("<i4").tobytes()).decode()
            return told

        told = {
            "config": asdict(self.config), "layout": asdict(self.layout), "base": self.base_margin,
            "trees": [[plain(node) for node in tree] for tree in self.trees],
        }
        about = spark.range(1).select(F.lit(json.dumps(told)).alias("about"))
        about.write.mode("overwrite").parquet(f"{path}/newton")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NewtonModel:
        """A stored model; it predicts as before."""
        told = json.loads(spark.read.parquet(f"{path}/newton").first()["about"])
        layout = Layout(**{
            k: tuple(tuple(x) if isinstance(x, list) else x for x in v)
            for k, v in told["layout"].items()
        })

        def node(values: dict) -> Node:
            for side in ("left_set", "right_set"):
                if values[side] is not None:
                    values[side] = np.frombuffer(base64.b64decode(values[side]), "<i4")
            return Node(**{**values, "children": tuple(values["children"])})

        codes = {c: spark.read.parquet(f"{path}/codes/{c}") for c in layout.categories}
        trees = [[node(x) for x in tree] for tree in told["trees"]]
        return cls(NewtonConfig(**told["config"]), layout, told["base"], codes, trees)


def _stored(blocks: DataFrame, spark: SparkSession) -> DataFrame:
    path = f"{checkpoint_folder(spark)}/blocks-{uuid.uuid4().hex}"
    blocks.write.parquet(path)
    return spark.read.schema(_BLOCKS).parquet(path)
