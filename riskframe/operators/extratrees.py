"""Extremely randomised trees.

A node draws some features and, for each of them that varies in the node, one
threshold uniform between its least and largest value there; the best of these
random splits by Gini impurity is taken.  Draws come from a hash of (seed, tree,
node, feature), so they do not depend on where rows are.

Where a task can hold the whole table (``HELD`` bytes, a column's values as their
places among its distinct ones), the trees are spread over the tasks, and each
task grows its own from root to leaves with the rows of a node side by side.

A larger table stays where it is: all nodes of a level of all trees are scored in
two aggregates, ranges of the drawn features, then class counts on the left of
each threshold.  A task adds up its rows by node, in one array a tree; what it
sends, and what reaches the driver, grows with the nodes of a level, and as many
trees grow side by side as ``WAVE_NODES`` allows.  The trees are the same.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .leafwise import _uniform, met

DEFAULTS = {"n_trees": 400, "min_leaf": 20, "max_features": "sqrt", "max_depth": 30}


@dataclass
class RandomTree:
    """Arrays over nodes; ``feature`` is -1 at a leaf, ``value`` is the weighted
    share of class 1, ``rows`` the rows that reached the node."""
    feature: array
    threshold: array
    left: array
    right: array
    value: array
    rows: array
    depth: array

    def place(self, x: np.ndarray) -> np.ndarray:
        return _placed(_shape(self), x)


@dataclass
class RandomForest:
    trees: list[RandomTree]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sum((np.array(t.value)[t.place(x)] for t in self.trees), np.zeros(len(x))) / max(1, len(self.trees))

    def nodes(self) -> list[tuple]:
        """(tree, node, left, right, feature, threshold, cover, value) rows; a
        leaf's value is its part of the mean over trees."""
        return [(i, n, int(t.left[n]), int(t.right[n]), int(t.feature[n]), float(t.threshold[n]), float(t.rows[n]), float(t.value[n]) / len(self.trees))
                for i, t in enumerate(self.trees) for n in range(len(t.feature))]


def features_of(share, d: int) -> int:
    """Features that a node draws: ``sqrt`` or a share of all."""
    return max(1, int(math.sqrt(d)) if share == "sqrt" else int(float(share) * d))


def drawn_all(seed: int, tree: int, nodes: np.ndarray, d: int) -> np.ndarray:
    """All features in each node's drawing order."""
    return np.argsort(_uniform(np.arange(d) + 1_000_003 * np.asarray(nodes, np.int64)[:, None], seed * 7919 + tree), axis=1, kind="stable")


def drawn(seed: int, tree: int, node: int, d: int) -> np.ndarray:
    return drawn_all(seed, tree, np.array([node]), d)[0]


def threshold_at(seed: int, tree: int, node, feature: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    u = _uniform(np.asarray(feature, np.int64) + 1_000_003 * np.asarray(node, np.int64), seed * 104_729 + tree + 1)
    return np.minimum(low + u * (high - low), np.nextafter(high, -np.inf))   # both sides hold a row


def _x(rb) -> np.ndarray:
    return rb.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, -1)


def _shape(tree: RandomTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, threshold, left child); the right child follows the left one."""
    return np.array(tree.feature, np.int32), np.array(tree.threshold), np.array(tree.left, np.int32)


def _placed(shape, x: np.ndarray) -> np.ndarray:
    feature, threshold, left = shape
    at, d, flat = np.zeros(len(x), np.int32), x.shape[1], x.ravel()
    inner = np.arange(len(x))
    while True:
        f = feature[at[inner]]
        keep = f >= 0
        inner, f = inner[keep], f[keep]
        if not len(inner):
            return at
        n = at[inner]
        at[inner] = left[n] + ~(flat[inner * d + f] <= threshold[n])


def _sorted_rows(shape, x: np.ndarray, nodes: np.ndarray):
    """(rows in the given nodes, the place of each one's node, where a new node
    starts, the places there): rows of a node side by side."""
    place = np.full(len(shape[0]), -1, np.int32)
    place[nodes] = np.arange(len(nodes))
    at = place[_placed(shape, x)]
    rows = np.flatnonzero(at >= 0)
    at = at[rows]
    order = np.argsort(at.astype(np.uint16) if len(nodes) < 1 << 16 else at, kind="stable")
    rows, at = rows[order], at[order]
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    return rows, at, starts, at[starts]


def _parts(sums: dict):
    for t, v in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["tree", "sums"])


def _range_pass(level):
    """``level``: {tree: (shape, nodes, features of each)}.  Least and, negated,
    largest value of those features in those nodes, one array a tree."""
    def run(batches):
        least = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            x = _x(rb)
            for t, (shape, nodes, features) in level.items():
                rows, at, starts, here = _sorted_rows(shape, x, nodes)
                if not len(rows):
                    continue
                v = x[rows[:, None], features[at]]
                if t not in least:
                    least[t] = np.full((2, *features.shape), np.inf)
                for side, part in enumerate((np.minimum.reduceat(v, starts, axis=0), -np.maximum.reduceat(v, starts, axis=0))):
                    least[t][side, here] = np.minimum(least[t][side, here], part)
        yield from _parts(least)
    return run


def _class_pass(level):
    """``level``: {tree: (shape, nodes, features of each, thresholds of each)}.
    Rows of class 0 and of class 1 left of each threshold; those of the whole
    node come first."""
    def run(batches):
        total: dict = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            x, one = _x(rb), rb.column("y").to_numpy() == 1
            for t, (shape, nodes, features, cuts) in level.items():
                rows, at, starts, here = _sorted_rows(shape, x, nodes)
                if not len(rows):
                    continue
                left = np.ones((len(rows), 1 + features.shape[1]), bool)
                np.less_equal(x[rows[:, None], features[at]], cuts[at], out=left[:, 1:])
                if t not in total:
                    total[t] = np.zeros((2, len(nodes), left.shape[1]))
                ones = np.add.reduceat(left & one[rows, None], starts, axis=0, dtype=np.int64)
                total[t][1, here] += ones
                total[t][0, here] += np.add.reduceat(left, starts, axis=0, dtype=np.int64) - ones
        yield from _parts(total)
    return run


def _merge_pass(combine):
    """Rows sorted by tree -> one row each."""
    def run(batches):
        key, total = None, None
        for rb in batches:
            for t, raw in zip(rb.column("tree").to_pylist(), rb.column("sums")):
                v = np.frombuffer(raw.as_buffer(), "<f8")
                if t == key:
                    total = combine(total, v)
                    continue
                if key is not None:
                    yield from _parts({key: total})
                key, total = t, v
        if key is not None:
            yield from _parts({key: total})
    return run


SUMS = "tree int, sums binary"
SPARE = 5                      # features looked at beyond those that a node draws: some do not vary in it
WAVE_NODES = 1_000_000         # trees that grow side by side have so many leaves at most
HELD = 1 << 28                 # bytes of a table that a task holds


def _merged(table: DataFrame, width: int, function, combine) -> dict[int, np.ndarray]:
    """One array for each tree of a level."""
    rows = met(table.mapInArrow(function, SUMS), width, "tree").mapInArrow(_merge_pass(combine), SUMS).collect()
    return {r["tree"]: np.frombuffer(bytes(r["sums"]), "<f8") for r in rows}


def _drawn_splits(table: DataFrame, width: int, level: dict, d: int, wanted: int, seed: int) -> dict:
    """{tree: (shape, nodes, features, thresholds)}: of each node the first
    ``wanted`` features of its drawing order that vary in it.  Ranges are taken of
    the order's beginning, and of all features where too few of those vary.
    Places without a feature have the threshold -inf."""
    out, order = {}, {t: drawn_all(seed, t, nodes, d) for t, (_, nodes) in level.items()}
    ask = {t: (shape, nodes, order[t][:, :wanted + SPARE], np.arange(len(nodes))) for t, (shape, nodes) in level.items()}
    for t, (shape, nodes) in level.items():
        out[t] = (shape, nodes, np.zeros((len(nodes), wanted), np.int32), np.full((len(nodes), wanted), -np.inf))
    while ask:
        ranges = _merged(table, width, _range_pass({t: a[:3] for t, a in ask.items()}), np.minimum)
        more = {}
        for t, v in ranges.items():
            shape, nodes, features, at = ask[t]
            low, high = v.reshape(2, *features.shape) * np.array([1.0, -1.0])[:, None, None]
            varies = high > low
            place = np.cumsum(varies, axis=1) - 1
            i, j = np.nonzero(varies & (place < wanted))
            f = features[i, j]
            out[t][2][at[i], place[i, j]] = f
            out[t][3][at[i], place[i, j]] = threshold_at(seed, t, nodes[i], f, low[i, j], high[i, j])
            few = np.flatnonzero(varies.sum(axis=1) < wanted) if features.shape[1] < d else []
            if len(few):
                more[t] = (shape, nodes[few], order[t][at[few]], at[few])
        ask = more
    return out


def gini_gain(left: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Fall of the weighted Gini impurity by splits with class sums ``left``."""
    def impurity(s):
        n = s.sum(axis=-1)
        return np.divide(2 * s[..., 0] * s[..., 1], n, out=np.zeros_like(n), where=n > 0)     # times the weight
    return impurity(whole) - impurity(left) - impurity(whole - left)


def _root(value: float, rows: float) -> RandomTree:
    return RandomTree(array("i", [-1]), array("d", [0.0]), array("i", [0]), array("i", [0]), array("d", [value]), array("d", [rows]), array("b", [0]))


# --- trees apart, where a task holds the table ----------------------------------------
def _coded_columns(table: DataFrame, d: int) -> DataFrame:
    """One row a column: (feature, rows, bytes of a place, places, sorted distinct
    values).  A value's place is its index there; feature -1 has the class."""
    def cut(batches):
        part = TaskContext.get().partitionId()
        for i, rb in enumerate(batches):
            if rb.num_rows:
                x = _x(rb)
                data = [(rb.column("y").to_numpy() == 1).astype(np.float64).tobytes(), *(x[:, j].tobytes() for j in range(d))]
                yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([part] * (d + 1), pa.int32()), pa.array([i] * (d + 1), pa.int32()),
                                                  pa.array(data, pa.binary())], ["feature", "part", "batch", "data"])

    def coded(key, data):
        values, places = np.unique(np.frombuffer(b"".join(data), "<f8"), return_inverse=True)
        kind = np.uint8 if len(values) <= 1 << 8 else np.uint16 if len(values) <= 1 << 16 else np.uint32
        return pa.RecordBatch.from_pydict({"feature": pa.array([key], pa.int32()), "rows": [len(places)], "size": [np.dtype(kind).itemsize],
                                           "places": pa.array([places.astype(kind).tobytes()], pa.binary()), "sorted": pa.array([values.tobytes()], pa.binary())})

    def joined(batches):
        key, data = None, []
        for rb in batches:
            for f, raw in zip(rb.column("feature").to_pylist(), rb.column("data")):
                if f != key:
                    if data:
                        yield coded(key, data)
                    key, data = f, []
                data.append(raw.as_py())
        if data:
            yield coded(key, data)
    parts = table.mapInArrow(cut, "feature int, part int, batch int, data binary").repartition(table.sparkSession.sparkContext.defaultParallelism, "feature")
    return cut_lineage(parts.sortWithinPartitions("feature", "part", "batch").mapInArrow(joined, "feature int, rows long, size long, places binary, sorted binary"))


def _held_bytes(columns: DataFrame, d: int) -> int:
    """All places as wide as the widest, and the distinct values."""
    r = columns.agg(F.max("rows") * F.max("size") * d + F.sum(F.length("sorted"))).first()
    return r[0]


class _Table:
    """The coded table: places by row, the distinct values of all features."""

    def __init__(self, rows: list, d: int) -> None:
        kind = np.dtype(f"u{max(r[2] for r in rows)}")
        self.x, self.d, values = np.zeros((rows[0][1], d), kind), d, [np.zeros(0)] * d
        while rows:
            f, _, size, places, found = rows.pop()
            places, found = np.frombuffer(places.as_buffer(), f"u{size}"), np.frombuffer(found.as_buffer(), "<f8")
            if f < 0:
                self.one = found[places] == 1
            else:
                self.x[:, f], values[f] = places, found
        self.flat, self.values = self.x.ravel(), values
        self.start = np.cumsum([0, *(len(v) for v in values)])[:-1]
        self.all = np.concatenate(values)

    def place_of(self, features: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        """The last place at or below each threshold."""
        out = np.full(features.shape, -1, np.int64)
        real = np.flatnonzero(np.isfinite(thresholds))
        real = real[np.argsort(features[real], kind="stable")]
        f = features[real]
        at = np.flatnonzero(np.diff(f, prepend=-1))
        for a, b in zip(at, [*at[1:], len(f)]):
            out[real[a:b]] = np.searchsorted(self.values[f[a]], thresholds[real[a:b]], "right") - 1
        return out


def _grown_alone(table: _Table, t: int, weights: np.ndarray, least: int, wanted: int, max_depth: int, seed: int) -> dict[str, np.ndarray]:
    """One tree: of all nodes the feature (-1 at a leaf), the rows and those of
    class 1, and of inner nodes the threshold.  Children follow in their parents'
    order."""
    n, d = len(table.one), table.d
    rows, size, depth = np.arange(n), 1, 0
    nodes, count = np.array([0]), np.array([n])
    whole = np.array([[n - table.one.sum(), table.one.sum()]], float)
    feature, threshold, sums = [np.array([-1], np.int32)], [], [whole]
    both = 1 + (table.one.astype(np.int64) << 32)
    while len(nodes):
        starts, k, base = np.cumsum(count) - count, len(nodes), rows * d
        order = drawn_all(seed, t, nodes, d)
        f, low, high, have = np.zeros((k, wanted), np.int32), np.zeros((k, wanted)), np.zeros((k, wanted)), np.zeros(k, np.int64)
        for at in range(d):                                                  # the first features drawn that vary in the node
            ask = np.flatnonzero(have < wanted)
            if not len(ask):
                break
            g = order[ask, at]
            if len(ask) == k:
                place, s = table.flat[base + np.repeat(g, count)], starts
            else:
                some, c = _segments(starts[ask], count[ask]), count[ask]
                place, s = table.flat[base[some] + np.repeat(g, c)], np.cumsum(c) - c
            a, b = (table.all[table.start[g] + v.reduceat(place, s)] for v in (np.minimum, np.maximum))
            varies = np.flatnonzero(b > a)
            i = ask[varies]
            f[i, have[i]], low[i, have[i]], high[i, have[i]] = g[varies], a[varies], b[varies]
            have[i] += 1
        real = np.arange(wanted) < have[:, None]
        cut = np.full((k, wanted), -np.inf)
        i, _ = np.nonzero(real)
        cut[real] = threshold_at(seed, t, nodes[i], f[real], low[real], high[real])
        limit = table.place_of(f.ravel(), cut.ravel()).reshape(k, wanted)
        left, lefts, mine = np.zeros((wanted, len(rows)), bool), np.zeros((k, wanted), np.int64), both[rows]
        for j in range(wanted):
            np.less_equal(table.flat[base + np.repeat(f[:, j], count)], np.repeat(limit[:, j], count), out=left[j])
            lefts[:, j] = np.add.reduceat(mine * left[j], starts)
        ones, number = lefts >> 32, lefts & ((1 << 32) - 1)
        part = np.stack([number - ones, ones], axis=2).astype(float)
        gain = np.round(gini_gain(part * weights, whole[:, None] * weights), 9)
        gain[(number < least) | (whole.sum(axis=1)[:, None] - number < least)] = -1.0
        best = gain.argmax(axis=1)
        split = np.flatnonzero(gain[np.arange(k), best] > 0)
        if not len(split):
            break
        depth += 1
        child = size + 2 * np.arange(len(split))[:, None] + [0, 1]
        half = np.stack([part[split, best[split]], whole[split] - part[split, best[split]]], axis=1)
        feature[-1][nodes[split] - (size - len(feature[-1]))] = f[split, best[split]]
        threshold.append(cut[split, best[split]])
        feature.append(np.full(child.size, -1, np.int32))
        size += child.size
        sums.append(half.reshape(-1, 2))
        a, b = half[..., 0] * weights[0], half[..., 1] * weights[1]
        grows = ((half.sum(axis=2) >= 2 * least) & (a > 1e-9) & (b > 1e-9) & (depth < max_depth))
        # rows of a child side by side, in the order of the children
        number = np.where(grows, half.sum(axis=2).astype(np.int64), 0).ravel()
        begin = np.where(grows.ravel(), np.cumsum(number) - number, -len(rows) - 1).reshape(-1, 2)
        to = np.full((k, 2), -len(rows) - 1)
        to[split] = begin
        goes = left[np.repeat(best, count), np.arange(len(rows))]
        before = np.cumsum(goes) - goes
        before -= np.repeat(before[starts], count)
        target = np.where(goes, np.repeat(to[:, 0], count) + before, np.repeat(to[:, 1] - starts, count) + np.arange(len(rows)) - before)
        keep = np.flatnonzero(target >= 0)
        moved = np.zeros(number.sum(), np.int64)
        moved[target[keep]] = rows[keep]
        rows, nodes, count, whole = moved, child[grows], half.sum(axis=2)[grows].astype(np.int64), half[grows]
    whole = np.concatenate(sums)
    return {"feature": np.concatenate(feature), "threshold": np.concatenate([[], *threshold]), "rows": whole.sum(axis=1).astype(np.int32),
            "ones": whole[:, 1].astype(np.int32)}


def _segments(starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of so many runs, one after another."""
    return np.arange(count.sum()) + np.repeat(starts - (np.cumsum(count) - count), count)


def _grown_apart(columns: DataFrame, d: int, number: int, weights: np.ndarray, least: int, wanted: int, max_depth: int, seed: int) -> list[RandomTree]:
    """All trees, each by one of the tasks."""
    shares = min(number, columns.sparkSession.sparkContext.defaultParallelism)

    def run(batches):
        rows, share = [], 0
        for rb in batches:
            for i in range(rb.num_rows):
                rows.append([*(rb.column(c)[i].as_py() for c in ("feature", "rows", "size")), *(rb.column(c)[i] for c in ("places", "sorted"))])
                share = rb.column("share")[i].as_py()
        if not rows:
            return
        table = _Table(rows, d)
        for t in range(share, number, shares):
            tree = _grown_alone(table, t, weights, least, wanted, max_depth, seed)
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in tree.values())], ["tree", *tree])
    found = (columns.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).repartitionById(shares, "share")
             .mapInArrow(run, "tree int, feature binary, threshold binary, rows binary, ones binary"))
    trees: dict[int, RandomTree] = {}
    for r in cut_lineage(found).toLocalIterator():                           # a row a tree
        feature, cuts = np.frombuffer(bytes(r["feature"]), np.int32), np.frombuffer(bytes(r["threshold"]), np.float64)
        rows, ones = (np.frombuffer(bytes(r[c]), np.int32).astype(float) for c in ("rows", "ones"))
        inner = feature >= 0
        threshold, left = np.zeros(len(feature)), np.zeros(len(feature), np.int32)
        threshold[inner], left[inner] = cuts, 1 + 2 * np.arange(len(cuts))
        a, b = (rows - ones) * weights[0], ones * weights[1]
        parts = (("i", feature), ("d", threshold), ("i", left), ("i", np.where(inner, left + 1, 0).astype(np.int32)), ("d", b / np.maximum(a + b, 1e-300)), ("d", rows))
        trees[r["tree"]] = RandomTree(*(array(kind, v.tobytes()) for kind, v in parts), array("b"))
    return [trees[t] for t in range(number)]


def fit_extra_trees(data: DataFrame, params: Mapping[str, object] | None = None, label: str = "y", features: str = "features",
                    balanced: bool = True, seed: int = 42) -> RandomForest:
    """A forest over all labelled rows (no resampling).  A split leaves at least
    ``min_leaf`` rows on both sides."""
    if unknown := set(params or {}) - set(DEFAULTS):
        raise ValueError(f"unknown settings {sorted(unknown)}; expected some of {sorted(DEFAULTS)}")
    s = {**DEFAULTS, **(params or {})}
    ship_package(data.sparkSession)
    table = data.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), vector_to_array(features).alias("x"))
    table = cut_lineage(table.repartition(data.sparkSession.sparkContext.defaultParallelism))      # a row costs as much as there are trees
    width = table.rdd.getNumPartitions()
    counts = {r["y"]: r["count"] for r in table.groupBy("y").count().collect()}
    n = np.array([counts.get(0, 0), counts.get(1, 0)], float)
    weights = np.divide(n.sum(), (n > 0).sum() * n, out=np.ones(2), where=n > 0) if balanced else np.ones(2)
    first = float(n[1] * weights[1] / max((n * weights).sum(), 1e-300))
    trees = [_root(first, n.sum()) for _ in range(int(s["n_trees"]))]
    least = int(s["min_leaf"])
    d = len(row["x"]) if (row := table.select("x").first()) else 0
    if n.sum() >= 2 * least and n.all():
        columns = _coded_columns(table, d) if n.sum() * d <= HELD else None       # a byte a value at least
        if columns is not None and _held_bytes(columns, d) <= HELD:
            return RandomForest(_grown_apart(columns, d, len(trees), weights, least, features_of(s["max_features"], d), int(s["max_depth"]), seed))
        together = max(1, int(WAVE_NODES * least // n.sum()))          # a tree has at most rows / least leaves
        for at in range(0, len(trees), together):
            _grow(table, width, {t: trees[t] for t in range(at, min(at + together, len(trees)))}, d, weights, least,
                  features_of(s["max_features"], d), int(s["max_depth"]), seed)
    return RandomForest(trees)


def _grow(table: DataFrame, width: int, trees: dict[int, RandomTree], d: int, weights: np.ndarray, least: int, wanted: int,
          max_depth: int, seed: int) -> None:
    """Level by level, all trees side by side."""
    level = {t: [0] for t in trees}
    while level:
        splits = _drawn_splits(table, width, {t: (_shape(trees[t]), np.array(nodes)) for t, nodes in level.items()}, d, wanted, seed)
        splits = {t: v for t, v in splits.items() if np.isfinite(v[3]).any()}
        if not splits:
            break
        sums = _merged(table, width, _class_pass(splits), np.add)
        level = {}
        for t, v in sorted(sums.items()):
            _, nodes, features, cuts = splits[t]
            count = v.reshape(2, len(nodes), -1).transpose(1, 2, 0)
            whole, left = count[:, 0], count[:, 1:]
            gain = np.round(gini_gain(left * weights, whole[:, None] * weights), 9)
            rows = left.sum(axis=2)
            gain[(rows < least) | (whole.sum(axis=1)[:, None] - rows < least)] = -1.0
            best, tree = gain.argmax(axis=1), trees[t]
            for i in np.flatnonzero(gain[np.arange(len(nodes)), best] > 0):
                node, j = int(nodes[i]), best[i]
                tree.feature[node], tree.threshold[node] = int(features[i, j]), float(cuts[i, j])
                tree.left[node], tree.right[node] = len(tree.feature), len(tree.feature) + 1
                for zero, one in (left[i, j], whole[i] - left[i, j]):
                    child, a, b = len(tree.feature), zero * weights[0], one * weights[1]
                    for column, value in zip((tree.feature, tree.threshold, tree.left, tree.right, tree.value, tree.rows, tree.depth),
                                             (-1, 0.0, 0, 0, float(b / max(a + b, 1e-300)), float(zero + one), tree.depth[node] + 1)):
                        column.append(value)
                    if zero + one >= 2 * least and a > 1e-9 and b > 1e-9 and tree.depth[child] < max_depth:
                        level.setdefault(t, []).append(child)


def score_extra_trees(forest: RandomForest, data: DataFrame, keep=("id", "y"), features: str = "features", name: str = "score") -> DataFrame:
    """(keep..., score): mean share of class 1 over the trees."""
    ship_package(data.sparkSession)
    keep = list(keep)
    trees = [(_shape(t), np.array(t.value)) for t in forest.trees]

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                x = _x(rb)
                score = sum((value[_placed(shape, x)] for shape, value in trees), np.zeros(len(x))) / max(1, len(trees))
                yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in keep), pa.array(score)], [*keep, name])
    kinds = dict(data.dtypes)
    return (data.select(*keep, vector_to_array(features).alias("x"))
            .mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", `{name}` double"))
