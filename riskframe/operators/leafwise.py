"""Leaf-wise gradient boosting (J4) with early stopping by AUC.

Features are cut into bins once.  A round of a tree is one aggregate: each task
adds up gradient, hessian and row count by (model, node, feature, bin), the sums
meet by (model, node), and the task that adds them up finds the node's best
split, so the driver gets one row per node.  Growth is best first: the leaf with
the highest gain splits next, until ``max_leaves``.  A round looks at all leaves
that the growth reaches by what is known so far, and growth is repeated with
what they show, so a tree takes about as many rounds as it is deep and is still
the tree that splits one leaf at a time.  Where one task can hold the whole table
(``ALONE`` times ``TASK_ROWS`` rows, ``HELD`` bytes at one a feature), its sums need not
meet others and it goes from round to round and from tree to tree itself, up to
the next look at the AUC; several models are spread over as many tasks.  It adds
up the smaller child of a split only, features side by side in joint bins; the
other child is what is left of the parent.  Gradients are multiples of a power of
two so small that sums are exact in any order, so the trees are the same.

Several models (masks of training rows, parameters) grow side by side in the
same rounds.  Rows carry their margins: every ``CARRY`` trees the table is
written again with new ones, so a round adds up a bounded number of trees.

With validation rows, the margins after every tree of the last ``REFRESH`` are
one exploded table, and one grouped rank aggregate gives the AUC of each prefix;
a model stops when its best AUC is ``patience`` trees old and keeps the trees up
to the best.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from . import metrics as K

BINS = 64
TASK_ROWS = 250_000            # a task takes so many rows at least: small tables are not cut finer
ALONE = 4
HELD = 1 << 27                 # bytes of bins that one task holds
JOINT = 4096                   # joint bins of features that are added up together
REFRESH = 25                   # trees between two looks at the AUC
CARRY = 5                      # trees between two writes of the margins
DEFAULTS = {"learning_rate": 0.05, "n_iter": 300, "max_leaves": 31, "min_child": 20, "l2": 0.0, "subsample": 0.8, "colsample": 0.8}
U64 = np.uint64


@dataclass
class Tree:
    """Arrays over nodes; the root is node 0, ``feature`` is -1 at a leaf.  A row
    goes left when its bin is at most ``cut``."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def place(self, x: np.ndarray) -> np.ndarray:
        """The node that each row of bins ends in."""
        at = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return at
            n = at[inner]
            at[inner] = np.where(x[inner, self.feature[n]] <= self.cut[n], self.left[n], self.right[n])


@dataclass
class Booster:
    """Trees over bins, the bin edges, and the margin before the first tree."""
    edges: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)
    auc: list[float] = field(default_factory=list)         # of each prefix, with validation rows

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.edges)
        return self.base + sum((t.value[t.place(bins)] for t in self.trees), np.zeros(len(x)))

    def nodes(self) -> list[tuple]:
        """(tree, node, left, right, feature, threshold, cover, value) rows."""
        out = []
        for i, t in enumerate(self.trees):
            for n in range(len(t.feature)):
                f = int(t.feature[n])
                out.append((i, n, int(t.left[n]), int(t.right[n]), f, float(self.edges[f][t.cut[n]]) if f >= 0 else 0.0, float(t.rows[n]), float(t.value[n])))
        return out


def to_bins(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin b holds the values above edge b - 1 and up to edge b."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint8) if len(edges) else np.zeros((len(x), 0), np.uint8)


def bin_edges(data: DataFrame, features: str = "features", bins: int = BINS) -> list[np.ndarray]:
    """Distinct approximate quantiles of each feature, in one aggregate."""
    width = data.select(F.size(vector_to_array(features))).first()
    if width is None:
        return []
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    rows = data.select(vector_to_array(features).alias("x"))
    found = rows.agg(*[F.percentile_approx(F.col("x")[j], shares, F.lit(10_000)).alias(str(j)) for j in range(width[0])]).first()
    return [np.unique(np.array(found[j], float)) for j in range(width[0])]


def _uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) of each id, the same wherever the row is read."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15) + U64(seed % (1 << 63)) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(30))) * U64(0x94D049BB133111EB)
        x = (x ^ (x >> U64(27))) * U64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> U64(31))) >> U64(11)).astype(np.float64) / 2 ** 53


def widened(table: DataFrame, rows: int, most: int) -> int:
    """Tasks for the written table: at most one for every ``TASK_ROWS`` rows, a
    single one up to ``most`` rows."""
    return 1 if rows <= most else max(2, min(table.rdd.getNumPartitions(), -(-rows // TASK_ROWS)))


def met(parts: DataFrame, width: int, *key: str) -> DataFrame:
    """Partial sums of ``width`` tasks brought together by key; those of one task
    are whole."""
    if width > 1:
        parts = parts.repartition(min(width, 4 * parts.sparkSession.sparkContext.defaultParallelism), *key)
    return parts.sortWithinPartitions(*key)


def _sums(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


class _Rows:
    """A batch as arrays."""

    def __init__(self, rb, d: int) -> None:
        self.x = np.frombuffer(b"".join(rb.column("bins").to_pylist()), np.uint8).reshape(rb.num_rows, d)
        self.y, self.ids = rb.column("y").to_numpy(), rb.column("rid").to_numpy()
        self.margin, self.inside = _sums(rb.column("margin")), np.array(_sums(rb.column("inside")), bool)

    def gradients(self, m: int, job: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gradient, hessian, in the bag) of model m's job."""
        mask, weights, recent, _, _, share, seed, unit = job
        f = self.margin[:, m] + sum((t.value[t.place(self.x)] for t in recent), np.zeros(len(self.x)))
        return *_slopes(f, self.y, weights, unit), self.inside[:, mask] & (_uniform(self.ids, seed) < share)

    def node_sums(self, facts: tuple, growing: Tree, nodes) -> dict[int, np.ndarray]:
        g, h, use = facts
        at, d, out = growing.place(self.x), self.x.shape[1], {}
        for node in nodes:
            sel = np.flatnonzero(use & (at == node))
            if len(sel):
                slot = (self.x[sel].astype(np.int64) + np.arange(d) * BINS).ravel()
                out[node] = np.stack([*(np.bincount(slot, np.repeat(v[sel], d), d * BINS) for v in (g, h)), np.bincount(slot, minlength=d * BINS)])
        return out


def exact_unit(rows: int, weights: np.ndarray) -> float:
    """The power of two of which gradients are multiples: their sums over all rows
    are whole numbers of it below 2^52."""
    return 2.0 ** (math.ceil(math.log2(max(1.0, rows * float(weights.max())))) - 52)


def _slopes(margin: np.ndarray, y: np.ndarray, weights: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the weighted log loss, in whole units."""
    p, w = 0.5 * (1 + np.tanh(margin / 2)), weights[y.astype(int)]
    return np.rint(w * (p - y) / unit) * unit, np.rint(w * p * (1 - p) / unit) * unit


def joint_features(sizes: Sequence[int]) -> list[list[int]]:
    """Groups of features whose bins give at most ``JOINT`` joint bins."""
    groups: list[tuple[list[int], int]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        i = next((i for i, (_, n) in enumerate(groups) if n * sizes[f] <= JOINT), len(groups))
        if i == len(groups):
            groups.append(([], 1))
        groups[i] = (groups[i][0] + [f], groups[i][1] * sizes[f])
    return [g for g, _ in groups]


class _Held:
    """A whole table in one task: its columns of bins, and joint bins of groups of
    features."""

    def __init__(self, parts: list, sizes: Sequence[int]) -> None:
        self.sizes, self.y, self.ids = sizes, np.concatenate([p.y for p in parts]), np.concatenate([p.ids for p in parts])
        self.margin, self.inside = np.concatenate([p.margin for p in parts]), np.concatenate([p.inside for p in parts])
        self.columns = np.concatenate([p.x.T for p in parts], axis=1)
        self.joint = []
        for group in joint_features(sizes):
            at = np.zeros(len(self.y), np.uint16)
            for f in group:
                at = at * np.uint16(sizes[f]) + self.columns[f]
            self.joint.append((group, at))

    def sums(self, rows: np.ndarray, facts) -> np.ndarray:
        """(3, features, bins): gradient, hessian and number of the rows."""
        out, facts = np.zeros((3, len(self.sizes), BINS)), [None if v is None else v[rows] for v in facts]
        for group, joint in self.joint:
            at, shape = joint[rows].astype(np.intp), [self.sizes[f] for f in group]
            for s, v in enumerate(facts):
                cube = np.bincount(at, v, math.prod(shape)).reshape(shape)
                for axis, f in enumerate(group):
                    out[s, f, :shape[axis]] = cube.sum(axis=tuple(a for a in range(len(group)) if a != axis))
        return out

    def halves(self, rows: np.ndarray, feature: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        left = self.columns[feature][rows] <= cut
        return rows[left], rows[~left]

    def add(self, margin: np.ndarray, rows: np.ndarray, tree: Tree) -> None:
        """The tree's values to the rows' margins."""
        stack = [(0, rows)]
        while stack:
            node, rows = stack.pop()
            if tree.feature[node] < 0:
                margin[rows] += tree.value[node]
                continue
            stack += zip((tree.left[node], tree.right[node]), self.halves(rows, tree.feature[node], tree.cut[node]))


def _histogram_pass(jobs: dict, d: int):
    """``jobs``: {model: (mask, weights, recent trees, tree in growth, nodes, share, seed, unit)}."""
    def run(batches):
        total: dict = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            rows = _Rows(rb, d)
            for m, job in jobs.items():
                for node, part in rows.node_sums(rows.gradients(m, job), job[3], job[4]).items():
                    total[m, node] = total[m, node] + part if (m, node) in total else part
        for (m, node), v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([node], pa.int32()), pa.array([v.tobytes()], pa.binary())],
                                             ["model", "node", "sums"])
    return run


def _one_task_pass(jobs: dict, first: int, count: int, seed: int, sizes: Sequence[int]):
    """``count`` trees of each model one after another, for a table of one task,
    whose sums are whole: the splits in the order in which they were found.
    ``jobs``: {model: (mask, weights, recent trees, settings, unit)}."""
    def run(batches):
        share, parts = (0, 1), []
        for rb in batches:                                                   # HELD bytes of bins at most
            if rb.num_rows:
                parts.append(_Rows(rb, len(sizes)))
                share = rb.column("share")[0].as_py(), rb.column("shares")[0].as_py()
        if not parts:
            return
        held = _Held(parts, sizes)
        parts.clear()
        for m in sorted(jobs)[share[0]::share[1]]:
            mask, weights, recent, s, unit = jobs[m]
            mine, margin = np.flatnonzero(held.inside[:, mask]), held.margin[:, m].copy()
            for t in recent:
                held.add(margin, mine, t)
            for at in range(first, first + count):
                g, h = _slopes(margin, held.y, weights, unit)
                bag = mine[_uniform(held.ids[mine], seed * 1009 + at) < s["subsample"]]
                growth = Growth(int(s["max_leaves"]))
                found = _grown(growth, held, bag, (g, h, None), _columns(len(sizes), s["colsample"], seed * 2003 + at), int(s["min_child"]), float(s["l2"]))
                held.add(margin, mine, growth.grown(s["learning_rate"], s["l2"]))
                yield pa.RecordBatch.from_pydict({"tree": pa.array([at - first] * len(found), pa.int32()), **_split_columns([(m, *f) for f in found])})
    return run


def _grown(growth: Growth, held: _Held, bag: np.ndarray, facts: tuple, columns: np.ndarray, min_child: int, l2: float) -> list[tuple]:
    """Grows one tree; (node, its split) of all nodes looked at, in order."""
    rows, sums, found = {0: bag}, {}, []
    parent: dict[int, tuple[int, int]] = {}                                  # node -> (parent, sibling)
    while wanted := growth.grow(ahead=False)[1]:
        for node in sorted(wanted):
            if node not in rows:                                             # both children of a split come at once
                up, other = parent[node]
                _, f, cut, *_ = growth.split[up]
                pair = tuple(sorted((node, other)))
                rows.update(zip(pair, held.halves(rows.pop(up), f, cut)))
                small, large = sorted(pair, key=lambda n: len(rows[n]))
                sums[small] = held.sums(rows[small], facts)
                sums[large] = sums.pop(up) - sums[small]
            elif node == 0 and len(bag):
                sums[0] = held.sums(bag, facts)
            split = best_split(sums[node], columns, min_child, l2) if len(rows[node]) else NO_SPLIT
            growth.learn(node, split)
            found.append((node, split))
            if node in growth.children:
                a, b = growth.children[node]
                parent[a], parent[b] = (node, b), (node, a)
            else:
                rows[node] = rows[node][:0]
                sums.pop(node, None)
    return found


def _split_columns(found: Sequence[tuple]) -> dict:
    """Columns of (model, node, split)."""
    model, node, split = zip(*found)
    gain, f, cut, left, whole = zip(*split)
    return {"model": pa.array(model, pa.int32()), "node": pa.array(node, pa.int32()), "gain": pa.array(gain, pa.float64()), "feature": pa.array(f, pa.int32()),
            "cut": pa.array(cut, pa.int32()), "lefts": [v.tolist() for v in left], "whole": [v.tolist() for v in whole]}


def best_split(sums: np.ndarray, columns: np.ndarray, min_child: int, l2: float) -> tuple:
    """(gain, feature, cut, left sums, whole sums) of (3, features, bins) sums;
    the first of equal gains in (feature, cut) order.  Gain -1: no split."""
    whole = sums[:, 0].sum(axis=1)
    left = np.cumsum(sums, axis=2)
    right = whole[:, None, None] - left

    def part(s):
        return np.divide(s[0] ** 2, s[1] + l2, out=np.zeros_like(s[0]), where=s[1] + l2 > 0)
    gain = part(left) + part(right) - part(whole[:, None, None])
    ok = (left[2] >= min_child) & (right[2] >= min_child)
    ok[np.setdiff1d(np.arange(sums.shape[1]), columns)] = False
    gain = np.where(ok, np.round(gain, 9), -1.0)
    f, cut = np.unravel_index(gain.argmax(), gain.shape)
    return float(gain[f, cut]), int(f), int(cut), left[:, f, cut], whole


NO_SPLIT = (-1.0, 0, 0, np.zeros(3), np.zeros(3))
SPLITS = "model int, node int, gain double, feature int, cut int, lefts array<double>, whole array<double>"


def _split_pass(jobs: dict, d: int):
    """Rows sorted by (model, node) -> the best split of each node."""
    def run(batches):
        key, total = None, None

        def found():
            return pa.RecordBatch.from_pydict(_split_columns([(*key, best_split(total.reshape(3, d, BINS), *jobs[key[0]]))]))
        for rb in batches:
            for m, n, raw in zip(rb.column("model").to_pylist(), rb.column("node").to_pylist(), rb.column("sums")):
                v = np.frombuffer(raw.as_buffer(), "<f8")
                if (m, n) == key:
                    total = total + v
                    continue
                if key is not None:
                    yield found()
                key, total = (m, n), v
        if key is not None:
            yield found()
    return run


class Growth:
    """One tree in growth: the splits known so far, and the tree they give."""

    def __init__(self, max_leaves: int) -> None:
        self.max_leaves = max_leaves
        self.children: dict[int, tuple[int, int]] = {}
        self.split: dict[int, tuple] = {}                  # node -> (gain, feature, cut, left, whole)
        self.size = 1
        self.path = [1]                                    # of each node: its place in a whole binary tree, for equal gains

    def learn(self, node: int, found: tuple) -> None:
        self.split[node] = found
        if found[0] > 0:
            self.children[node] = (self.size, self.size + 1)
            self.path += [2 * self.path[node], 2 * self.path[node] + 1]
            self.size += 2

    def grow(self, ahead: bool = True) -> tuple[list[int], list[int]]:
        """(nodes split, leaves nothing is known of) of best-first growth; not
        ``ahead``: only leaves that the next split has to be compared with."""
        heap, done, unknown = [], [], []

        def push(node):
            if node not in self.split:
                unknown.append(node)
            elif self.split[node][0] > 0:
                heapq.heappush(heap, (-self.split[node][0], self.path[node], node))
        push(0)
        while heap and len(done) < self.max_leaves - 1 and (ahead or not unknown):
            node = heapq.heappop(heap)[2]
            done.append(node)
            for c in self.children[node]:
                push(c)
        return done, unknown if ahead or len(done) < self.max_leaves - 1 else []

    def tree(self, rate: float, l2: float) -> Tree:
        """Of all nodes known; those not split by the growth are leaves."""
        done = set(self.grow()[0])
        n = self.size
        feature, cut, left, right = np.full(n, -1), np.zeros(n, int), np.zeros(n, int), np.zeros(n, int)
        value, rows = np.zeros(n), np.zeros(n)
        whole = {0: self.split[0][4]} if 0 in self.split else {}
        for node in sorted(self.children):
            s = self.split[node]
            whole[self.children[node][0]], whole[self.children[node][1]] = s[3], s[4] - s[3]
            if node in done:
                feature[node], cut[node], (left[node], right[node]) = s[1], s[2], self.children[node]
        for node, w in whole.items():
            rows[node] = w[2]
            value[node] = -rate * w[0] / (w[1] + l2) if w[1] + l2 > 0 else 0.0
        return Tree(feature, cut, left, right, value, rows)

    def grown(self, rate: float, l2: float) -> Tree:
        """The nodes of the tree alone, children in the order of the splits."""
        whole, done = self.tree(rate, l2), self.grow()[0]
        keep = np.array([0, *(c for node in done for c in self.children[node])])
        place = np.zeros(self.size, int)
        place[keep] = np.arange(len(keep))
        inner = whole.feature[keep] >= 0
        left, right = (np.where(inner, place[v[keep]], 0) for v in (whole.left, whole.right))
        return Tree(whole.feature[keep], whole.cut[keep], left, right, whole.value[keep], whole.rows[keep])


def _columns(d: int, share: float, seed: int) -> np.ndarray:
    count = max(1, int(round(share * d)))
    return np.sort(np.argsort(_uniform(np.arange(d), seed), kind="stable")[:count])


def fit_leafwise(data: DataFrame, masks: Sequence[Column], params: Sequence[Mapping[str, float]], key: str = "id", label: str = "y",
                 features: str = "features", balanced: bool = True, valid: Column | None = None, patience: int = 50,
                 seed: int = 42) -> list[Booster]:
    """One booster for each (mask, params) pair, grown in the same rounds.  Rows
    without a label are left out.  ``valid`` marks the rows whose AUC stops the
    growth (they should meet no mask)."""
    spark = data.sparkSession
    ship_package(spark)
    if unknown := {n for p in params for n in p} - set(DEFAULTS):
        raise ValueError(f"unknown settings {sorted(unknown)}; expected some of {sorted(DEFAULTS)}")
    settings = [{**DEFAULTS, **p} for p in params]
    rows = data.where(F.col(label).isNotNull())
    edges = bin_edges(rows, features)
    d, models = len(edges), len(settings)

    def bins(batches):
        for rb in batches:
            x = to_bins(_sums(rb.column("x")), edges) if rb.num_rows else np.zeros((0, d), np.uint8)
            yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in ("rid", "y", "inside", "valid")), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["rid", "y", "inside", "valid", "bins"])
    table = rows.select(F.xxhash64(key).alias("rid"), F.col(label).cast("double").alias("y"), F.array(*[F.coalesce(m, F.lit(False)) for m in masks]).alias("inside"),
                        F.coalesce(valid if valid is not None else F.lit(False), F.lit(False)).alias("valid"), vector_to_array(features).alias("x"))
    table = cut_lineage(table.mapInArrow(bins, "rid long, y double, inside array<boolean>, valid boolean, bins binary"))
    total = table.count()
    width = widened(table, total, min(ALONE * TASK_ROWS, HELD // max(1, d)))
    counts = {r["y"]: r for r in table.groupBy("y").agg(*[F.sum(F.col("inside")[m].cast("long")).alias(str(m)) for m in range(models)]).collect()}
    n = np.array([[counts[float(c)][str(m)] if float(c) in counts else 0 for c in (0, 1)] for m in range(models)], float)
    weights = np.ones((models, 2))
    if balanced:
        weights = np.divide(n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True) * n, out=weights, where=n > 0)
    mass = np.maximum(weights * n, 1e-9)
    out = [Booster(edges, float(np.log(mass[m, 1] / mass[m, 0])) if n[m].all() else 0.0) for m in range(models)]
    units = [exact_unit(total, w) for w in weights]
    table = table.withColumn("margin", F.array(*[F.lit(b.base) for b in out]))
    live, recent, iteration = set(range(models)), {m: [] for m in range(models)}, 0
    looked, since = table, {m: [] for m in range(models)}              # margins at the last look, trees since
    while live:
        if width == 1:
            count = min(REFRESH - iteration % REFRESH, *(int(settings[m]["n_iter"]) - iteration for m in live))
            jobs = {m: (m, weights[m], recent[m], settings[m], units[m]) for m in live}
            grown = {m: [Growth(int(settings[m]["max_leaves"])) for _ in range(count)] for m in live}
            sizes = [len(e) + 1 for e in edges]
            for r in _shared(table, min(len(live), spark.sparkContext.defaultParallelism)).mapInArrow(
                    _one_task_pass(jobs, iteration, count, seed, sizes), f"tree int, {SPLITS}").collect():     # a row per node, in order
                grown[r["model"]][r["tree"]].learn(r["node"], _found(r))
        else:
            count, grown = 1, _round_by_round(table.coalesce(width), width, live, settings, weights, units, recent, iteration, seed, d)
        for m in live:
            trees = [g.grown(settings[m]["learning_rate"], settings[m]["l2"]) for g in grown[m]]
            out[m].trees += trees
            recent[m] = recent[m] + trees
            since[m] = since[m] + trees
        iteration += count
        ended = {m for m in live if iteration >= settings[m]["n_iter"]}
        if iteration % REFRESH == 0 or ended:
            if valid is not None:
                for m, auc in _prefix_auc(looked, {m: since[m] for m in live}, d).items():
                    out[m].auc += auc
                    if iteration - 1 - int(np.argmax(out[m].auc)) >= patience:
                        ended.add(m)
        if live - ended and (iteration % CARRY == 0 or iteration % REFRESH == 0 or ended):
            table = cut_lineage(_with_margins(table, {m: recent[m] for m in live}, d))
            recent = {m: [] for m in range(models)}
            if iteration % REFRESH == 0 or ended:
                looked, since = table, {m: [] for m in range(models)}
        live -= ended
    if valid is not None:
        for b in out:
            b.trees = b.trees[:int(np.argmax(b.auc)) + 1]
    return out


def _shared(table: DataFrame, shares: int) -> DataFrame:
    """The whole table in each of so many tasks."""
    if shares == 1:
        return table.withColumns({"share": F.lit(0), "shares": F.lit(1)}).coalesce(1)
    return table.select("*", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(shares).alias("shares")).repartitionById(shares, "share")


def _round_by_round(table: DataFrame, width: int, live: set, settings: list, weights: np.ndarray, units: list, recent: dict, iteration: int,
                    seed: int, d: int) -> dict[int, list[Growth]]:
    """The next tree of each model, a job a round."""
    growing = {m: Growth(int(settings[m]["max_leaves"])) for m in live}
    while True:
        jobs, rules = {}, {}
        for m in live:
            s = settings[m]
            wanted = growing[m].grow()[1]
            if wanted:
                shape = growing[m].tree(s["learning_rate"], s["l2"])
                jobs[m] = (m, weights[m], recent[m], shape, wanted, s["subsample"], seed * 1009 + iteration, units[m])
                rules[m] = (_columns(d, s["colsample"], seed * 2003 + iteration), int(s["min_child"]), float(s["l2"]))
        if not jobs:
            return {m: [g] for m, g in growing.items()}
        parts = table.mapInArrow(_histogram_pass(jobs, d), "model int, node int, sums binary")
        rows_ = met(parts, width, "model", "node").mapInArrow(_split_pass(rules, d), SPLITS).collect()     # a row per node
        seen = {(r["model"], r["node"]): r for r in rows_}
        for m, (*_, wanted, _, _, _) in jobs.items():
            for node in sorted(wanted):
                growing[m].learn(node, _found(seen[m, node]) if (m, node) in seen else NO_SPLIT)


def _found(r) -> tuple:
    return r["gain"], r["feature"], r["cut"], np.array(r["lefts"]), np.array(r["whole"])


def _with_margins(table: DataFrame, recent: dict, d: int) -> DataFrame:
    def run(batches):
        for rb in batches:
            margin = _sums(rb.column("margin")).copy() if rb.num_rows else np.zeros((0, 1))
            x = np.frombuffer(b"".join(rb.column("bins").to_pylist()), np.uint8).reshape(rb.num_rows, d)
            for m, trees in recent.items():
                for t in trees:
                    margin[:, m] += t.value[t.place(x)]
            at = rb.schema.get_field_index("margin")
            yield rb.set_column(at, "margin", pa.array(margin.tolist(), pa.list_(pa.float64())))
    return table.mapInArrow(run, table.schema)


def _prefix_auc(table: DataFrame, recent: dict, d: int) -> dict[int, list[float]]:
    """AUC on the validation rows after each of the recent trees, by model: one
    exploded table of margins and one grouped rank aggregate."""
    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            margin = _sums(rb.column("margin"))
            x = np.frombuffer(b"".join(rb.column("bins").to_pylist()), np.uint8).reshape(rb.num_rows, d)
            for m, trees in recent.items():
                now = margin[:, m].copy()
                for i, t in enumerate(trees):
                    now += t.value[t.place(x)]
                    yield pa.RecordBatch.from_arrays([rb.column("y"), pa.array(np.full(len(x), m, np.int32)), pa.array(np.full(len(x), i, np.int32)), pa.array(now)],
                                                     ["y", "model", "prefix", "score"])
    scored = table.where("valid").select("y", "margin", "bins").mapInArrow(run, "y double, model int, prefix int, score double")
    auc = {(r["model"], r["prefix"]): r["roc_auc"] for r in K.rank_metrics(scored, by=["model", "prefix"]).select("model", "prefix", "roc_auc").collect()}
    return {m: [auc.get((m, i)) or 0.0 for i in range(len(trees))] for m, trees in recent.items()}


def score_leafwise(booster: Booster, data: DataFrame, keep: Sequence[str] = ("id", "y"), features: str = "features", name: str = "score") -> DataFrame:
    """(keep..., score): probability of class 1."""
    ship_package(data.sparkSession)
    keep = list(keep)

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                margin = booster.margins(_sums(rb.column("_x")))
                yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in keep), pa.array(0.5 * (1 + np.tanh(margin / 2)))], [*keep, name])
    kinds = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    return data.select(*keep, vector_to_array(features).alias("_x")).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", `{name}` double")
