"""Attributions of tree ensembles (L3): Shapley values of the path-dependent
game, for forests, boosted trees and the leaf-wise booster.

An ensemble is a relation of nodes.  Joining children to their parents, level by
level, gives its root-to-leaf paths: for each leaf, one interval and one cover
share for each feature on the way (the interval that all conditions on it leave,
the product of the shares of rows that went the leaf's way).  A row joined to a
leaf knows which intervals hold it, o_f = 1 or 0, and the leaf is worth, to a
coalition S, value * prod_{f in S} o_f * prod_{f not in S} r_f.  The Shapley
value of that product is

    value * (o_f - r_f) * integral_0^1 prod_{g <> f} ((1 - t) r_g + t o_g) dt,

the weights k! (m - k - 1)! / m! of the path polynomial's coefficients being the
integrals of t^k (1 - t)^(m - 1 - k).  Gauss-Legendre points integrate the
polynomial exactly.  A path of m features has 2^m patterns of held intervals; for
short paths the values of all patterns are worked out once, and a row only looks
its own up.  Sums over leaves are local to a row, so the rows are read once and
nothing is shuffled; the paths are as large as the model.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir, ship_package
from .extratrees import RandomForest
from .leafwise import Booster

NODES = "tree int, node int, left int, right int, feature int, threshold double, cover double, value double"
CELLS = 1 << 20                # (row, path, feature) triples at a time
PAIRS = 1 << 17                # (row, path) pairs at a time, with a table of patterns
TABLE = 1 << 22                # largest table of patterns (path, pattern, feature) of one length of paths


def ensemble_nodes(model, spark: SparkSession) -> DataFrame:
    """The relation of nodes: ``left`` (at most the threshold) and ``right`` are
    nodes of the same tree, ``feature`` is -1 at a leaf; ``value`` is what the
    leaf adds to the margin (a forest's is its share of class 1)."""
    if isinstance(model, (Booster, RandomForest)):
        return spark.createDataFrame(model.nodes(), NODES)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    raw = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    if not raw.where("split.numCategories > 0").isEmpty():
        raise ValueError("splits by categories have no interval")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in model.treeWeights]), F.col("treeID") + 1)
    stats = F.col("impurityStats")
    if type(model).__name__.startswith("GBT"):
        value, cover = F.col("prediction") * weight, F.col("rawCount").cast("double")
    else:
        value, cover = stats[1] / (stats[0] + stats[1]) / F.lit(float(len(model.treeWeights))), stats[0] + stats[1]
    leaf = F.col("leftChild") < 0
    return raw.select(F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                      F.when(leaf, -1).otherwise(F.col("split.featureIndex")).alias("feature"),
                      F.when(leaf, 0.0).otherwise(F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), cover.alias("cover"), value.alias("value"))


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, value, path): ``path`` has one (feature, low, high, ratio) per
    feature on the way; a row follows it where low < x <= high."""
    nodes = cut_lineage(nodes)
    inf = F.lit(float("inf"))
    ways = nodes.where("node = 0").withColumn("path", F.array().cast("array<struct<feature:int,low:double,high:double,ratio:double>>"))
    leaves = None
    while not ways.isEmpty():
        done = ways.where("feature < 0").select("tree", F.col("node").alias("leaf"), "value", "path")
        leaves = done if leaves is None else leaves.unionByName(done)
        inner = ways.where("feature >= 0").select("tree", "feature", "threshold", F.col("cover").alias("above"), "path",
                                                  F.explode(F.array(F.struct(F.col("left").alias("node"), F.lit(True).alias("low_side")),
                                                                    F.struct(F.col("right").alias("node"), F.lit(False).alias("low_side")))).alias("to"))
        step = F.struct(F.col("above_feature").alias("feature"), F.when(F.col("low_side"), -inf).otherwise(F.col("cut")).alias("low"),
                        F.when(F.col("low_side"), F.col("cut")).otherwise(inf).alias("high"), (F.col("cover") / F.col("above")).alias("ratio"))
        ways = cut_lineage(inner.select("tree", F.col("to.node").alias("node"), F.col("to.low_side").alias("low_side"), F.col("feature").alias("above_feature"),
                                        F.col("threshold").alias("cut"), "above", F.col("path").alias("so_far"))
                           .join(nodes, ["tree", "node"]).withColumn("path", F.concat("so_far", F.array(step)))
                           .select(*nodes.columns, "path"))
    if leaves is None:
        return nodes.select("tree", F.col("node").alias("leaf"), "value", F.array().cast("array<struct<feature:int,low:double,high:double,ratio:double>>").alias("path"))
    one = leaves.select("tree", "leaf", "value", F.explode_outer("path").alias("p"))
    merged = one.groupBy("tree", "leaf", "value", F.col("p.feature").alias("feature")).agg(
        F.max("p.low").alias("low"), F.min("p.high").alias("high"), F.product("p.ratio").alias("ratio"))
    return merged.groupBy("tree", "leaf", "value").agg(
        F.sort_array(F.collect_list(F.when(F.col("feature").isNotNull(), F.struct("feature", "low", "high", "ratio")))).alias("path"))


def _pattern_table(value: np.ndarray, ratio: np.ndarray, points: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(feature on the path, path, pattern): the Shapley value when the features
    whose bit is set hold their intervals."""
    m = ratio.shape[1]
    held = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
    total = np.zeros((len(value), 1 << m, m))
    for t, w in zip(points, weights):
        term = (1 - t) * ratio[:, None] + t * held
        total += w * term.prod(axis=2, keepdims=True) / term
    return np.ascontiguousarray(np.moveaxis(value[:, None, None] * (held - ratio[:, None]) * total, 2, 0))


def _look_up(columns: np.ndarray, feature: np.ndarray, low: np.ndarray, high: np.ndarray, table: np.ndarray, sums: np.ndarray) -> None:
    """Adds each row's entries of the table to ``sums``; ``columns`` and ``sums``
    have one line per feature."""
    paths, m = feature.shape
    block = max(1, PAIRS // max(1, columns.shape[1]))
    for a in range(0, paths, block):
        s = slice(a, a + block)
        at = np.arange(paths)[s, None] << m
        for k in range(m):
            mine = columns[feature[s, k]]
            at = at | ((mine > low[s, k, None]) & (mine <= high[s, k, None])).astype(np.int64) << k
        for k in range(m):
            order = np.argsort(feature[s, k], kind="stable")
            sorted_ = feature[s, k][order]
            cut = np.flatnonzero(np.concatenate([[True], np.diff(sorted_) > 0]))
            sums[sorted_[cut]] += np.add.reduceat(table[k].ravel().take(at[order]), cut, axis=0)


class _Paths:
    """The paths as arrays, by their number of features."""

    def __init__(self, paths: DataFrame) -> None:
        groups: dict[int, list] = {}
        for r in paths.orderBy("tree", "leaf").collect():  # as many rows as the model has leaves
            groups.setdefault(len(r["path"]), []).append(r)
        self.constant = sum(r["value"] for r in groups.pop(0, []))
        self.groups = []
        self.expected = self.constant
        for m, rows in sorted(groups.items()):
            get = lambda name, kind: np.array([[p[name] for p in r["path"]] for r in rows], kind)  # noqa: E731, B023
            value, ratio = np.array([r["value"] for r in rows]), get("ratio", float)
            self.expected += float(value @ ratio.prod(axis=1))
            t, w = np.polynomial.legendre.leggauss(m // 2 + 1)
            points, weights = (t + 1) / 2, w / 2
            table = _pattern_table(value, ratio, points, weights) if len(rows) * m << m <= TABLE else None
            self.groups.append((value, get("feature", int), get("low", float), get("high", float), ratio, points, weights, table))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape)
        columns, sums = np.ascontiguousarray(x.T), np.zeros(x.shape[::-1])
        for value, feature, low, high, ratio, points, weights, table in self.groups:
            if table is not None:
                _look_up(columns, feature, low, high, table, sums)
                continue
            block = max(1, CELLS // max(1, x.shape[0] * feature.shape[1]))
            for a in range(0, len(value), block):
                s = slice(a, a + block)
                mine = x[:, feature[s]]
                held = ((mine > low[s]) & (mine <= high[s])).astype(float)
                total = np.zeros(held.shape)
                for t, w in zip(points, weights):
                    term = (1 - t) * ratio[s] + t * held
                    total += w * term.prod(axis=2, keepdims=True) / term
                part = (value[s, None] * (held - ratio[s]) * total).reshape(len(x), -1)
                flat = feature[s].ravel()
                order = np.argsort(flat, kind="stable")
                cut = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
                out[:, flat[order][cut]] += np.add.reduceat(part[:, order], cut, axis=1)
        return out + sums.T


def prefix_margins(paths: DataFrame, data: DataFrame, keep: Sequence[str], features: str = "features") -> DataFrame:
    """(keep..., margins): a row's margin after each tree, in tree order."""
    ship_package(data.sparkSession)
    rows = paths.orderBy("tree", "leaf").collect()         # as many as the model has leaves
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["tree"], []).append((r["value"], [(p["feature"], p["low"], p["high"]) for p in r["path"]]))
    shared = data.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            x = rb.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, -1)
            out = np.zeros((len(x), len(shared.value)))
            for i, (_, leaves) in enumerate(sorted(shared.value.items())):
                for value, path in leaves:
                    held = np.ones(len(x), bool)
                    for f, low, high in path:
                        held &= (x[:, f] > low) & (x[:, f] <= high)
                    out[held, i] = value
            yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in keep), pa.array(out.cumsum(axis=1).tolist(), pa.list_(pa.float64()))], [*keep, "margins"])
    kinds = dict(data.dtypes)
    return data.select(*keep, vector_to_array(features).alias("_x")).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", margins array<double>")


def tree_contributions(model, data: DataFrame, feature_cols: Sequence[str], key: str, features: str = "features") -> tuple[DataFrame, DataFrame, float]:
    """(local, global, expected): per row ``contrib_<feature>`` of every feature,
    which with ``expected`` add up to the row's margin; per feature the mean
    absolute contribution, largest first."""
    spark = data.sparkSession
    ship_package(spark)
    paths = _Paths(leaf_paths(ensemble_nodes(model, spark)))
    shared = spark.sparkContext.broadcast(paths)           # as large as the model
    names = [f"contrib_{c}" for c in feature_cols]

    def run(batches):
        for rb in batches:
            for a in range(0, rb.num_rows, 1024):
                part = rb.slice(a, 1024)
                x = part.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                phi = shared.value.contributions(x)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(np.ascontiguousarray(phi[:, j])) for j in range(len(names)))], [key, *names])
    kind = dict(data.dtypes)[key]
    schema = ", ".join([f"`{key}` {kind}", *(f"`{n}` double" for n in names)])
    local = data.select(key, vector_to_array(features).alias("_x")).mapInArrow(run, schema)
    means = local.agg(*[F.avg(F.abs(F.col(f"`{n}`"))).alias(c) for n, c in zip(names, feature_cols)])
    glob = means.unpivot([], list(means.columns), "feature", "mean_abs_contribution").orderBy(F.col("mean_abs_contribution").desc(), "feature")
    return local, glob, paths.expected
