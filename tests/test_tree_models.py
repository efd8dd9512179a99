"""Leaf-wise boosting and tree attributions against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.operators import attribution as A
from riskframe.operators import extratrees as T
from riskframe.operators import leafwise as W
from riskframe.operators import models as J
from riskframe.session import cut_lineage

FEATS = list("abcd")
PLAIN = {"subsample": 1.0, "colsample": 1.0, "min_child": 8, "max_leaves": 9}


@pytest.fixture(autouse=True, params=[20_000])
def task_rows(request, monkeypatch):
    monkeypatch.setattr(W, "TASK_ROWS", request.param)


several_tasks = pytest.mark.parametrize("task_rows", [100], indirect=True)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(3)
    n = 500
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=n) * 0.5 > 0.4).astype(int)
    d = spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(n)], "id long, y int, a double, b double, c double, d double")
    return cut_lineage(J.assemble(d.repartition(3), FEATS))


def local_rows(data):
    rows = data.select("id", "y", vector_to_array("features").alias("x")).orderBy("id").collect()
    return np.array([r["id"] for r in rows]), np.array([r["y"] for r in rows]), np.array([r["x"] for r in rows])


def plain_best_first(bins, g, h, max_leaves, min_child, l2=0.0):
    """{leaf rows: value} of a tree that splits one leaf at a time."""
    def score(s):
        return g[s].sum() ** 2 / (h[s].sum() + l2)

    def best(s):
        found = (-1.0, None)
        for f in range(bins.shape[1]):
            for cut in range(bins[:, f].max() + 1):
                left, right = s[bins[s, f] <= cut], s[bins[s, f] > cut]
                if min(len(left), len(right)) >= min_child:
                    gain = round(score(left) + score(right) - score(s), 9)
                    if gain > found[0]:
                        found = (gain, (left, right))
        return found
    leaves = [np.arange(len(g))]
    options = [best(leaves[0])]
    while len(leaves) < max_leaves and max(o[0] for o in options) > 0:
        i = max(range(len(options)), key=lambda j: options[j][0])
        for part in options[i][1]:
            leaves.append(part)
            options.append(best(part))
        del leaves[i], options[i]
    return {frozenset(s.tolist()): -0.05 * g[s].sum() / (h[s].sum() + l2) for s in leaves}


@pytest.mark.parametrize("l2", [0.0, 3.0])
def test_first_trees_equal_plain_best_first_growth(data, l2):
    ids, y, x = local_rows(data)
    booster = W.fit_leafwise(data, [F.lit(True)], [{**PLAIN, "n_iter": 2, "l2": l2}])[0]
    bins = W.to_bins(x, booster.edges).astype(int)
    w = len(y) / (2 * np.bincount(y))[y]
    margin = np.full(len(y), booster.base)
    assert abs(booster.base) < 1e-12                       # balanced weights
    for tree in booster.trees:
        p = 1 / (1 + np.exp(-margin))
        want = plain_best_first(bins, w * (p - y), w * p * (1 - p), 9, 8, l2)
        place = tree.place(bins.astype(np.uint8))
        got = {frozenset(np.flatnonzero(place == n).tolist()): tree.value[n] for n in np.unique(place)}
        assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-9 for s in want)
        margin += tree.value[place]
    assert np.abs(booster.margins(x) - margin).max() < 1e-12


@several_tasks
def test_models_side_by_side_partitions_and_odd_rows(data, monkeypatch):
    monkeypatch.setattr(W, "REFRESH", 2)
    odd = data.withColumn("y", F.when(F.col("id") % 50 != 0, F.col("y")))
    params = [{"n_iter": 5, "min_child": 10}, {"n_iter": 3, "max_leaves": 4, "learning_rate": 0.2}]
    masks = [F.col("id") % 3 != 0, F.col("id") % 3 != 1]
    both = W.fit_leafwise(odd, masks, params)
    for m in range(2):
        alone = W.fit_leafwise(odd.repartition(5), [masks[m]], [params[m]])[0]
        x = local_rows(data)[2]
        assert len(alone.trees) == params[m]["n_iter"] and np.abs(alone.margins(x) - both[m].margins(x)).max() < 1e-9
    scored = W.score_leafwise(both[0], data, ["id", "y"])
    assert scored.count() == 500 and 0 < scored.agg(F.min("score")).first()[0]
    constant = W.fit_leafwise(data.where("y = 1"), [F.lit(True)], [{"n_iter": 2}])[0]
    assert len(constant.trees) == 2 and all(len(t.feature) == 1 for t in constant.trees)


def test_one_task_and_several_grow_the_same_trees(data, monkeypatch):
    settings = [{"n_iter": 3, "min_child": 10}, {"n_iter": 2, "max_leaves": 5, "l2": 1.0}]
    masks = [F.lit(True), F.col("id") % 2 == 0]
    one = W.fit_leafwise(data, masks, settings)
    monkeypatch.setattr(W, "TASK_ROWS", 100)
    for a, b in zip(one, W.fit_leafwise(data, masks, settings)):
        assert [t.feature.tolist() for t in a.trees] == [t.feature.tolist() for t in b.trees]
        assert all(np.allclose(x.value, y.value) for x, y in zip(a.trees, b.trees))


def test_stops_where_each_prefix_scored_apart_is_best(data, monkeypatch):
    monkeypatch.setattr(W, "REFRESH", 4)
    valid = F.col("id") % 4 == 0
    settings = {**PLAIN, "n_iter": 40, "learning_rate": 0.5}
    stopped = W.fit_leafwise(data, [~valid], [settings], valid=valid, patience=6)[0]
    whole = W.fit_leafwise(data, [~valid], [{**settings, "n_iter": len(stopped.auc)}])[0]
    ids, y, x = local_rows(data)
    y, x = y[ids % 4 == 0], x[ids % 4 == 0]
    auc = []
    for i in range(len(whole.trees)):
        s = W.Booster(whole.edges, whole.base, whole.trees[:i + 1]).margins(x)
        auc.append(np.mean([(a > b) + (a == b) / 2 for a in s[y == 1] for b in s[y == 0]]))
    assert np.allclose(auc, stopped.auc) and len(stopped.trees) == int(np.argmax(auc)) + 1
    assert len(stopped.trees) + 6 <= len(stopped.auc) < 40


# --- attributions ------------------------------------------------------------------
def shapley(nodes, x, d):
    """Shapley values of one row by all subsets: a feature outside the coalition
    follows both branches by their covers."""
    def worth(n, s):
        if n["feature"] < 0:
            return n["value"]
        left, right = nodes[n["tree"], n["left"]], nodes[n["tree"], n["right"]]
        if n["feature"] in s:
            return worth(left if x[n["feature"]] <= n["threshold"] else right, s)
        return (left["cover"] * worth(left, s) + right["cover"] * worth(right, s)) / n["cover"]
    roots = [n for (_, i), n in nodes.items() if i == 0]
    v = {s: sum(worth(n, s) for n in roots) for k in range(d + 1) for s in itertools.combinations(range(d), k)}
    phi = []
    for f in range(d):
        rest = [g for g in range(d) if g != f]
        phi.append(sum(math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) * (v[tuple(sorted((*s, f)))] - v[s])
                       for k in range(d) for s in itertools.combinations(rest, k)))
    return phi, v[()]


@pytest.mark.parametrize("kind", ["forest", "gbt", "leafwise"])
def test_contributions_equal_subset_enumeration(spark, data, kind):
    if kind == "leafwise":
        model = W.fit_leafwise(data, [F.lit(True)], [{**PLAIN, "n_iter": 4}])[0]
        margins = dict(zip(*(v.tolist() for v in (local_rows(data)[0], model.margins(local_rows(data)[2]) - model.base))))
    else:
        model, _ = J.fit(kind, data, params={"forest": {"numTrees": 5}, "gbt": {"maxIter": 4}}[kind] | {"minInstancesPerNode": 5, "maxDepth": 5})
        out = model.transform(data).select("id", vector_to_array("rawPrediction" if kind == "gbt" else "probability")[1].alias("m"))
        margins = {r["id"]: r["m"] for r in out.collect()}
    local, glob, expected = A.tree_contributions(model, data, FEATS, "id")
    rows = {r["id"]: [r[f"contrib_{c}"] for c in FEATS] for r in local.collect()}
    assert set(rows) == set(margins) and all(abs(expected + sum(v) - margins[i]) < 1e-9 for i, v in rows.items())
    nodes = {(r["tree"], r["node"]): r for r in A.ensemble_nodes(model, spark).collect()}
    ids, _, x = local_rows(data)
    for i in range(0, 500, 61):
        phi, base = shapley(nodes, x[i], 4)
        assert abs(base - expected) < 1e-9 and np.allclose(phi, rows[int(ids[i])], atol=1e-9)
    assert {r["feature"] for r in glob.collect()} == set(FEATS)


def test_contributions_looked_up_equal_integrated_ones(spark, data, monkeypatch):
    model, _ = J.fit("gbt", data, params={"maxIter": 3, "minInstancesPerNode": 5, "maxDepth": 5})
    paths = A.leaf_paths(A.ensemble_nodes(model, spark))
    looked_up = A._Paths(paths)
    monkeypatch.setattr(A, "TABLE", 0)
    integrated = A._Paths(paths)
    assert all(g[-1] is not None for g in looked_up.groups) and all(g[-1] is None for g in integrated.groups)
    x = local_rows(data)[2]
    x = np.concatenate([x, np.full((1, x.shape[1]), np.nan)])
    monkeypatch.setattr(A, "PAIRS", 3 * len(x))                          # several blocks of paths
    assert np.allclose(looked_up.contributions(x), integrated.contributions(x), rtol=0, atol=1e-12)
    assert np.allclose(looked_up.contributions(x[:1]), integrated.contributions(x[:1]), rtol=0, atol=1e-12)


# --- extremely randomised trees -------------------------------------------------------
def plain_extra_tree(x, y, w, rows, tree, node, seed, least, count, out):
    """Recursion over (node id, rows); ids are given level by level, so by a queue."""
    queue, size = [(0, rows)], 1
    while queue:
        node, rows = queue.pop(0)
        whole = np.array([w[0] * (y[rows] == 0).sum(), w[1] * (y[rows] == 1).sum()])
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        best = (0.0, None)
        if len(rows) >= 2 * least and whole.min() > 0:
            chosen = [f for f in T.drawn(seed, tree, node, x.shape[1]) if high[f] > low[f]][:count]
            for f in chosen:
                cut = T.threshold_at(seed, tree, node, np.array([f]), low[[f]], high[[f]])[0]
                left = x[rows, f] <= cut
                if min(left.sum(), (~left).sum()) >= least:
                    a = np.array([w[0] * (y[rows[left]] == 0).sum(), w[1] * (y[rows[left]] == 1).sum()])
                    gini = [2 * s[0] * s[1] / s.sum() if s.sum() else 0.0 for s in (whole, a, whole - a)]
                    gain = round(gini[0] - gini[1] - gini[2], 9)
                    if gain > best[0]:
                        best = (gain, (f, cut, rows[left], rows[~left]))
        if best[1] is None:
            out[node] = (rows, whole[1] / whole.sum())
            continue
        for part in best[1][2:]:
            queue.append((size, part))
            size += 1
    return out


@several_tasks
def test_extra_trees_equal_plain_growth(data):
    params = {"n_trees": 3, "min_leaf": 15}
    forest = T.fit_extra_trees(data, params)
    again = T.fit_extra_trees(data.repartition(6), params)
    _, y, x = local_rows(data)
    w = len(y) / (2 * np.bincount(y))
    for i, tree in enumerate(forest.trees):
        want = plain_extra_tree(x, y, w, np.arange(len(y)), i, 0, 42, 15, 2, {})
        place = tree.place(x)
        assert {n: frozenset(np.flatnonzero(place == n)) for n in np.unique(place)} == {n: frozenset(r) for n, (r, _) in want.items()}
        assert all(abs(tree.value[n] - v) < 1e-9 for n, (_, v) in want.items()) and tree.feature == again.trees[i].feature
    assert forest.trees[0].feature != forest.trees[1].feature
    scored = {r["id"]: r["score"] for r in J.score(forest, data).collect()}
    assert np.allclose([scored[i] for i in local_rows(data)[0]], forest.scores(x))
    local, _, expected = A.tree_contributions(forest, data, FEATS, "id")
    assert all(abs(expected + sum(r[f"contrib_{c}"] for c in FEATS) - scored[r["id"]]) < 1e-9 for r in local.collect())
    assert len(T.fit_extra_trees(data.where("y = 1"), params).trees[0].feature) == 1


def test_extra_trees_send_one_array_a_tree(data, monkeypatch):
    import pyarrow as pa
    forest = T.fit_extra_trees(data, {"n_trees": 3, "min_leaf": 15})
    _, y, x = local_rows(data)
    batch = pa.RecordBatch.from_pydict({"x": pa.array(x.tolist()), "y": pa.array(y)})
    level = {t: (T._shape(tree), np.unique(tree.place(x)), np.tile([0, 1], (len(np.unique(tree.place(x))), 1))) for t, tree in enumerate(forest.trees)}
    assert sum(rb.num_rows for rb in T._range_pass(level)([batch, batch])) == 3 < sum(len(v[1]) for v in level.values())
    monkeypatch.setattr(T, "WAVE_NODES", 1)                # one tree after another: the same trees
    assert [t.feature for t in T.fit_extra_trees(data, {"n_trees": 3, "min_leaf": 15}).trees] == [t.feature for t in forest.trees]


@pytest.mark.parametrize("task_rows", [200], indirect=True)
def test_a_table_that_one_task_can_hold_takes_one_job_a_tree(data, monkeypatch):
    monkeypatch.setattr(W, "_histogram_pass", lambda *a: pytest.fail("a round over several tasks"))
    assert len(W.fit_leafwise(data, [F.lit(True)], [{**PLAIN, "n_iter": 2}])[0].trees) == 2


def test_rounds_add_up_few_trees_to_the_margins(data, monkeypatch):
    longest, one_task = [], W._one_task_pass

    def seen(jobs, *rest):
        longest.append(max(len(job[2]) for job in jobs.values()))
        return one_task(jobs, *rest)
    monkeypatch.setattr(W, "_one_task_pass", seen)
    W.fit_leafwise(data, [F.lit(True)], [{**PLAIN, "n_iter": 8}])
    assert max(longest) < 5


def test_prefixes_of_a_gbt_scored_apart(data):
    model, _ = J.fit("gbt", data, params={"maxIter": 6, "minInstancesPerNode": 5})
    aucs = {r["n_trees"]: r["roc_auc"] for r in J.prefix_aucs(model, data).collect()}
    _, y, x = local_rows(data)
    nodes = {(r["tree"], r["node"]): r for r in A.ensemble_nodes(model, data.sparkSession).collect()}

    def value(tree, row):
        n = nodes[tree, 0]
        while n["feature"] >= 0:
            n = nodes[tree, n["left"] if row[n["feature"]] <= n["threshold"] else n["right"]]
        return n["value"]
    margin = np.zeros(len(y))
    for t in range(6):
        margin += [value(t, row) for row in x]
        a, b = margin[y == 1], margin[y == 0]
        assert abs(aucs[t + 1] - np.mean((a[:, None] > b) + (a[:, None] == b) / 2)) < 1e-9
    inner = data.withColumn("is_valid", F.col("id") % 4 == 0)
    found, trees = J.early_stopped("gbt", inner, "is_valid", params={"maxIter": 8, "minInstancesPerNode": 5}, patience=2)
    assert 1 <= trees <= 8 and found.getNumTrees == 8


def test_trees_between_two_looks_at_the_auc_take_one_job(data, monkeypatch):
    calls, one_task = [], W._one_task_pass

    def seen(jobs, first, count, *rest):
        calls.append((first, count))
        return one_task(jobs, first, count, *rest)
    monkeypatch.setattr(W, "_one_task_pass", seen)
    settings = [{**PLAIN, "n_iter": 12}, {**PLAIN, "n_iter": 30, "min_child": 20}, {**PLAIN, "n_iter": 12, "max_leaves": 4}]
    several = W.fit_leafwise(data, [F.lit(True)] * 3, settings)
    assert calls == [(0, 12), (12, 13), (25, 5)]
    assert [len(b.trees) for b in several] == [12, 30, 12] and max(len(t.feature) for t in several[2].trees) == 7
    alone = W.fit_leafwise(data, [F.lit(True)], settings[1:2])[0]
    x = local_rows(data)[2]
    assert np.array_equal(alone.margins(x), several[1].margins(x))


def test_joint_sums_equal_sums_feature_by_feature(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(W, "JOINT", 30)
    rng, sizes = np.random.RandomState(1), [5, 2, 7, 2, 3, 64]
    bins = np.array([[rng.randint(n) for n in sizes] for _ in range(200)], np.uint8)
    batch = pa.RecordBatch.from_pydict({"bins": [r.tobytes() for r in bins], "y": rng.randint(0, 2, 200).astype(float), "rid": pa.array(range(200), pa.int64()),
                                        "margin": [[0.0]] * 200, "inside": [[True]] * 200})
    held = W._Held([W._Rows(batch, len(sizes))] * 2, sizes)
    assert sorted(f for group, _ in held.joint for f in group) == list(range(6)) and len(held.joint) == 3
    unit, rows = W.exact_unit(400, np.ones(2)), np.flatnonzero(rng.rand(400) < 0.7)
    g, h = W._slopes(rng.normal(size=400), held.y, np.ones(2), unit)
    sums = held.sums(rows, (g, h, None))
    for f in range(6):
        for b in range(64):
            sel = rows[held.columns[f][rows] == b]
            assert sums[:, f, b].tolist() == [g[sel].sum(), h[sel].sum(), len(sel)]           # exact in any order


def test_extra_trees_grown_apart_equal_those_grown_over_all_tasks(data, monkeypatch):
    x = F.col("x")
    odd = J.assemble(data.select("id", "y", vector_to_array("features").alias("x"))
                     .select("id", "y", x[0].alias("a"), F.floor(x[1]).cast("double").alias("b"), F.lit(1.0).alias("c"), (x[3] * F.col("id")).alias("d")), FEATS)
    params = {"n_trees": 9, "min_leaf": 4, "max_features": 0.75}
    with monkeypatch.context() as m:
        m.setattr(T, "_drawn_splits", lambda *a: pytest.fail("a level over all tasks"))
        apart = [T.fit_extra_trees(d, p).trees for d, p in ((data, params), (odd, params), (odd, {**params, "max_depth": 3}))]
    monkeypatch.setattr(T, "HELD", 0)
    for ours, (d, p) in zip(apart, ((data, params), (odd, params), (odd, {**params, "max_depth": 3}))):
        theirs = T.fit_extra_trees(d, p).trees
        for a, b in zip(ours, theirs, strict=True):
            assert len(a.feature) > 7 and all(getattr(a, c) == getattr(b, c) for c in ("feature", "threshold", "left", "right", "rows"))
            assert np.allclose(a.value, b.value, rtol=0, atol=1e-15)
