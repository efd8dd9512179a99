import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import ngram_join as J
from riskframe.llm.links import components

SF = "/root/testdata/sf0.001"


def planted(seed, groups=120):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(60)]
    rows, d = [], 10 ** 6
    for _ in range(groups):
        n = rnd.choice([1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 80, 150])
        base = [rnd.choice(voc) for _ in range(n)]
        for _ in range(rnd.randint(1, 5)):
            b = list(base)
            for _ in range(rnd.randint(0, max(1, n // 25))):
                b[rnd.randrange(n)] = rnd.choice(voc)
            if rnd.random() < .2:
                b += [rnd.choice(voc) for _ in range(n // 8)]
            rows.append((d, " ".join(b)))
            d += 1
    return rows


def result(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, fp int, cells int")
    return brute.order(tuple(r) for r in J.jaccard_components(df, **kw).collect())


def test_matches_brute_force_with_edge_cases(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] + planted(5)
    rows += [(-1, None), (-2, ""), (-3, " \n\t"), (None, rows[0][1]), (None, "x"), rows[3], rows[3], (rows[4][0], "other words here"),
             (-4, "A B c"), (-5, "a b C"), (-6, "a b c d")]
    assert result(spark, rows) == brute.jaccard_components(rows)


def test_small_blocks_and_other_thresholds(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 3)
    rows = planted(9, 60)
    for k, percent in ((5, 80), (2, 90), (3, 60)):
        assert result(spark, rows, k=k, percent=percent) == brute.jaccard_components(rows, k, percent)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_large_group_of_near_copies_is_one_component(spark):
    rnd = random.Random(1)
    base = [f"x{i}" for i in range(200)]
    rows = []
    for d in range(300):
        b = list(base)
        b[rnd.randrange(200)] = f"y{d}"
        rows.append((d, " ".join(b)))
    assert {r[2] for r in result(spark, rows)} == {0}


def test_linked_sets_share_the_cells_their_class_promises():
    rnd = np.random.RandomState(3)
    for _ in range(300):
        n = int(rnd.choice([1, 3, 4, 7, 8, 9, 16, 17, 33, 64, 70, 300]))
        a = np.unique(rnd.randint(0, 2 ** 63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        gone, new = rnd.randint(0, n // 9 + 1), rnd.randint(0, n // 9 + 1)
        b = np.unique(np.concatenate([a[gone:], rnd.randint(0, 2 ** 63, new).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if shared and 100 * shared >= 80 * (len(a) + len(b) - shared):
            both = np.intersect1d(J.cells(a, 80), J.cells(b, 80)) & np.uint64(63)
            assert any((both == c).sum() >= J._slabs(int(c), 80)[1] for c in set(both.tolist()))


def test_tree_pairs_hold_every_pair_within_the_bound():
    rnd = np.random.RandomState(4)
    vecs = rnd.poisson(3, (300, 64)).astype(np.int32)
    vecs[150:] = vecs[:150] + (rnd.rand(150, 64) < 0.05)
    sizes = vecs.sum(axis=1)
    got = {tuple(sorted((int(a), int(b)))) for x, y in J.CountTree(vecs, sizes).pairs(80) for a, b in zip(x, y)}
    bound = np.minimum(vecs[:, None], vecs[None]).sum(axis=2)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if bound[i, j] * 180 >= 80 * (sizes[i] + sizes[j])}
    assert got == want and len(want) >= 150


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_stage_keeps_one_document_of_each_group(spark):
    rows = planted(11, 60) + [(-1, None, ), (-1, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows + [rows[0]]], "doc_id long, text string, _gone string")
    got = J.stage_near_duplicates(spark, df, SF)
    assert got.columns == df.columns
    keep = {d for d, n, c in brute.jaccard_components(rows) if c == d}
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(keep)


@pytest.mark.parametrize("n", [1, 5, 64, 1000])
def test_fingerprint_ignores_order(n):
    s = np.unique(np.random.RandomState(n).randint(0, 2 ** 63, n).astype(np.uint64))
    assert J.fingerprint(s) == J.fingerprint(s[::-1].copy()) != J.fingerprint(s[1:])


def alike(rnd, base, changed, n):
    """``n`` texts that replace ``changed`` words of one text, each by words of its own."""
    out = []
    for d in range(n):
        words = list(base)
        for i in rnd.sample(range(len(words)), changed):
            words[i] = f"w{d}x{i}"
        out.append(" ".join(words))
    return out


def test_alike_texts_that_do_not_link_make_no_pairs():
    """A run puts out at most one row for each of its components, whatever number
    of pairs survives the bound."""
    texts = alike(random.Random(5), [f"b{i}" for i in range(200)], 5, 60)
    sets = list(J.shingle_sets(pa.array(texts), 5))
    rows = pa.RecordBatch.from_pydict({"cell": [1] * 60, "lo": [0] * 60, "hi": [0] * 60, "part": [0] * 60, "fp": list(range(60)), "comp": list(range(60)),
                                       "n": [len(s) for s in sets], "vec": [J.point(s) for s in sets]})
    out = pa.Table.from_batches(J._tree_pass(60)(iter([rows]))).to_pylist()
    assert sorted(r["v"] for r in out) == list(range(1, 60)) and {r["u"] for r in out} == {0}
    shared = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for t in (60, 65, 70, 80):
        u, v = J._links(np.arange(60), np.arange(60), np.zeros(60, int), sets, t)
        want = [(i, j) for i in range(60) for j in range(i) if shared[i][j] * (100 + t) >= (len(sets[i]) + len(sets[j])) * t]
        assert all((max(p), min(p)) in want for p in zip(u, v)) and len(u) < 60

        def reach(pairs):
            root = list(range(60))
            for a, b in pairs:
                root = [root[a] if r == root[b] else r for r in root]
            return [min(i for i in range(60) if root[i] == r) for r in root]
        assert reach(zip(u, v)) == reach(want)


def test_group_of_alike_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    monkeypatch.setattr(J, "TOKENS", 1000)
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = list(enumerate(alike(rnd, base, 2, 30) + alike(rnd, base, 1, 6) + alike(rnd, base, 3, 20)))
    assert result(spark, rows) == brute.jaccard_components(rows)
