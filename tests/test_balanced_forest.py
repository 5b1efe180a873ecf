"""The per-tree balanced forest against a plain version that grows every tree in one place."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from riskloom.plans import balanced_forest as bf


def sample(n=300, features=9, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, features)), 2)
    x[:, 3] = rng.integers(0, 3, n)
    x[:, 4] = 1.0
    score = x[:, 0] + 0.5 * x[:, 1] * x[:, 3]
    y = np.where(score > 1.2, 2, np.where(score > 0, 1, 0))
    return x, y


def framed(spark, rows, schema):
    """The rows with their last column, an array, as a vector."""
    return spark.createDataFrame(rows, schema + ", x array<double>").select("*", array_to_vector("x").alias("features")).drop("x")


def plain_weight(key, tree, seed):
    digest = hashlib.md5(f"{seed}:{key}:{tree // 4}".encode()).digest()
    u = int.from_bytes(digest[4 * (tree % 4):4 * (tree % 4) + 4], "big") / 2**32
    total, k = math.exp(-1), 0
    while u >= total:
        k += 1
        total += math.exp(-1) / math.factorial(k)
    return k


def plain_tree(x, y, keys, cuts, tree, s):
    """{node: (feature, bin, counts)} by scanning all rows for every split."""
    w = np.array([plain_weight(k, tree, s.seed) for k in keys])
    totals = np.array([w[y == c].sum() for c in range(3)])
    some = totals > 0
    of_class = [totals.sum() / (some.sum() * t) if t else 0.0 for t in totals] if s.balanced else [1.0] * 3
    out, stack = {}, [(1, np.flatnonzero(w))]
    while stack:
        node, rows = stack.pop()
        counts = [int(w[rows][y[rows] == c].sum()) for c in range(3)]
        best = None
        if node < 2**s.depth and sum(c > 0 for c in counts) > 1 and sum(counts) >= 2 * s.min_instances:
            weighed = np.array(counts) * of_class
            bar = (weighed**2).sum() / weighed.sum() * (1 + 1e-12)
            for f in bf.features_of_node(tree, node, x.shape[1], s):
                for b, cut in enumerate(cuts[f]):
                    goes = x[rows, f] <= cut
                    left = np.array([w[rows][goes & (y[rows] == c)].sum() for c in range(3)])
                    right = np.array(counts) - left
                    if min(left.sum(), right.sum()) < s.min_instances:
                        continue
                    purity = sum((part * of_class)[k] ** 2 for part in (left,) for k in range(3)) / (left * of_class).sum()
                    purity += sum((right * of_class)[k] ** 2 for k in range(3)) / (right * of_class).sum()
                    if purity > bar and (best is None or purity > best[0] * (1 + 1e-13)):
                        best = purity, int(f), b, goes
        if best is None:
            out[node] = (-1, 0, counts)
            continue
        out[node] = (best[1], best[2], counts)
        stack += [(2 * node, rows[best[3]]), (2 * node + 1, rows[~best[3]])]
    return out


@pytest.mark.parametrize("local", [10**6, 40, 0])
def test_every_tree_equals_the_plain_version(spark, local):
    x, y = sample()
    rows = [(i, "k", int(y[i]) if i % 50 else None, x[i].tolist()) for i in range(len(y))]
    frame = framed(spark, rows, "id long, part string, label int").repartition(5)
    s = bf.ForestSettings(trees=6, depth=4, min_instances=3, bins=16, seed=7, local_instances=local)
    forest = bf.fit_balanced_forest(frame, ["id", "part"], "label", settings=s)
    known = np.array([i for i in range(len(y)) if i % 50])
    for tree in range(s.trees):
        got = {n[1]: (n[2], n[3], n[4]) for n in forest.nodes if n[0] == tree}
        assert got == plain_tree(x[known], y[known], [f"{i}|k" for i in known], forest.cuts, tree, s)


def test_scores_and_balance(spark):
    x, y = sample(600)
    y = np.where(y == 2, (np.arange(600) % 4 == 0) * 2, y)   # a rare class
    frame = framed(spark, [(i, int(y[i]), x[i].tolist()) for i in range(600)], "id long, label int")
    scores = {}
    for balanced in (True, False):
        s = bf.ForestSettings(trees=12, depth=6, seed=3, balanced=balanced)
        forest = bf.fit_balanced_forest(frame, ["id"], "label", settings=s)
        rows = {r["id"]: (r["p0"], r["p1"], r["p2"]) for r in bf.with_probabilities(frame, forest).collect()}
        p = np.array([rows[i] for i in range(600)])
        assert np.allclose(p, bf.class_probabilities(x, forest)) and np.allclose(p.sum(axis=1), 1)
        scores[balanced] = p
    rare = y == 2
    assert scores[True][rare, 2].mean() > scores[False][rare, 2].mean()
    for tree, (feature, cut, left, right, share) in enumerate(forest.trees):
        assert ((feature < 0) == (left < 0)).all() and np.allclose(share.sum(axis=1), 1)


def test_draws_are_poisson_and_repeat():
    w = np.array([bf.poisson_weights(f"row {i}", 40, 1) for i in range(2000)])
    assert (w == np.array([bf.poisson_weights(f"row {i}", 40, 1) for i in range(2000)])).all()
    assert abs(w.mean() - 1) < 0.02 and abs((w == 0).mean() - math.exp(-1)) < 0.01
    assert all(bf.poisson_weights("a", 9, 4)[t] == plain_weight("a", t, 4) for t in range(9))


def test_no_rows_one_class_and_unknown_values(spark):
    empty = framed(spark, [], "id long, label int")
    assert bf.fit_balanced_forest(empty, ["id"], "label").trees == []
    rows = [(i, 1, [float(i), float("nan")]) for i in range(20)]
    same = framed(spark, rows, "id long, label int")
    forest = bf.fit_balanced_forest(same, ["id"], "label", settings=bf.ForestSettings(trees=3))
    assert all(len(t[0]) == 1 and t[4][0].tolist() == [0, 1, 0] for t in forest.trees)
    assert {r["p1"] for r in bf.with_probabilities(same, forest).collect()} == {1.0}
