"""Random forest whose classes are balanced in every tree's own sample.

Each tree draws its rows by Poisson weights from a hash of (row, tree), and weighs its
classes by their totals in that draw. Features are cut into bins once; a row is then its
bins, its label and its weights, written as one table. Trees grow level by level: a pass
over the table counts (tree, node, feature, bin, class) for all open nodes, the counts
are summed by Spark, and each node takes its best split from at most
features x bins x classes sums. Counts are whole numbers, so no result depends on the order
of rows or tasks. A node with few rows left is grown to its end in one task from these rows.

Fitted state (cut points, node table) is on the driver and in every task, as for any
forest; rows are not. A null label leaves the row out; a null or NaN feature counts as the
smallest value; no rows give a forest of no trees.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.plans.history import TARGET
from riskloom.session import materialize

NO_SPLIT = -1


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 220
    depth: int = 14
    min_instances: int = 3
    bins: int = 32
    classes: int = 3
    seed: int = 42
    per_node: int | None = None     # features a node looks at; the root of their number if None
    balanced: bool = True
    local_instances: int = 20_000   # drawn rows of a node that one task grows to its end


@dataclass(frozen=True)
class BalancedForest:
    """Cut points of every feature, and per tree its nodes: (feature or -1, cut, left, right, class shares)."""

    cuts: list[np.ndarray]
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    nodes: list[tuple]   # (tree, node, feature, bin, drawn rows by class); node 2n and 2n + 1 follow n
    classes: int


# ---- draws and splits -----------------------------------------------------------------------


def poisson_weights(key: str, trees: int, seed: int) -> np.ndarray:
    """How often each tree draws the row: Poisson(1) from four bytes of a digest of seed, row and tree."""
    parts = (hashlib.md5(f"{seed}:{key}:{block}".encode()).digest() for block in range(-(-trees // 4)))
    draws = np.frombuffer(b"".join(parts), ">u4")[:trees]
    return np.searchsorted(_POISSON, draws, side="right").astype(np.uint8)


_POISSON = (np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]) * 2.0**32).astype(np.uint64)


def features_of_node(tree: int, node: int, features: int, s: ForestSettings) -> np.ndarray:
    """The features a node looks at, ascending."""
    some = min(features, s.per_node or math.ceil(math.sqrt(features)))
    return np.sort(np.random.default_rng([s.seed, tree, node]).permutation(features)[:some])


def class_weights(counts: np.ndarray, s: ForestSettings) -> np.ndarray:
    """Weight of each class in one tree's draw."""
    if not s.balanced:
        return np.ones(len(counts))
    present = counts > 0
    return np.where(present, counts.sum() / (present.sum() * np.maximum(counts, 1)), 0.0)


def best_split(counts: np.ndarray, weights: np.ndarray, s: ForestSettings) -> tuple[int, int] | None:
    """(position among the node's features, bin) of the greatest Gini decrease; ``counts`` is features x bins x classes."""
    left = counts.cumsum(axis=1)[:, :-1]
    whole = counts[0].sum(axis=0)
    right = whole - left
    fits = (left.sum(axis=2) >= s.min_instances) & (right.sum(axis=2) >= s.min_instances)
    if not fits.any():
        return None
    wl, wr, w = left * weights, right * weights, whole * weights
    purity = (wl**2).sum(axis=2) / np.maximum(wl.sum(axis=2), 1e-300) + (wr**2).sum(axis=2) / np.maximum(wr.sum(axis=2), 1e-300)
    purity = np.where(fits, purity, -1.0)
    at = int(purity.argmax())
    if purity.flat[at] <= (w**2).sum() / w.sum() * (1 + 1e-12):
        return None
    return divmod(at, purity.shape[1])


def _histogram(bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, features: np.ndarray, s: ForestSettings) -> np.ndarray:
    m = len(features)
    key = ((np.arange(m) * s.bins + bins[:, features]) * s.classes + labels[:, None]).ravel()
    return np.bincount(key, np.repeat(weights, m), m * s.bins * s.classes).astype(np.int64).reshape(m, s.bins, s.classes)


def _open(node: int, counts: np.ndarray, s: ForestSettings) -> bool:
    return node < 1 << s.depth and (counts > 0).sum() > 1 and counts.sum() >= 2 * s.min_instances


def grow(tree: int, node: int, bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, of_class: np.ndarray, s: ForestSettings) -> list[tuple]:
    """All nodes from ``node`` on, grown from its rows."""
    found, stack = [], [(node, np.arange(len(labels)))]
    while stack:
        at, rows = stack.pop()
        counts = np.bincount(labels[rows], weights[rows], s.classes).astype(np.int64)
        split, features = None, None
        if _open(at, counts, s):
            features = features_of_node(tree, at, bins.shape[1], s)
            split = best_split(_histogram(bins[rows], labels[rows], weights[rows], features, s), of_class, s)
        if split is None:
            found.append((tree, at, NO_SPLIT, 0, counts.tolist()))
            continue
        feature = int(features[split[0]])
        found.append((tree, at, feature, split[1], counts.tolist()))
        goes = bins[rows, feature] <= split[1]
        stack += [(2 * at, rows[goes]), (2 * at + 1, rows[~goes])]
    return found


# ---- rows -----------------------------------------------------------------------------------


def _cut_points(rows: DataFrame, features: int, s: ForestSettings) -> list[np.ndarray]:
    """At most bins - 1 cut points a feature; a value up to the cut goes left."""
    steps = [k / s.bins for k in range(1, s.bins)]
    value = lambda j: F.get(F.col("x"), F.lit(j))
    columns: list[Column] = []
    for j in range(features):
        columns += [F.percentile_approx(value(j), steps, 10_000).alias(f"q{j}"), F.max(value(j)).alias(f"m{j}")]
    found = rows.agg(*columns).first()
    return [np.array(sorted({v for v in found[f"q{j}"] or [] if v < found[f"m{j}"]})) for j in range(features)]


def _binned(cuts: list[np.ndarray], s: ForestSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.nan_to_num(np.array(b.column(2).to_pylist(), np.float64), nan=-np.inf)
            bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8)
            weights = [poisson_weights(k, s.trees, s.seed).tobytes() for k in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([r.tobytes() for r in bins], pa.binary()), pa.array(weights, pa.binary())], names=["label", "bins", "weights"]
            )

    return run


def _arrays(b: pa.RecordBatch, features: int, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    labels = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    bins, weights = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(len(labels), n) for k, n in ((1, features), (2, trees)))
    return labels, bins.astype(np.int64), weights


def _drawn_classes(features: int, s: ForestSettings):
    """Drawn rows of each tree by class, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                labels, _, weights = _arrays(b, features, s.trees)
                sums = np.zeros((s.classes, s.trees), np.int64)
                np.add.at(sums, labels, weights.astype(np.int64))
                tree, label = (x.ravel() for x in np.meshgrid(np.arange(s.trees), np.arange(s.classes)))
                yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(label), pa.array(sums.ravel())], names=["tree", "label", "n"])

    return run


def _nodes_of(rows: np.ndarray, bins: np.ndarray, splits: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node that each row has come to."""
    at = np.ones(len(rows), np.int64)
    moving = np.arange(len(rows))
    while len(moving):
        names, which = np.unique(at[moving], return_inverse=True)
        feature, cut = np.array([splits.get(n, (NO_SPLIT, 0)) for n in names.tolist()]).T
        on = feature[which] >= 0
        moving, which = moving[on], which[on]
        goes = bins[rows[moving], feature[which]] > cut[which]
        at[moving] = 2 * at[moving] + goes
    return at


def _level_counts(open_nodes: dict[int, set[int]], splits: dict[int, dict[int, tuple[int, int]]], features: int, s: ForestSettings):
    """Counts (tree, node, place among its features, bin, class) of open nodes, per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            labels, bins, weights = _arrays(b, features, s.trees)
            for tree, wanted in open_nodes.items():
                rows = np.flatnonzero(weights[:, tree])
                at = _nodes_of(rows, bins, splits.get(tree, {}))
                for node in sorted(wanted & set(np.unique(at).tolist())):
                    mine = rows[at == node]
                    sums = _histogram(bins[mine], labels[mine], weights[mine, tree], features_of_node(tree, node, features, s), s)
                    place, cut, label = np.nonzero(sums)
                    n = len(place)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, tree)), pa.array(np.full(n, node)), pa.array(place), pa.array(cut), pa.array(label), pa.array(sums[place, cut, label])],
                        names=["tree", "node", "place", "bin", "label", "n"],
                    )

    return run


def _rows_of_nodes(wanted: dict[int, set[int]], splits: dict[int, dict[int, tuple[int, int]]], features: int, s: ForestSettings):
    """The drawn rows of small nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            labels, bins, weights = _arrays(b, features, s.trees)
            for tree, nodes in wanted.items():
                rows = np.flatnonzero(weights[:, tree])
                at = _nodes_of(rows, bins, splits.get(tree, {}))
                keep = np.isin(at, list(nodes))
                rows, at = rows[keep], at[keep]
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), tree)), pa.array(at), pa.array(labels[rows]), pa.array(weights[rows, tree].astype(np.int64)), b.column(1).take(pa.array(rows))],
                        names=["tree", "node", "label", "weight", "bins"],
                    )

    return run


_NODES = "tree long, node long, feature long, bin long, counts array<long>"


def fit_balanced_forest(
    train: DataFrame, keys: Sequence[str], target: str = TARGET, features_col: str = "features", settings: ForestSettings = ForestSettings()
) -> BalancedForest:
    """Fit on a vector column; ``keys`` name a row and so decide which trees draw it."""
    s = settings
    rows = train.where(F.col(target).isNotNull()).select(
        F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).alias("key"),
        F.col(target).cast("int").alias("label"), vector_to_array(features_col).alias("x"),
    )
    one = rows.select(F.size("x").alias("n")).first()
    if one is None:
        return BalancedForest([], [], [], s.classes)
    features = one["n"]
    cuts = _cut_points(rows, features, s)
    table = materialize(rows.mapInArrow(_binned(cuts, s), "label int, bins binary, weights binary"), "forest-rows")
    totals = table.mapInArrow(_drawn_classes(features, s), "tree long, label long, n long").groupBy("tree", "label").agg(F.sum("n").alias("n"))
    drawn = np.zeros((s.trees, s.classes), np.int64)
    for r in totals.collect():  # trees x classes
        drawn[r["tree"], r["label"]] = r["n"]
    of_class = [class_weights(c, s) for c in drawn]

    nodes: list[tuple] = []
    splits: dict[int, dict[int, tuple[int, int]]] = {}
    small: dict[int, set[int]] = {}
    level = [(tree, 1, drawn[tree]) for tree in range(s.trees) if drawn[tree].sum()]
    while level:
        wide: dict[int, set[int]] = {}
        for tree, node, counts in level:
            if not _open(node, counts, s):
                nodes.append((tree, node, NO_SPLIT, 0, counts.tolist()))
            elif counts.sum() <= s.local_instances:
                small.setdefault(tree, set()).add(node)
            else:
                wide.setdefault(tree, set()).add(node)
        level = []
        if not wide:
            break
        sums = table.mapInArrow(_level_counts(wide, splits, features, s), "tree long, node long, place long, bin long, label long, n long")
        sums = sums.groupBy("tree", "node", "place", "bin", "label").agg(F.sum("n").alias("n"))

        def choose(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            tree, node = key
            own = features_of_node(tree, node, features, s)
            counts = np.zeros((len(own), s.bins, s.classes), np.int64)
            counts[part["place"], part["bin"], part["label"]] = part["n"]
            split = best_split(counts, of_class[tree], s)
            whole = counts[0].sum(axis=0)
            left = counts[split[0], :split[1] + 1].sum(axis=0) if split else whole
            return pd.DataFrame({
                "tree": [tree], "node": [node], "feature": [int(own[split[0]]) if split else NO_SPLIT], "bin": [split[1] if split else 0],
                "counts": [whole.tolist()], "left": [left.tolist()],
            })

        # one row for each open node of the level
        for r in sums.groupBy("tree", "node").applyInPandas(choose, _NODES + ", left array<long>").collect():
            nodes.append((r["tree"], r["node"], r["feature"], r["bin"], r["counts"]))
            if r["feature"] >= 0:
                splits.setdefault(r["tree"], {})[r["node"]] = r["feature"], r["bin"]
                left = np.array(r["left"])
                level += [(r["tree"], 2 * r["node"], left), (r["tree"], 2 * r["node"] + 1, np.array(r["counts"]) - left)]
    if small:
        def finish(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            tree, node = key
            bins = np.frombuffer(b"".join(part["bins"]), np.uint8).reshape(len(part), features).astype(np.int64)
            grown = grow(tree, node, bins, part["label"].to_numpy(), part["weight"].to_numpy(), of_class[tree], s)
            return pd.DataFrame(grown, columns=["tree", "node", "feature", "bin", "counts"])

        parts = table.mapInArrow(_rows_of_nodes(small, splits, features, s), "tree long, node long, label long, weight long, bins binary")
        grown = parts.groupBy("tree", "node").applyInPandas(finish, _NODES)
        nodes += [(r["tree"], r["node"], r["feature"], r["bin"], r["counts"]) for r in grown.collect()]
    return BalancedForest(cuts, _trees(sorted(nodes), cuts, of_class), sorted(nodes), s.classes)


def _trees(nodes: list[tuple], cuts: list[np.ndarray], of_class: list[np.ndarray]) -> list[tuple]:
    by_tree: dict[int, list[tuple]] = {}
    for n in nodes:
        by_tree.setdefault(n[0], []).append(n)
    out = []
    for tree, own in sorted(by_tree.items()):
        place = {n[1]: k for k, n in enumerate(own)}
        feature = np.array([n[2] for n in own])
        cut = np.array([cuts[n[2]][n[3]] if n[2] >= 0 else 0.0 for n in own])
        left = np.array([place[2 * n[1]] if n[2] >= 0 else NO_SPLIT for n in own])
        right = np.array([place[2 * n[1] + 1] if n[2] >= 0 else NO_SPLIT for n in own])
        weighed = np.array([n[4] for n in own]) * of_class[tree]
        out.append((feature, cut, left, right, weighed / weighed.sum(axis=1, keepdims=True)))
    return out


def class_probabilities(x: np.ndarray, forest: BalancedForest) -> np.ndarray:
    """Mean over trees of the class shares of the leaf that each row comes to."""
    total = np.zeros((len(x), forest.classes))
    for feature, cut, left, right, share in forest.trees:
        at = np.zeros(len(x), np.int64)
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            here = at[rows]
            at[rows] = np.where(x[rows, feature[here]] <= cut[here], left[here], right[here])
            rows = rows[feature[at[rows]] >= 0]
        total += share[at]
    return total / max(1, len(forest.trees))


def with_probabilities(df: DataFrame, forest: BalancedForest, features_col: str = "features") -> DataFrame:
    """``df`` with p0, p1, ... in place of the vector column; the forest goes to every task."""
    sent = df.sparkSession.sparkContext.broadcast(forest)
    kept = [c for c in df.columns if c != features_col]
    slim = df.select(*kept, vector_to_array(features_col).alias("_x"))
    names = [f"p{k}" for k in range(forest.classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(len(kept)).to_pylist(), np.float64).reshape(b.num_rows, -1)
            p = class_probabilities(np.nan_to_num(x, nan=-np.inf), sent.value)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(kept))), *(pa.array(p[:, k]) for k in range(forest.classes))], names=[*kept, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields if f.name in kept), *(f"{n} double" for n in names)])
    return slim.mapInArrow(run, schema)
