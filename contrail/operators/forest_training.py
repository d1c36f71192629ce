"""A random forest trained on counted points, for more rows than MLlib's trainer can hold.

MLlib caches every training row with a draw per tree and a node per tree (about 1 kB a row for 100 trees) and goes
over that once per level. To the forest, rows with the same label whose features fall into the same bins are one point
that stands for ``n`` rows: MLlib draws each row Poisson(1) times for a tree, so the point is drawn Poisson(n) times.
Here the points are kept (features + 12 bytes each, in blocks below the checkpoint root) and a block's draws are repeated from their seed in
every level instead of being stored. Otherwise as MLlib: up to 31 thresholds per feature at the quantiles of about 10000 rows,
a random choice of the features (the square root of their number) per node, Gini gain, one pass over the points per level of all trees,
leaves of one prediction merged. The result is MLlib's own model class, read from the files that MLlib writes a model to.
For trees of some 15 levels at most: they are kept as arrays of 2 ^ (depth + 1) nodes.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import materialize, scratch_path

# points that are worked on at once, and that one task goes over
BLOCK_POINTS, TASK_POINTS = 2 ** 18, 2 ** 22
EPSILON = 2.0 ** -52

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # an executor need not have this package


def _random(seed: int, stream: int, step: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=[seed % 2 ** 64, stream], counter=[0, 0, 0, step]))


def thresholds(values: np.ndarray, rows: np.ndarray, max_bins: int) -> np.ndarray:
    """MLlib's thresholds of a feature: between neighbouring values, at steps of equal numbers of rows."""
    found, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, weights=rows)
    between = (found[:-1] + found[1:]) / 2.0
    if len(between) < max_bins:
        return between
    out, step = [], counts.sum() / max_bins
    so_far, target = counts[0], step
    for i in range(1, len(found)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - target) < abs(so_far - target):
            out.append(between[i - 1])
            target += step
    return np.array(out)


def _some_rows(points: DataFrame, share: float, seed: int) -> DataFrame:
    """_x and how many of its rows were drawn (_drawn), each row with probability ``share``."""
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        random = _random(seed, 2 ** 33, TaskContext.get().partitionId())
        for batch in batches:
            drawn = random.binomial(batch.column("_n").to_numpy(), share)
            kept = pa.array(drawn > 0)
            yield pa.RecordBatch.from_arrays([batch.column("_x").filter(kept), pa.array(drawn).filter(kept)], ["_x", "_drawn"])

    return points.mapInArrow(draw, "_x array<double>, _drawn long")


def _binned(points: DataFrame, splits: list[np.ndarray]) -> DataFrame:
    """_bins (a byte per feature), _label, _n: ``points`` (_x, _label, _n) by the bins of their features."""
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(splits))
            b = np.stack([np.searchsorted(s, x[:, f], side="left") for f, s in enumerate(splits)], axis=1).astype(np.uint8)
            at = np.arange(batch.num_rows + 1, dtype=np.int32) * len(splits)
            keys = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(b.tobytes())])
            yield pa.RecordBatch.from_arrays([keys, batch.column("_label"), batch.column("_n")], ["_bins", "_label", "_n"])

    return points.mapInArrow(bins, "_bins binary, _label int, _n long").groupBy("_bins", "_label").agg(F.sum("_n").alias("_n"))


def _blocks(binned: DataFrame, tasks: int, block_points: int) -> DataFrame:
    """block (its number), bins, labels, n: the points of a block as bytes. A block's points and their order do not depend on the layout."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, number = [], 0, 0

        def block(table: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{
                "block": int(table["_part"][0].as_py()) * 2 ** 32 + number, "bins": b"".join(table["_bins"].to_pylist()),
                "labels": table["_label"].to_numpy().astype(np.int32).tobytes(), "n": table["_n"].to_numpy().astype(np.int64).tobytes()}])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= block_points:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, block_points))
                number += 1
                held = table.slice(block_points).to_batches()
                rows -= block_points
        if rows:
            yield block(pa.Table.from_batches(held))

    dealt = binned.repartition(tasks, "_bins", "_label").sortWithinPartitions("_bins", "_label").withColumn("_part", F.spark_partition_id())
    return dealt.mapInArrow(pack, "block long, bins binary, labels binary, n binary")


def _histograms(blocks: DataFrame, forest: list[dict], level: int, features: int, labels: int, bins: int, seed: int) -> DataFrame:
    """tree, hist: drawn rows per (node of the level, feature of the node, bin, label), one row per tree and task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for r in batch.to_pylist():
                b = np.frombuffer(r["bins"], np.uint8).reshape(-1, features).T.copy().ravel()
                held.append((r["block"], b, np.frombuffer(r["labels"], np.int32), np.frombuffer(r["n"], np.int64)))
        if not held:
            return
        for t, tree in enumerate(forest):
            slot, chosen = tree["slot"], tree["chosen"]
            if not len(chosen):
                continue
            hist = np.zeros(chosen.size * bins * labels)
            for block, b, label, n in held:
                drawn = _random(seed, t, block).poisson(n)
                rows = np.flatnonzero(drawn)
                at = np.ones(len(rows), np.intp)
                for _ in range(level):  # a leaf goes on to its left only, where no slot is
                    at = 2 * at + (b[tree["feature"][at] * len(n) + rows] > tree["bin"][at])
                at = slot[at - 2 ** level]
                kept = at >= 0
                at, rows = at[kept], rows[kept]
                weight, own = drawn[rows].astype(np.float64), label[rows]
                for k in range(chosen.shape[1]):
                    cell = ((at * chosen.shape[1] + k) * bins + b[chosen[at, k] * len(n) + rows]) * labels + own
                    hist += np.bincount(cell, weights=weight, minlength=hist.size)
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([hist.tobytes()], pa.binary())], ["tree", "hist"])

    return blocks.mapInArrow(count, "tree int, hist binary")


def _gini(stats: np.ndarray) -> np.ndarray:
    total = stats.sum(-1)
    return np.where(total > 0, 1.0 - np.square(stats / np.maximum(total, 1)[..., None]).sum(-1), 0.0)


def best_splits(hist: np.ndarray) -> dict[str, np.ndarray]:
    """For every node of ``hist`` (node, feature, bin, label): its rows per label, impurity, and the first split of the largest gain
    (k: which of its features, bin: the last one to the left, gain: 0 if no split divides the rows)."""
    total = hist[:, 0].sum(1)
    left = np.cumsum(hist, axis=2)[:, :, :-1]
    right = total[:, None, None, :] - left
    n, nl, nr = total.sum(-1)[:, None, None], left.sum(-1), right.sum(-1)
    gain = _gini(total)[:, None, None] - (nl * _gini(left) + nr * _gini(right)) / np.maximum(n, 1)
    gain = np.where((nl > 0) & (nr > 0), gain, 0.0)
    best = gain.reshape(len(hist), -1).argmax(1)
    k, at = np.divmod(best, gain.shape[2])
    nodes = np.arange(len(hist))
    return {"stats": total, "k": k, "bin": at, "gain": np.maximum(gain[nodes, k, at], 0.0), "left": left[nodes, k, at], "right": right[nodes, k, at]}


def _grow(forest: list[dict], found: dict[int, dict], level: int, depth: int) -> None:
    """Put the level's splits into the trees and make the next level's slots. Nodes are numbered 1, and 2i and 2i + 1 below i."""
    for t, tree in enumerate(forest):
        width = 2 ** (level + 1)
        tree["feature"], tree["bin"] = (np.concatenate([a, np.full(2 * width - len(a), fill, a.dtype)])
                                        for a, fill in ((tree["feature"], 0), (tree["bin"], 255)))
        old, tree["slot"], following, tree["active"] = tree["slot"], np.full(width, -1, np.intp), 0, 0
        if t not in found:
            continue
        best = found[t]
        open_left, open_right = (_gini(best[side]) >= EPSILON for side in ("left", "right"))
        for p in np.flatnonzero(old >= 0):
            s, node = old[p], 2 ** level + int(p)
            tree["stats"][node] = best["stats"][s]
            if best["gain"][s] <= 0:
                continue
            f, b = int(tree["chosen"][s, int(best["k"][s])]), int(best["bin"][s])
            tree["feature"][node], tree["bin"][node] = f, b
            tree["split"][node] = (f, b, float(best["gain"][s]))
            for child, stats, mixed in ((2 * node, best["left"][s], open_left[s]), (2 * node + 1, best["right"][s], open_right[s])):
                tree["stats"][child] = stats
                if level + 1 < depth and mixed:
                    tree["slot"][child - width] = following
                    following += 1
        tree["active"] = following


def _node_rows(t: int, tree: dict, splits: list[np.ndarray]) -> list[dict]:
    """The tree as MLlib saves it: nodes numbered root, left, right; two leaves of one prediction are one."""
    def pruned(node: int) -> bool:
        """Whether ``node`` ends up a leaf."""
        if node not in tree["split"]:
            return True
        below = [pruned(c) for c in (2 * node, 2 * node + 1)]
        if all(below) and tree["stats"][2 * node].argmax() == tree["stats"][2 * node + 1].argmax():
            tree["as_leaf"][node] = int(tree["stats"][2 * node].argmax())
            del tree["split"][node]
            return True
        return False

    tree["as_leaf"] = {}
    pruned(1)
    out = []

    def put(node: int) -> int:
        stats, place = tree["stats"][node], len(out)
        row = {"id": place, "prediction": float(tree["as_leaf"].get(node, stats.argmax())), "impurity": float(_gini(stats)),
               "impurityStats": stats.tolist(), "rawCount": int(stats.sum()), "gain": -1.0, "leftChild": -1, "rightChild": -1,
               "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        out.append({"treeID": t, "nodeData": row})
        if node in tree["split"]:
            f, b, gain = tree["split"][node]
            row |= {"gain": gain, "split": {"featureIndex": f, "leftCategoriesOrThreshold": [float(splits[f][b])], "numCategories": -1}}
            row["leftChild"], row["rightChild"] = put(2 * node), put(2 * node + 1)
        return place

    put(1)
    return out


def fit_counted(forest: RandomForestClassifier, points: DataFrame, weight: str, labels: int, block_points: int = BLOCK_POINTS) -> RandomForestClassificationModel:
    """The model that ``forest`` fits, over rows that ``points`` (its features and label columns) count in ``weight``."""
    spark, depth, trees, bins, seed = points.sparkSession, forest.getMaxDepth(), forest.getNumTrees(), forest.getMaxBins(), forest.getSeed()
    rows = materialize(points.select(vector_to_array(forest.getFeaturesCol()).alias("_x"), F.col(forest.getLabelCol()).cast("int").alias("_label"),
                                     F.col(weight).alias("_n")), "forest_points")
    total, features = rows.agg(F.sum("_n"), F.max(F.size("_x"))).first()
    # (dealt and sorted, so that the draws do not depend on the layout)
    sorted_rows = rows.repartition(spark.sparkContext.defaultParallelism, "_x", "_label").sortWithinPartitions("_x", "_label")
    some = _some_rows(sorted_rows, min(1.0, max(bins ** 2, 10_000) / total), seed).collect()
    values, drawn = np.array([r["_x"] for r in some]), np.array([r["_drawn"] for r in some])
    splits = [thresholds(values[:, f], drawn, bins) for f in range(features)]
    binned = materialize(_binned(rows, splits), "forest_bins")
    tasks = max(spark.sparkContext.defaultParallelism, -(-binned.count() // TASK_POINTS))
    blocks = materialize(_blocks(binned, tasks, block_points), "forest_blocks")

    per_node = max(1, math.ceil(math.sqrt(features)))
    grown = [{"feature": np.zeros(2, np.intp), "bin": np.full(2, 255, np.uint8), "slot": np.zeros(1, np.intp), "active": 1,
              "split": {}, "stats": {}} for _ in range(trees)]
    for level in range(depth):
        for t, tree in enumerate(grown):
            order = _random(seed, 2 ** 32 + t, level).random((tree["active"], features))
            tree["chosen"] = order.argsort(1)[:, :per_node]  # (a feature without thresholds may be among them: its bin is always 0)
        given = [{k: tree[k] for k in ("feature", "bin", "slot", "chosen")} for tree in grown]
        shape = (-1, per_node, bins, labels)

        def best(table: pa.Table) -> pa.Table:
            hist = sum(np.frombuffer(h.as_buffer()) for h in table["hist"])
            out = best_splits(hist.reshape(shape))
            return pa.table({"tree": table["tree"][:1]} | {k: pa.array([v.astype(np.float64).tobytes()], pa.binary()) for k, v in out.items()})

        columns = ("stats", "k", "bin", "gain", "left", "right")
        result = _histograms(blocks, given, level, features, labels, bins, seed).groupBy("tree").applyInArrow(
            best, "tree int, " + ", ".join(f"{c} binary" for c in columns))
        found = {}
        for r in result.collect():
            values = {c: np.frombuffer(r[c]) for c in columns}
            found[r["tree"]] = {c: v.reshape(-1, labels) if c in ("stats", "left", "right") else v for c, v in values.items()}
        _grow(grown, found, level, depth)
        if not any(tree["active"] for tree in grown):
            break
    return _as_model(spark, forest, grown, splits, features, labels)


def _as_model(spark: SparkSession, forest: RandomForestClassifier, grown: list[dict], splits: list[np.ndarray], features: int, labels: int) -> RandomForestClassificationModel:
    """MLlib's model of these trees: its files for a forest without splits, with these nodes in the place of the roots."""
    blank = spark.createDataFrame([(float(i), Vectors.dense([0.0] * features)) for i in range(labels)], [forest.getLabelCol(), forest.getFeaturesCol()])
    path = scratch_path(spark, "forest_model")
    forest.fit(blank).write().overwrite().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    nodes = [n for t, tree in enumerate(grown) for n in _node_rows(t, tree, splits)]
    spark.createDataFrame(nodes, schema).repartition(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
