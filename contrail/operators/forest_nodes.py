"""A fitted forest as a table of nodes, and its predictions by joins with that table.

For checking a model row by row, for scoring where MLlib is not at hand, and for looking
into the trees with SQL. MLlib writes a model's nodes as Parquet when it is saved; a row
descends one level of every tree per join. The node table has at most trees x 2^(depth + 1)
rows and is broadcast below ``BROADCAST_MAX_NODES``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_path

BROADCAST_MAX_NODES = 1_000_000


def _forest(model: PipelineModel):
    return next(s for s in model.stages if hasattr(s, "trees"))


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """tree, node, feature (-1 in a leaf), threshold, left, right, gain, rows, stats (weight per label index)."""
    path = scratch_path(spark, "forest")
    _forest(model).write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.gain").alias("gain"), F.col("nodeData.impurityStats").alias("stats"))


def walk(nodes: DataFrame, rows: DataFrame, keys: list[str], depth: int, features: str = "features") -> DataFrame:
    """``keys``, ``walked`` (label index as double), ``walked_probability``: each row down all trees, one join per level.

    A tree votes with its leaf's shares of the labels; of equal probabilities the smaller index wins. ``keys``
    identify a row; ``features`` is the vector column that the forest was fitted on. Rows with the same vector
    go down the trees as one, and meet its result in a join."""
    small = nodes.count() <= BROADCAST_MAX_NODES
    table = (F.broadcast if small else lambda t: t)(nodes.select(F.col("tree"), F.col("node").alias("_at"), "feature", "threshold", "left", "right"))
    trees = [r["tree"] for r in nodes.select("tree").distinct().orderBy("tree").collect()]  # one number per tree
    given = rows.select(*keys, vector_to_array(features).alias("_x"))
    # a fixed number of partitions: the vectors are few bytes, but each becomes a row per tree
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = given.select("_x").distinct().repartition(tasks, "_x").select(
        "_x", F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"), F.lit(0).alias("_at"))
    for _ in range(depth):
        goes_left = F.get("_x", F.greatest("feature", F.lit(0))) <= F.col("threshold")
        step = F.when(F.col("feature") < 0, F.col("_at")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = at.join(table, ["tree", "_at"]).select("_x", "tree", step.alias("_at"))
    leaves = nodes.select("tree", F.col("node").alias("_at"), "stats")
    shares = at.join(F.broadcast(leaves) if small else leaves, ["tree", "_at"]).select(
        "_x", F.transform("stats", lambda s: s / F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)).alias("_p"))
    labels = nodes.select(F.size("stats")).first()[0]
    votes = shares.groupBy("_x").agg(*[F.sum(F.get("_p", F.lit(i))).alias(f"_{i}") for i in range(labels)])
    total = reduce(lambda a, b: a + b, [F.col(f"_{i}") for i in range(labels)])
    probability = F.array(*[F.col(f"_{i}") / total for i in range(labels)])
    out = given.join(votes.select("_x", probability.alias("walked_probability")), "_x")
    best = F.array_position("walked_probability", F.array_max("walked_probability")) - 1
    return out.select(*keys, best.cast("double").alias("walked"), "walked_probability")


def importances(nodes: DataFrame) -> DataFrame:
    """feature (index), importance: per tree the split gains weighted by rows, as shares; the mean over trees, as shares."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    splits = nodes.filter(F.col("feature") >= 0).select("tree", "feature", (F.col("gain") * weight).alias("_g"))
    per_tree = splits.groupBy("tree").agg(F.sum("_g").alias("_t")).filter(F.col("_t") > 0)
    shares = splits.join(per_tree, "tree").groupBy("feature").agg(F.sum(F.col("_g") / F.col("_t")).alias("_s"))
    total = shares.agg(F.sum("_s")).scalar()
    return shares.select("feature", (F.col("_s") / total).alias("importance"))
