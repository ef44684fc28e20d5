"""What a model's scores are made of: path contributions per member, permutation importance."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.sources.shared import kept, new_path

#: Name under which the score of no features at all is listed.
BIAS = "(bias)"
#: Largest table of leaves that is broadcast.
BROADCAST_BYTES = 32 << 20


# --- path contributions --------------------------------------------------------


def tree_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """One row per node of an ensemble, from the model's own files.

    ``value`` is what the ensemble's raw score would gain, per output, if the tree ended at
    the node: class shares of a forest classifier, the prediction of any other tree, each
    times the tree's weight.
    """
    path = new_path(spark, "trees")
    model.write().save(path)
    n_trees = model.getNumTrees
    trees = spark.read.parquet(f"{path}/treesMetadata")
    weighted = trees.columns[2:]
    shares = "Classification" in type(model).__name__ and "GBT" not in type(model).__name__
    weight = F.col(weighted[0]) if "GBT" in type(model).__name__ else F.lit(1.0 / n_trees)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.impurityStats").alias("stats"),
    )
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    value = F.transform("stats", lambda x: x / total) if shares else F.array("prediction")
    weights = trees.select(F.col(trees.columns[0]).alias("tree"), weight.alias("weight"))
    return nodes.join(weights, "tree").select(
        "tree", "node", "left", "right", "feature", F.transform(value, lambda x: x * F.col("weight")).alias("value")
    )


def leaf_contributions(nodes: DataFrame, max_depth: int) -> DataFrame:
    """Per tree, leaf and feature: what the splits on the path to the leaf add to the score.

    ``leaf`` numbers the leaves of a tree from the left, as ``leafCol`` does. The root's value,
    which no split explains, is listed under feature -1. Paths are followed upwards from
    the leaves, a level at a time; rows are bounded by the size of the model.
    """
    edges = nodes.where("left >= 0").select(
        "tree", F.col("node").alias("parent"), "feature", F.col("value").alias("above"), F.explode(F.array("left", "right")).alias("node")
    )
    steps = edges.join(nodes.select("tree", "node", "value"), ["tree", "node"]).select(
        "tree", "node", "parent", "feature", F.zip_with("value", "above", lambda below, above: below - above).alias("gain")
    )
    in_order = F.row_number().over(Window.partitionBy("tree").orderBy("node")) - 1
    at = nodes.where("left < 0").select("tree", in_order.alias("leaf"), "node")
    gains = nodes.where("node = 0").join(at.select("tree", "leaf"), "tree").select(
        "tree", "leaf", F.lit(-1).alias("feature"), F.col("value").alias("gain")
    )
    for _ in range(max_depth):
        up = at.join(steps, ["tree", "node"])
        gains = gains.unionByName(up.select("tree", "leaf", "feature", "gain"))
        at = up.select("tree", "leaf", F.col("parent").alias("node"))
    long = gains.select("tree", "leaf", "feature", F.posexplode("gain").alias("output", "gain"))
    return long.groupBy("tree", "leaf", "feature", "output").agg(F.sum("gain").alias("gain"))


def contributions(
    scored: DataFrame, leaves: DataFrame, key: str, leaf_column: str, features: Sequence[str], outputs: Sequence[str]
) -> DataFrame:
    """key, output, feature, contribution: the parts that add up to each raw score.

    ``scored`` carries the leaves of its rows, a number per tree. A row meets each tree once;
    its parts are added before they are shuffled.
    """
    from pyspark.ml.functions import vector_to_array

    reached = scored.select(key, F.posexplode(vector_to_array(leaf_column)).alias("tree", "leaf"))
    met = reached.withColumn("leaf", F.col("leaf").cast("int"))
    known = F.broadcast(leaves) if leaves.count() * 40 <= BROADCAST_BYTES else leaves
    added = met.join(known, ["tree", "leaf"]).groupBy(key, "output", "feature").agg(F.sum("gain").alias("contribution"))
    names = F.array(*[F.lit(f) for f in features])
    return added.select(
        key,
        F.get(F.array(*[F.lit(o) for o in outputs]), F.col("output")).alias("output"),
        F.when(F.col("feature") < 0, BIAS).otherwise(F.get(names, F.col("feature"))).alias("feature"),
        "contribution",
    )


def leading_features(parts: DataFrame, key: str, top: int = 3) -> DataFrame:
    """The features that move each score most, by rank, the bias left out."""
    order = Window.partitionBy(key, "output").orderBy(F.desc(F.abs("contribution")), "feature")
    ranked = parts.where(F.col("feature") != BIAS).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top)


# --- permutation importance ------------------------------------------------------


def exchanged(matrix: DataFrame, features: Sequence[str], key: str, digits: int = 2) -> DataFrame:
    """key, feature, value: every feature's column, exchanged between rows.

    Rows are dealt to ``16 ** digits`` groups by a hash of the key; inside a group each
    takes the value of the next one in an order by hash that differs from feature to
    feature, the last that of the first. All columns are exchanged in one pass. Groups
    bound what a task sorts; a row alone in its group keeps its value.
    """
    long = matrix.select(key, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [key], list(features), "feature", "own"
    )
    place = F.md5(F.concat_ws("|", "feature", key).cast("binary"))
    group = F.substring(F.md5(F.col(key).cast("binary")), 1, digits)
    hashed = long.withColumns({"_group": group, "_place": place})
    order = Window.partitionBy("feature", "_group").orderBy("_place", key)
    first = F.first("own").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = F.lead(F.struct("own")).over(order)
    value = F.when(following.isNull(), first).otherwise(following["own"])
    return hashed.select(key, "feature", value.alias("value"))


def permutation_importance(
    matrix: DataFrame,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    hit: Column,
    key: str,
    digits: int = 2,
) -> DataFrame:
    """feature, score, permuted_score, importance: what the share of hits loses without a feature.

    ``predict`` adds predictions to rows and keeps their columns; ``hit`` says whether one is
    right. Every feature is judged in the same pass, on rows in which it alone is exchanged.
    The matrix is kept, since it is read three times.
    """
    matrix = kept(matrix, "matrix")
    swapped = exchanged(matrix, features, key, digits)
    rows = matrix.join(swapped, key).withColumns(
        {f: F.when(F.col("feature") == f, F.col("value")).otherwise(F.col(f).cast("double")) for f in features}
    )
    right = F.avg(hit.cast("int"))
    base = predict(matrix).agg(right)
    judged = predict(rows.drop("value")).groupBy("feature").agg(right.alias("permuted_score"))
    return judged.withColumn("score", base.scalar()).select(
        "feature", "score", "permuted_score", (F.col("score") - F.col("permuted_score")).alias("importance")
    )
