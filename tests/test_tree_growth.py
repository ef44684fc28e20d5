"""Ensembles grown over binned rows: their size, their values, and what a pass moves."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake import Params
from claimlake.operators import trees
from claimlake.plans import catalog


class Asked(Exception):
    pass


# F3


def test_boosted_learners_have_the_size_of_the_parameters(spark, sf_dir, monkeypatch):
    def asked(params, learner):
        raise Asked(params, learner)

    monkeypatch.setattr(catalog.modeling, "RiskModel", asked)
    with pytest.raises(Asked) as found:
        catalog.registered()["ml_boosted"](spark, sf_dir)
    params, learner = found.value.args
    assert (params.n_trees, params.max_depth, learner) == (300, 6, "boosted") == (Params().n_trees, Params().max_depth, learner)


# what a pass counts and what it finds


def table(spark, n=400):
    """Members with few values per feature, so that any way to bin them is the same."""
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 9, n), np.full(n, 3), rng.integers(0, 2, n)], 1).astype(float)
    cost = x[:, 0] * 3 - (x[:, 1] > 4) * x[:, 3] * 7 + rng.normal(0, 1, n)
    label = np.select([cost > 9, cost > 4], [2.0, 1.0], 0.0)
    rows = [(Vectors.dense(v), float(c), float(k)) for v, c, k in zip(x, cost, label)]
    schema = T.StructType([T.StructField("features", VectorUDT()), *[T.StructField(c, T.DoubleType()) for c in ("cost", "label")]])
    return x, cost, label, spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.mark.parametrize("classes", [0, 3])
def test_best_cut_of_all(spark, classes):
    """Against every cut tried by hand, rows weighted by their draws."""
    x, cost, label, _ = table(spark)
    target = label if classes else cost
    weights = trees.drawn(len(x), 0.8, True, (1, 2))
    cuts = [trees.thresholds(*trees.summary(column, 100), 32) for column in x.T]
    bins = np.stack([np.searchsorted(c, column).astype(np.uint8) for c, column in zip(cuts, x.T)])
    shape = trees.Shape(4, 9, classes, 2, 4, 7)
    way = trees.route(trees.Tree(shape, 0))
    found = trees.best_cuts(shape, way, trees.level_sums(shape, way, 0, [(bins[:, :150], weights[:150], target[:150]), (bins[:, 150:], weights[150:], target[150:])]))
    drawn = np.repeat(np.arange(len(x)), weights)

    def mass(rows):
        if classes:
            return len(rows) * (1 - sum((np.sum(target[rows] == k) / max(len(rows), 1)) ** 2 for k in range(3)))
        return np.var(target[rows]) * len(rows) if len(rows) else 0.0

    tried = {
        (f, i): (mass(drawn) - mass(drawn[x[drawn, f] <= cut]) - mass(drawn[x[drawn, f] > cut])) / len(drawn)
        for f, found_cuts in enumerate(cuts) for i, cut in enumerate(found_cuts)
    }
    best = max(tried, key=tried.get)
    assert (found.feature[0], found.cut[0]) == best and found.gain[0] == pytest.approx(tried[best])
    assert shape.size(found.left[0]) + shape.size(found.right[0]) == len(drawn)


def test_cuts_of_few_many_and_equal_values():
    assert list(trees.thresholds(*trees.summary(np.array([3.0, 1, 1, 2]), 10), 32)) == [1.5, 2.5]
    assert len(trees.thresholds(*trees.summary(np.full(5, 3.0), 10), 32)) == 0
    values = np.random.default_rng(1).lognormal(0, 2, 50_000)
    found = trees.thresholds(*trees.summary(values, 1024), 32)
    assert len(found) == 31 and np.allclose(np.searchsorted(np.sort(values), found) / 50_000, np.arange(1, 32) / 32, atol=2e-3)


def test_draws_follow_their_distribution():
    counts = trees.drawn(200_000, 0.8, True, (1,))
    assert counts.mean() == pytest.approx(0.8, abs=0.01) and (counts == 0).mean() == pytest.approx(np.exp(-0.8), abs=0.01)
    once = trees.drawn(200_000, 0.8, False, (1,))
    assert set(once) == {0, 1} and once.mean() == pytest.approx(0.8, abs=0.01)
    assert trees.drawn(100, 1.0, False, (1,)).all()


def test_forest_is_learned_alike_from_one_block_and_many(spark, monkeypatch):
    """One tree over all rows and columns, so nothing is drawn but weights; more blocks give other draws, so those are all ones."""
    _, _, _, rows = table(spark)
    options = dict(numTrees=1, maxDepth=4, seed=3, featureSubsetStrategy="all", subsamplingRate=1.0, bootstrap=False)
    fits = []
    for block_rows in (1 << 15, 1):
        monkeypatch.setattr(trees, "BLOCK_ROWS", block_rows)
        fits.append(trees.ForestRegressor(labelCol="cost", **options).fit(rows))
    known = RandomForestRegressor(labelCol="cost", **options).fit(rows)
    got = [[r.prediction for r in m.transform(rows).select("prediction").collect()] for m in (*fits, known)]
    assert got[0] == pytest.approx(got[1]) and got[0] == pytest.approx(got[2])
    assert fits[0].featureImportances.toArray() == pytest.approx(known.featureImportances.toArray())
    labelled = [c(labelCol="label", **options).fit(rows) for c in (trees.ForestClassifier, RandomForestClassifier)]
    shares = [[list(r.probability) for r in m.transform(rows).select("probability").collect()] for m in labelled]
    assert np.allclose(shares[0], shares[1])


@pytest.mark.parametrize("rows_of_one_task", [1 << 17, 0])
def test_boosting_follows_the_library(spark, monkeypatch, rows_of_one_task):
    """Every row and column in each tree, where nothing is drawn: the library's own margins, in one task and in many."""
    monkeypatch.setattr(trees, "ROWS_OF_ONE_TASK", rows_of_one_task)
    monkeypatch.setattr(trees, "CUT_LINEAGE_AFTER", 2)
    _, _, _, rows = table(spark)
    options = dict(maxIter=5, maxDepth=3, stepSize=0.3, seed=3, featureSubsetStrategy="all")
    cost, high = GBTRegressor(labelCol="cost", **options), GBTClassifier(labelCol="high", **options)
    rows = rows.withColumn("high", (F.col("label") == 2).cast("double"))
    mine = trees.boosted(rows, [(high, F.col("label") == 2), (cost, F.col("cost"))])
    for got, known, column in zip(mine, (high.fit(rows), cost.fit(rows)), ("probability", "prediction")):
        values = [np.array([r[0] if column == "prediction" else r[0][1] for r in m.transform(rows).select(column).collect()]) for m in (got, known)]
        assert np.allclose(values[0], values[1], atol=1e-6)


def test_boosting_a_small_table_takes_no_job_per_tree(spark):
    _, _, _, rows = table(spark)
    rows.count()

    def jobs(n):
        spark.sparkContext.setJobGroup(f"boosted-{n}", "")
        trees.boosted(rows, [(GBTRegressor(maxIter=n, maxDepth=2), F.col("cost"))])
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosted-{n}"))

    assert jobs(2) == jobs(9)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_nothing_to_learn_from(spark):
    _, _, _, rows = table(spark)
    with pytest.raises(ValueError):
        trees.ForestRegressor(labelCol="cost").fit(rows.where("cost > 1e9"))
