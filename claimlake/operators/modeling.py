"""Feature matrix, stratified split and the tier and cost models on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from math import ceil
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.codes import FEATURES, LEAK_FREE_FEATURES
from claimlake.operators import explain, trees
from claimlake.params import Params
from claimlake.sources.shared import kept as kept_rows
from claimlake.sources.shared import new_path

LABEL, COST, KEY = "risk_tier", "estimated_annual_cost", "bene_id"
#: Training rows that a task holds before there are more tasks than cores.
ROWS_PER_TASK = 1 << 18


def require_features(df: DataFrame, features: Sequence[str]) -> None:
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"no such feature columns: {', '.join(missing)}")


def feature_matrix(store: DataFrame, features: Sequence[str] = FEATURES, keep: Sequence[str] = (KEY, LABEL)) -> DataFrame:
    """The features as doubles with NULL as 0, beside the columns to keep."""
    require_features(store, features)
    numbers = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features]
    return store.select(*[k for k in keep if k not in features], *numbers)


def label_index(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Classes with their alphabetical index and number of rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    position = F.row_number().over(Window.partitionBy().orderBy(label)) - 1
    return counts.withColumn("label_index", position)


def stratified_split(df: DataFrame, params: Params, key: str = KEY, stratum: str = LABEL) -> DataFrame:
    """Add ``is_train``: within each stratum the first rows by hash of the key.

    The test part of a stratum is its share rounded up. The hash at the cut
    is found from counts per hash prefix and an ordering of the one prefix
    that holds the cut, so no stratum is ever sorted as a whole; the rows
    themselves are only compared with their stratum's cut.
    """
    hashed = df.withColumns({"_hash": F.md5(F.col(key).cast("binary")), "_key": F.col(key)})
    prefixed = hashed.select(stratum, "_hash", "_key", F.substring("_hash", 1, 4).alias("_prefix"))
    counts = prefixed.groupBy(stratum, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy(stratum).orderBy("_prefix")
    all_rows = F.sum("_n").over(Window.partitionBy(stratum))
    before = F.sum("_n").over(in_order) - F.col("_n")
    positions = counts.withColumns(
        {"_left": all_rows - F.ceil(all_rows * params.test_share) - before}
    )
    cut_prefix = positions.filter((F.col("_left") >= 1) & (F.col("_left") <= F.col("_n"))).select(
        stratum, "_prefix", "_left"
    )
    rank = F.row_number().over(Window.partitionBy(stratum, "_prefix").orderBy("_hash", "_key"))
    cut = (
        prefixed.join(cut_prefix, [stratum, "_prefix"])
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_left"))
        .select(stratum, F.struct("_hash", "_key").alias("_cut"))
    )
    first_part = F.coalesce(F.struct("_hash", "_key") <= F.col("_cut"), F.lit(False))
    return (
        hashed.join(cut, stratum, "left")
        .withColumn("is_train", first_part)
        .drop("_hash", "_key", "_cut")
    )


def _forest_options(params: Params) -> dict:
    return {
        "numTrees": params.n_trees,
        "maxDepth": params.max_depth,
        "subsamplingRate": params.row_share,
        "featureSubsetStrategy": str(params.column_share),
        "seed": params.seed,
    }


def _boosting_options(params: Params) -> dict:
    return {
        "maxIter": params.n_trees,
        "maxDepth": params.max_depth,
        "stepSize": params.learning_rate,
        "subsamplingRate": params.row_share,
        "featureSubsetStrategy": str(params.column_share),
        "seed": params.seed,
    }


def calibration_grid(scored: DataFrame, score: str, hit: Column, params: Params) -> DataFrame:
    """Rate of hits and weight per score, with scores on ``calibration_digits`` decimals.

    The grid bounds what the isotonic fit holds, whatever the number of members. It is
    kept, since the fit reads its input several times.
    """
    grid = scored.groupBy(F.round(score, params.calibration_digits).alias("point")).agg(
        F.avg(hit.cast("double")).alias("rate"), F.count(F.lit(1)).cast("double").alias("w")
    )
    return kept_rows(grid, "grid")


def fit_calibrator(grid: DataFrame, out: str) -> Model:
    """The monotone least-squares fit of rates over points."""
    return IsotonicRegression(featuresCol="point", labelCol="rate", weightCol="w", predictionCol=out).fit(grid)


def laid_out(rows: DataFrame) -> DataFrame:
    """Training rows in about as many partitions as there are cores, each in key order.

    Every task of a tree level fills and shuffles statistics for all open nodes of all
    trees, whatever its rows: what a level moves grows with the tasks, which follow the
    number of rows here and not the number of shuffle partitions. ``rows`` is read twice.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, ceil(rows.count() / (cores * ROWS_PER_TASK)))
    order = [c for c in (KEY, LABEL, COST) if c in rows.columns]
    return rows.repartition(cores * rounds, *order).sortWithinPartitions(*order)


def side_by_side(fits: Sequence[Callable[[], Any]]) -> list:
    """Results of independent fits whose jobs share the cluster."""
    with ThreadPoolExecutor(len(fits)) as pool:
        running = [pool.submit(inheritable_thread_target(SparkSession.active())(fit)) for fit in fits]
        return [r.result() for r in running]


@dataclass
class TierScorer:
    """A fitted classifier that adds one raw score column per class."""

    classes: list[str]
    models: list[Model]

    def transform(self, df: DataFrame) -> DataFrame:
        if len(self.models) == 1:
            scored = self.models[0].transform(df)
            scores = vector_to_array("probability")
            columns = {f"score_{c}": scores[i] for i, c in enumerate(self.classes)}
            return scored.withColumns(columns).drop("probability", "rawPrediction", "prediction")
        for c, model in zip(self.classes, self.models):
            scored = model.transform(df)
            df = scored.withColumn(f"score_{c}", vector_to_array("probability")[1]).drop(
                "probability", "rawPrediction", "prediction"
            )
        return df

    @property
    def importances(self) -> list[float]:
        vectors = [m.featureImportances.toArray() for m in self.models]
        return [float(x) for x in sum(vectors[1:], vectors[0]) / len(vectors)]


@dataclass
class RiskModel:
    """Calibrated tier classifier and cost regressor over a feature store.

    ``forest`` grows all trees side by side, so the data is read once per
    level; ``boosted`` adds trees one after another, per class, which takes a
    pass per tree level and class. By default only features that neither
    restate the label nor look past the cut-over are used.
    """

    params: Params = field(default_factory=Params)
    features: Sequence[str] = LEAK_FREE_FEATURES
    learner: str = "forest"
    classes: list[str] = field(default_factory=list)
    scorer: TierScorer | None = None
    regressor: Model | None = None
    calibrators: list[Model] = field(default_factory=list)

    def _assemble(self, df: DataFrame) -> DataFrame:
        kept = [c for c in (KEY, LABEL, COST) if c in df.columns]
        require_features(df, self.features)
        inputs = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_{f}") for f in self.features]
        wide = df.select(*kept, *inputs)
        assembler = VectorAssembler(inputCols=[f"_{f}" for f in self.features], outputCol="features")
        return assembler.transform(wide).select(*kept, "features")

    def _fit_scorer(self, train: DataFrame) -> TierScorer:
        if self.learner == "forest":
            forest = trees.ForestClassifier(labelCol="label", **_forest_options(self.params))
            return TierScorer(self.classes, [forest.fit(train)])
        return TierScorer(self.classes, trees.boosted(train, self._class_learners()))

    def _class_learners(self) -> list[tuple[GBTClassifier, Column]]:
        learner = GBTClassifier(labelCol="label", **_boosting_options(self.params))
        return [(learner.copy(), F.col("label") == i) for i in range(len(self.classes))]

    def _fit_calibrators(self, train: DataFrame) -> list[Model]:
        """One isotonic fit per class on out-of-fold scores.

        Scores are gathered on a grid first, see ``calibration_grid``.
        """
        folds = self.params.calibration_folds
        fold = F.pmod(F.xxhash64(KEY), F.lit(folds))
        parts = [
            self._fit_scorer(train.filter(fold != i)).transform(train.filter(fold == i))
            for i in range(folds)
        ]
        columns = ["label", *[f"score_{c}" for c in self.classes]]
        scored = kept_rows(reduce(DataFrame.unionByName, parts).select(*columns), "scored")
        return [
            fit_calibrator(
                calibration_grid(scored, f"score_{c}", F.col("label") == i, self.params), f"calibrated_{c}"
            )
            for i, c in enumerate(self.classes)
        ]

    def fit(self, store: DataFrame, calibrate: bool = True) -> RiskModel:
        matrix = self._assemble(store).persist()
        try:
            indexer = StringIndexer(inputCol=LABEL, outputCol="label", stringOrderType="alphabetAsc").fit(matrix)
            self.classes = list(indexer.labels)
            train = laid_out(indexer.transform(matrix)).persist()
            train.count()
        finally:
            matrix.unpersist()
        try:
            self.calibrators = self._fit_calibrators(train) if calibrate else []
            options = {"labelCol": COST, "predictionCol": "predicted_cost"}
            if self.learner == "forest":
                self.scorer = self._fit_scorer(train)
                self.regressor = trees.ForestRegressor(**options, **_forest_options(self.params)).fit(train)
            else:
                cost = GBTRegressor(**options, **_boosting_options(self.params))
                *scorers, self.regressor = trees.boosted(train, [*self._class_learners(), (cost, F.col(COST))])
                self.scorer = TierScorer(self.classes, scorers)
        finally:
            train.unpersist()
        return self

    def predict(self, store: DataFrame) -> DataFrame:
        """Key, predicted tier and cost, and one probability per class."""
        if self.scorer is None:
            raise RuntimeError("train the model before using it")
        scored = self.regressor.transform(self.scorer.transform(self._assemble(store)))
        raw = {c: F.col(f"score_{c}") for c in self.classes}
        if self.calibrators:
            for c, model in zip(self.classes, self.calibrators):
                scored = model.setFeaturesCol(f"score_{c}").transform(scored)
            raw = {c: F.col(f"calibrated_{c}") for c in self.classes}
        total = reduce(lambda a, b: a + b, raw.values())
        shares = {
            f"prob_{c}": F.when(total > 0, p / total).otherwise(F.lit(1.0 / len(raw))) for c, p in raw.items()
        }
        with_shares = scored.withColumns(shares)
        best = F.greatest(*[F.col(p) for p in shares])
        tier = F.coalesce(*[F.when(F.col(f"prob_{c}") == best, F.lit(c)) for c in self.classes])
        kept = [c for c in (KEY, LABEL, COST) if c in scored.columns]
        return with_shares.withColumns({"predicted_tier": tier, "confidence": best}).select(
            *kept, "predicted_tier", "predicted_cost", "confidence", *shares
        )

    def attribution(self, store: DataFrame) -> DataFrame:
        """Key, output, feature, contribution: what each feature adds to a member's raw scores.

        Outputs are the classes, before calibration, and the cost. With ``(bias)`` the parts
        of an output add up to its score: the class probability of a forest, the margin of a
        boosted learner, the predicted cost.
        """
        if self.scorer is None:
            raise RuntimeError("train the model before using it")
        matrix, spark = self._assemble(store).select(KEY, "features"), store.sparkSession
        forest = self.learner == "forest"
        learners = [(m, list(self.classes) if forest else [c]) for m, c in zip(self.scorer.models, self.classes)]
        parts = []
        for model, outputs in [*learners, (self.regressor, [COST])]:
            leaves = explain.leaf_contributions(explain.tree_nodes(spark, model), self.params.max_depth)
            path = new_path(spark, "leaves")
            leaves.write.parquet(path)
            reached = model.setLeafCol("leaves").transform(matrix)
            model.setLeafCol("")
            kept = spark.read.parquet(path)
            parts.append(explain.contributions(reached, kept, KEY, "leaves", self.features, outputs))
        return reduce(DataFrame.unionByName, parts)

    def importance(self, top: int = 20) -> DataFrame:
        """Features ranked by the classifier's impurity importance."""
        if self.scorer is None:
            raise RuntimeError("train the model before using it")
        ranked = SparkSession.active().createDataFrame(
            list(zip(self.features, self.scorer.importances)), "feature string, importance double"
        )
        order = Window.partitionBy().orderBy(F.desc("importance"), "feature")
        return ranked.withColumn("rank", F.row_number().over(order)).orderBy("rank").limit(top)
