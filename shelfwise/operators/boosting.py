"""Boosted trees with the Tweedie loss, stopped by patience on a later part of the data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import stage

POWER = 1.5
#: Rounds after which the margins are staged, so that plans do not grow with the rounds.
CUT = 10
#: Margins are logarithms; beyond this they would overflow.
BOUND = 30.0


def tweedie_loss(y: Column, margin: Column, power: float = POWER) -> Column:
    """The Tweedie deviance's part that depends on the prediction, whose logarithm is ``margin``."""
    return F.exp((2 - power) * margin) / (2 - power) - y * F.exp((1 - power) * margin) / (1 - power)


def mean_loss(rows: DataFrame, label: str, margin: Column, power: float = POWER) -> float:
    return rows.agg(F.avg(tweedie_loss(F.col(label), margin, power))).first()[0]


def _ensemble(trees: Sequence[DecisionTreeRegressionModel], rate: float) -> GBTRegressionModel:
    """The weighted sum of trees as one of Spark's own models."""
    context = SparkContext._active_spark_context
    regression = context._jvm.org.apache.spark.ml.regression
    members = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    weights = context._gateway.new_array(context._jvm.double, len(trees))
    for k, tree in enumerate(trees):
        members[k], weights[k] = tree._java_obj, rate
    return GBTRegressionModel(regression.GBTRegressionModel(f"boosted_{trees[0].uid}", members, weights, trees[0].numFeatures))


@dataclass
class BoostedTrees:
    """Trees up to the best round; predictions are the exponential of ``start`` plus the trees' sum."""

    trees: GBTRegressionModel
    start: float
    losses: list[float]

    @property
    def grown(self) -> int:
        """Rounds that were run, with those after the best one."""
        return len(self.losses)

    @property
    def best(self) -> int:
        return 1 + self.losses.index(min(self.losses))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.trees.transform(df).withColumn("prediction", F.exp(_bounded(self.start + F.col("prediction"))))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        facts = spark.createDataFrame([(self.start, self.losses)], "start DOUBLE, losses ARRAY<DOUBLE>")
        facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
        self.trees.write().overwrite().save(f"{path}/trees")

    @classmethod
    def load(cls, path: str) -> BoostedTrees:
        facts = SparkSession.active().read.parquet(f"{path}/facts").first()
        return cls(GBTRegressionModel.load(f"{path}/trees"), facts["start"], list(facts["losses"]))


def _bounded(margin: Column) -> Column:
    return F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), margin))


def boost(
    train: DataFrame,
    valid: DataFrame,
    label: str = "qty",
    trees: int = 1000,
    depth: int = 5,
    rate: float = 0.05,
    patience: int = 50,
    power: float = POWER,
    seed: int = 42,
) -> BoostedTrees:
    """Fit on frames with a ``features`` vector and a label that is not negative.

    A round fits a tree to the loss's gradient over its second derivative, with
    the latter as weights, so a leaf's value is the Newton step of its rows. It
    ends after ``trees`` rounds, or ``patience`` rounds after the least loss on
    ``valid``; trees after that round are dropped. Spark grows each tree from
    histograms, so only node statistics reach the driver.
    """
    mean = train.agg(F.avg(label)).first()[0] or 0.0
    start = math.log(max(mean, 1e-6))
    columns = ["features", label, "_valid", "_margin"]
    both = train.withColumn("_valid", F.lit(False)).unionByName(valid.withColumn("_valid", F.lit(True)))
    base = _kept(both.withColumn("_margin", F.lit(0.0)).select(*columns))
    grower = DecisionTreeRegressor(labelCol="_target", weightCol="_weight", maxDepth=depth, minInstancesPerNode=20, seed=seed)
    every: list[DecisionTreeRegressionModel] = []
    losses: list[float] = []
    margin = _bounded(start + F.col("_margin"))
    try:
        while len(every) < trees:
            first, second = F.exp((2 - power) * margin), F.col(label) * F.exp((1 - power) * margin)
            weight = (2 - power) * first - (1 - power) * second
            rows = base.where("NOT _valid").select("features", ((second - first) / weight).alias("_target"), weight.alias("_weight"))
            tree = grower.fit(rows)
            every.append(tree)
            # A tree reads its rows several times, so its predecessors are not evaluated again each time.
            moved, old = _moved(base, tree, rate).select(*columns), base
            base = _kept(moved) if len(every) % CUT == 0 else moved.persist(StorageLevel.MEMORY_AND_DISK)
            losses.append(mean_loss(base.where("_valid"), label, margin, power))
            old.unpersist()
            if len(losses) - losses.index(min(losses)) > patience:
                break
    finally:
        base.unpersist()
    best = 1 + losses.index(min(losses))
    return BoostedTrees(_ensemble(every[:best], rate), start, losses)


def _kept(rows: DataFrame) -> DataFrame:
    """Staged, and kept with the executors for the next rounds; a lost executor reads its part again."""
    return stage(rows, "margins").persist(StorageLevel.MEMORY_AND_DISK)


def _moved(base: DataFrame, tree: DecisionTreeRegressionModel, rate: float) -> DataFrame:
    """``base`` with one more tree added to its margin."""
    return _ensemble([tree], rate).transform(base).withColumn("_margin", F.col("_margin") + F.col("prediction")).drop("prediction")
