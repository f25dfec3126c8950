"""Training: label join, encoding, time split, scaling, fit and hold-out metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import boosting, model
from shelfwise.operators.aggregate import daily_label, regression_metrics
from shelfwise.session import stage


def training_set(features: DataFrame, tx: DataFrame) -> DataFrame:
    """Feature rows with the sold quantity of their (store, SKU, day); 0 where the raw SKU has no sale."""
    label = daily_label(tx)
    return (
        features.join(label, ["store_id", "sku", "date"], "left")
        .withColumn("qty", F.coalesce("daily_quantity", F.lit(0)).cast("double"))
        .drop("daily_quantity")
    )


def train_demand(
    data: DataFrame,
    kind: str = "tweedie",
    ratio: float = 0.8,
    fit_on: str = "all",
    inputs: Sequence[str] = model.MODEL_INPUTS,
    **options: float,
) -> tuple[model.DemandModel, DataFrame]:
    """Fit on the earlier part of ``data`` and measure on the later part; returns (model, metrics).

    The metrics have the Tweedie loss besides, and the rounds of boosting: how
    many were run, and the best one, at which the trees are cut (null for ``tweedie``).

    ``fit_on`` tells which rows the dictionary is built from: 'all' or 'train'.
    A day on which more came back than was sold counts as no demand, as the
    Tweedie loss has no negative values. The prepared rows are staged and
    kept with the executors, because every training iteration reads them again.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    data = data.withColumn("qty", F.greatest(F.col("qty"), F.lit(0.0)))
    data = stage(model.calendar_features(data), "training")
    early, late = model.time_split(data, ratio)
    encoder = model.fit_encoder(data if fit_on == "all" else early)
    columns = [model.input_column(name) for name in inputs]
    train = stage(model.encode(early, encoder).select("qty", *columns), "train")
    valid = stage(model.encode(late, encoder).select("qty", *columns), "valid")
    scaler = stage(model.fit_scaler(train, columns).coalesce(1), "scaler")
    train = model.assemble(train, scaler, columns).select("qty", "features").persist(StorageLevel.MEMORY_AND_DISK)
    valid = model.assemble(valid, scaler, columns).select("qty", "features")
    try:
        regression = model.train_regression(train, valid, kind, **options)
    finally:
        train.unpersist()
    fitted = model.DemandModel(kind, encoder, scaler, columns, regression)
    predicted = regression.transform(valid).withColumn("prediction", F.greatest("prediction", F.lit(0.0)))
    loss = boosting.mean_loss(predicted, "qty", F.log(F.greatest("prediction", F.lit(1e-9))))
    rounds = (regression.grown, regression.best) if kind == "gbt" else (None, None)
    more = {"tweedie_loss": F.lit(loss), "rounds": F.lit(rounds[0]).cast("int"), "best_round": F.lit(rounds[1]).cast("int")}
    return fitted, regression_metrics(predicted).withColumns(more)
