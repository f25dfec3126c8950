"""Model steps: label encoding, scaling, time split, training, scoring and model storage."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.calendar import date_parts
from shelfwise.operators.boosting import BoostedTrees, boost
from shelfwise.operators.rows import ranked
from shelfwise.session import stage

# The model's text columns and its inputs in order.
TEXT_COLUMNS = ("sku", "size", "color", "category", "sub_category", "color_type", "country", "city")
MODEL_INPUTS = (
    "store_id",
    "product_id",
    "sku",
    "size",
    "color",
    "total_lifespan",
    "s_total_lifespan",
    "sku_store_coverage",
    "product_store_coverage",
    "s_days_active",
    "s_selling_days_count",
    "s_sales_velocity",
    "s2_days_active",
    "s2_selling_days_count",
    "s2_sales_velocity",
    "avg_usd_price",
    "total_discount_avg",
    "lag_1d",
    "lag_7d",
    "rolling_mean_7d",
    "rolling_std_7d",
    "category",
    "sub_category",
    "color_type",
    "country",
    "city",
    "num_distinct_products",
    "num_distinct_skus",
    "month",
    "day_of_week",
    "day",
)


def calendar_features(df: DataFrame, col: str = "date") -> DataFrame:
    return df.withColumns(date_parts(F.col(col)))


def code_name(column: str) -> str:
    return f"{column}_code"


def input_column(name: str) -> str:
    return code_name(name) if name in TEXT_COLUMNS else name


def _as_text(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def fit_encoder(df: DataFrame, cols: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Dictionary (column, value, code): the values of each text column numbered from 0 in sorted order.

    Rows are reduced to their distinct texts, of which there are about as many as
    series, before these are unfolded. Millions of SKUs are numbered without a
    single-task sort; see ``ranked``.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), _as_text(name).alias("value")) for name in cols])
    values = df.select(*cols).distinct().select(F.inline(pairs)).distinct()
    codes = ranked(values, ["value"], "code", within=["column"])
    return stage(codes, "encoder")


def encode(df: DataFrame, encoder: DataFrame, cols: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Add ``<column>_code`` for each text column; a value the dictionary lacks gets code 0.

    The dictionary is a staged table, so Spark knows its size and picks the joins.
    """
    for name in cols:
        codes = encoder.where(F.col("column") == name).select(
            F.col("value").alias("_value"), F.col("code").alias(code_name(name))
        )
        df = df.join(codes, _as_text(name) == F.col("_value"), "left").drop("_value")
    return df.fillna(0, [code_name(name) for name in cols])


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(position, feature, mean, scale) per column, in the order given; a constant column gets scale 1."""
    stats = [F.struct(F.avg(name).alias("mean"), F.stddev_pop(name).alias("scale")).alias(name) for name in cols]
    row = df.agg(*stats)
    parts = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("feature"),
            F.col(f"{name}.mean").alias("mean"),
            F.when(F.col(f"{name}.scale") == 0, 1.0).otherwise(F.col(f"{name}.scale")).alias("scale"),
        )
        for i, name in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*parts)))


def scale(df: DataFrame, scaler: DataFrame, suffix: str = "") -> DataFrame:
    """Standardise the scaler's columns. The scaler has one row per column, which become literals."""
    rows = scaler.orderBy("position").collect()
    scaled = {
        r["feature"] + suffix: (F.col(r["feature"]).cast("double") - F.lit(r["mean"])) / F.lit(r["scale"]) for r in rows
    }
    return df.withColumns(scaled)


def time_split(
    df: DataFrame, ratio: float = 0.8, exact: bool = False, order: Sequence[str] = ("store_id", "sku")
) -> tuple[DataFrame, DataFrame]:
    """(earlier, later) part, cut where ``ratio`` of the rows have passed in date order.

    The cut is found from row counts per date. By default a date is never split:
    the cut date goes to the later part. With ``exact`` the cut date's rows are
    divided in the given order so that the first part has exactly the wanted size.
    """
    per_date = df.groupBy("date").agg(F.count(F.lit(1)).alias("n")).orderBy("date").collect()
    wanted = int(sum(r["n"] for r in per_date) * ratio)
    seen, cut = 0, None
    for r in per_date:
        if seen + r["n"] > wanted:
            cut = r["date"]
            break
        seen += r["n"]
    if cut is None:
        return df, df.where(F.lit(False))
    before, after = df.where(F.col("date") < F.lit(cut)), df.where(F.col("date") >= F.lit(cut))
    if not exact or seen == wanted:
        return before, after
    day = ranked(df.where(F.col("date") == F.lit(cut)), list(order), "_position")
    first, rest = day.where(F.col("_position") < wanted - seen), day.where(F.col("_position") >= wanted - seen)
    later = df.where(F.col("date") > F.lit(cut))
    return before.unionByName(first.drop("_position")), later.unionByName(rest.drop("_position"))


@dataclass
class DemandModel:
    """A fitted regression with the dictionary, the scaling and the input order it was trained with."""

    kind: str
    encoder: DataFrame
    scaler: DataFrame
    inputs: list[str]
    regression: Model | BoostedTrees


SCALED = "__scaled"


def assemble(df: DataFrame, scaler: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Add the model's ``features`` vector: the inputs, scaled, in the order of training."""
    df = scale(df, scaler, suffix=SCALED)
    vector = VectorAssembler(inputCols=[name + SCALED for name in inputs], outputCol="features", handleInvalid="error")
    return vector.transform(df).drop(*[name + SCALED for name in inputs])


def train_regression(
    train: DataFrame, valid: DataFrame, kind: str = "tweedie", label: str = "qty", **options: float
) -> Model | BoostedTrees:
    """Fit on frames with a ``features`` vector.

    ``tweedie`` is a generalised linear model with the Tweedie loss and a log
    link. ``gbt`` are trees boosted with that loss (by default up to 1000 at rate
    0.05, of about 32 leaves), cut at the round with the least loss on ``valid``
    once 50 more rounds have not lowered it; ``options`` go to ``boosting.boost``.
    """
    if kind == "tweedie":
        return GeneralizedLinearRegression(
            family="tweedie", variancePower=1.5, linkPower=0.0, regParam=0.01, maxIter=25, labelCol=label
        ).fit(train)
    if kind == "gbt":
        return boost(train, valid, label, **options)
    raise ValueError("kind must be 'tweedie' or 'gbt'")


def score(model: DemandModel, df: DataFrame, encoded: bool = False) -> DataFrame:
    """Add ``prediction``, never below zero. Set ``encoded`` if the codes are already there."""
    if not encoded:
        df = encode(df, model.encoder)
    out = model.regression.transform(assemble(df, model.scaler, model.inputs))
    codes = [code_name(name) for name in TEXT_COLUMNS]
    return out.withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0))).drop("features", *codes)


REGRESSIONS = {"tweedie": GeneralizedLinearRegressionModel, "gbt": BoostedTrees}


def save_model(model: DemandModel, path: str) -> str:
    """Write dictionary, scaling and regression as a new version below ``path``; returns the version's folder.

    A version counts once its last folder, ``ready``, is there, so a reader beside
    a save, or after one that broke off, gets the version before it. Versions are
    never changed; old ones may be deleted.
    """
    folder = f"{path}/version={time.time_ns():020d}-{uuid.uuid4().hex}"
    model.encoder.write.parquet(f"{folder}/encoder")
    scaler = model.scaler.withColumn("kind", F.lit(model.kind)).coalesce(1)
    scaler.write.parquet(f"{folder}/scaler")
    model.regression.save(f"{folder}/regression")
    scaler.select("kind").limit(1).write.parquet(f"{folder}/ready")
    return folder


def newest_version(spark: SparkSession, path: str) -> str:
    """The folder of the last version below ``path`` that was saved completely."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.listStatus(hadoop.Path(path)) if files.exists(hadoop.Path(path)) else []
    names = sorted((s.getPath().getName() for s in found if s.getPath().getName().startswith("version=")), reverse=True)
    for name in names:
        if files.exists(hadoop.Path(f"{path}/{name}/ready/_SUCCESS")):
            return f"{path}/{name}"
    raise FileNotFoundError(f"{path} has no complete model")


def load_model(spark: SparkSession, path: str) -> DemandModel:
    """The last complete version below ``path``, or the version whose folder ``path`` is."""
    folder = path if "/version=" in path else newest_version(spark, path)
    scaler = spark.read.parquet(f"{folder}/scaler")
    rows = scaler.orderBy("position").collect()
    kind = rows[0]["kind"]
    return DemandModel(
        kind=kind,
        encoder=spark.read.parquet(f"{folder}/encoder"),
        scaler=scaler.drop("kind"),
        inputs=[r["feature"] for r in rows],
        regression=REGRESSIONS[kind].load(f"{folder}/regression"),
    )
