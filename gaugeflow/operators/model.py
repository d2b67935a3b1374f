"""Logistic regression: train, save, load, score."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S
from gaugeflow.functions import sql


@dataclass(frozen=True)
class Training:
    """Training parameters. More partitions want a deeper aggregation tree."""

    max_iter: int = 100
    reg_param: float = 0.02
    elastic_net: float = 0.8
    aggregation_depth: int = 2


def fit(train: DataFrame, training: Training = Training()) -> LogisticRegressionModel:
    """Train on columns `label` and `features`.

    Spark turns the input into blocks and keeps those, so the input itself
    should not be cached as well.
    """
    return LogisticRegression(
        family="binomial",
        maxIter=training.max_iter,
        regParam=training.reg_param,
        elasticNetParam=training.elastic_net,
        aggregationDepth=training.aggregation_depth,
    ).fit(train)


def save(model: LogisticRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


@dataclass(frozen=True)
class LinearScore:
    """A trained model as a column expression over flat features.

    It needs no vector and stays within generated code; `model.transform` does
    neither. Both give the same predictions.
    """

    coefficients: tuple[float, ...]
    intercept: float
    threshold: float = 0.5
    features: tuple[str, ...] = tuple(S.FEATURES)

    @classmethod
    def of(cls, model: LogisticRegressionModel, features: Sequence[str] = S.FEATURES):
        return cls(
            tuple(float(c) for c in model.coefficients),
            float(model.intercept),
            float(model.getThreshold()),
            tuple(features),
        )

    @classmethod
    def load(cls, path: str, features: Sequence[str] = S.FEATURES):
        return cls.of(load(path), features)

    def margin(self) -> str:
        """Intercept and weighted features, added from left to right. SQL text."""
        weighted = zip(self.coefficients, self.features, strict=True)
        terms = [f"{sql.double(c)} * {sql.name(feature)}" for c, feature in weighted]
        return " + ".join([sql.double(self.intercept), *terms])

    def score(self, flat: DataFrame) -> DataFrame:
        """Add `margin`, `probability` of label 1, and `prediction`."""
        with_margin = flat.selectExpr("*", sql.named(self.margin(), "margin"))
        with_probability = with_margin.selectExpr("*", "1D / (1D + exp(-margin)) AS probability")
        predicted = f"if(probability > {sql.double(self.threshold)}, 1D, 0D)"
        return with_probability.selectExpr("*", sql.named(predicted, "prediction"))


def coefficient_table(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """One row per feature, and one for the intercept."""
    values = [*zip(S.FEATURES, map(float, model.coefficients)), ("intercept", model.intercept)]
    schema = T.StructType(
        [
            T.StructField("feature", T.StringType(), False),
            T.StructField("coefficient", T.DoubleType(), False),
        ]
    )
    return spark.createDataFrame(values, schema)


def parity(
    rows: DataFrame, model: LogisticRegressionModel, reloaded: LogisticRegressionModel
) -> DataFrame:
    """Rows scored by both models, and how many of them came out differently.

    Both scores are put on the same row, so nothing is shuffled to compare them.
    """
    second = reloaded.copy()
    second.setPredictionCol("reloadPrediction")
    second.setProbabilityCol("reloadProbability")
    second.setRawPredictionCol("reloadRawPrediction")
    both = second.transform(model.transform(rows))
    same = (F.col("prediction") == F.col("reloadPrediction")) & (
        F.col("probability") == F.col("reloadProbability")
    )
    return both.agg(
        F.count("*").alias("n_scored"), F.count_if(~same).alias("n_differing")
    )


def optimality(
    train: DataFrame,
    coefficients: Sequence[float],
    intercept: float,
    training: Training = Training(),
    features: Sequence[str] = S.FEATURES,
    tolerance: float = 1e-3,
) -> DataFrame:
    """Whether a model is the one that training asks for, feature by feature.

    The loss of the elastic net has one minimum, at which the slope of the mean loss along each
    standardised feature is held by the penalty: it equals the penalty's slope where the
    coefficient is not zero, and is no steeper than the absolute penalty where it is. A row tells
    the slope, by how much it is `off`, and whether that is within the tolerance; one more
    row is for the intercept, which has no penalty. `loss` is that of the whole model, with penalty.

    `train` has `label` and the features as columns and is read once. A constant feature must
    have a coefficient of zero. Without rows nothing is optimal.
    """
    linear = LinearScore(tuple(coefficients), intercept, features=tuple(features))
    scored = train.selectExpr("label", *map(sql.name, features), sql.named(linear.margin(), "margin"))
    gap = 1 / (1 + F.exp(-F.col("margin"))) - F.col("label")
    # log(1 + exp(-m)) without overflow, with the sign of the label.
    signed = F.when(F.col("label") == 1, F.col("margin")).otherwise(-F.col("margin"))
    loss = F.log1p(F.exp(-F.abs("margin"))) + F.greatest(-signed, F.lit(0.0))
    sums = scored.select("*", gap.alias("gap"), loss.alias("own_loss")).agg(
        F.avg("gap").alias("g"),
        F.avg("own_loss").alias("mean_loss"),
        *[F.avg(F.col("gap") * F.col(name)).alias(f"g{j}") for j, name in enumerate(features)],
        *[F.stddev_samp(name).alias(f"s{j}") for j, name in enumerate(features)],
    )
    absolute = training.reg_param * training.elastic_net
    square = training.reg_param * (1 - training.elastic_net)
    rows, penalty = [], F.lit(0.0)
    for j, (name, value) in enumerate(zip(features, coefficients, strict=True)):
        spread, weight = F.col(f"s{j}"), F.lit(float(value)) * F.col(f"s{j}")
        slope = F.when(spread > 0, F.col(f"g{j}") / spread + square * weight).otherwise(0.0)
        if value == 0:
            off = F.greatest(F.abs(slope) - absolute, F.lit(0.0))
        else:
            off = F.abs(slope + absolute * (1 if value > 0 else -1))
        penalty = penalty + absolute * F.abs(weight) + square / 2 * weight * weight
        rows.append((name, float(value), slope, off))
    rows.append(("intercept", float(intercept), F.col("g"), F.abs("g")))
    members = [
        F.struct(
            F.lit(name).alias("feature"),
            F.lit(value).alias("coefficient"),
            F.lit(0 if value == 0 else 1 if value > 0 else -1).alias("sign"),
            slope.alias("slope"),
            off.alias("off"),
            F.coalesce(off <= tolerance, F.lit(False)).alias("optimal"),
        )
        for name, value, slope, off in rows
    ]
    told = sums.select(F.explode(F.array(*members)).alias("r"), (F.col("mean_loss") + penalty).alias("loss"))
    return told.select("r.*", "loss")
