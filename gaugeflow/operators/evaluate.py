"""How good predictions are: area under the ROC curve, in three ways."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow import session


def evaluator_auc(predictions: DataFrame, score: str = "rawPrediction", bins: int = 0) -> float:
    """Spark's evaluator. Exact without bins; bins make it faster and slightly inexact."""
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    ).evaluate(predictions)


def confusion(predictions: DataFrame) -> DataFrame:
    """One row of counts by label and prediction, in one pass."""
    hit, miss = F.col("prediction") == 1.0, F.col("prediction") == 0.0
    return predictions.agg(
        F.count_if((F.col("label") == 1) & hit).alias("tp"),
        F.count_if((F.col("label") == 1) & miss).alias("fn"),
        F.count_if((F.col("label") == 0) & hit).alias("fp"),
        F.count_if((F.col("label") == 0) & miss).alias("tn"),
    )


def hard_label_auc(predictions: DataFrame) -> DataFrame:
    """Area under the curve of predictions taken as scores: (TPR + TNR) / 2.

    Null if one of the labels does not occur.
    """
    recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    selectivity = F.try_divide(F.col("tn"), F.col("tn") + F.col("fp"))
    return confusion(predictions).withColumn("auc", (recall + selectivity) / 2.0)


def score_auc(scored: DataFrame, score: str, buckets: int | None = None) -> DataFrame:
    """Exact area under the curve of a score, ties counted half; one row.

    Rows whose score is null or NaN are left out, as they have no rank. With rows of
    one label only the area is null.

    Rows are first added up by score, which tames frequent scores. The distinct
    scores are then dealt out by ranges, so the running sum is taken range by
    range in parallel. Any number of ranges gives the same result.
    """
    known = scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    by_score = known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("ones"),
        F.count_if(F.col("label") == 0).alias("zeros"),
    )
    by_score = session.stage(by_score, "auc-scores")
    dealt = by_score.repartitionByRange(*([buckets] if buckets else []), "score")
    ranged = session.stage(dealt.withColumn("range", F.spark_partition_id()), "auc-ranges")


    # At most one row per range from here, whatever the size of the input.
    totals = ranged.groupBy("range").agg(
        F.sum("ones").alias("range_ones"), F.sum("zeros").alias("range_zeros")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range", F.coalesce(F.sum("range_zeros").over(before), F.lit(0)).alias("zeros_before")
    )

    within = (
        Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    zeros_below = F.col("zeros_before") + F.coalesce(F.sum("zeros").over(within), F.lit(0))
    # Pairs are counted twice to keep halves whole; decimals hold what a long cannot.
    twice_won = F.col("ones").cast("decimal(18,0)") * (
        2 * zeros_below + F.col("zeros")
    ).cast("decimal(19,0)")
    won = ranged.join(F.broadcast(offsets), "range").select("ones", "zeros", twice_won.alias("w"))
    summed = won.agg(
        F.sum("ones").alias("n_ones"), F.sum("zeros").alias("n_zeros"), F.sum("w").alias("w")
    )
    pairs = F.col("n_ones").cast("double") * F.col("n_zeros").cast("double")
    area = F.try_divide(F.col("w").cast("double"), 2.0 * pairs)
    return summed.select("n_ones", "n_zeros", area.alias("auc"))

