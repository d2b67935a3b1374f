from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow import session
from gaugeflow.operators import decode, evaluate, features
from gaugeflow.operators import model as models
from gaugeflow.plans import event_records as er
from gaugeflow.plans import jobs


@pytest.fixture(scope="module")
def labelled(spark, sf_dir, config):
    rows = er.event_records(er.events(spark, sf_dir), config, noise=True, coded=True)
    return decode.rename_label(rows).select("event_id", "label", *S.FEATURES).persist()


@pytest.fixture(scope="module")
def assembled(labelled):
    return features.assemble(labelled)


@pytest.fixture(scope="module")
def model(assembled):
    return models.fit(assembled)


def _brute_force(x, y, reg, ratio, steps=20_000):
    """Elastic net logistic regression by proximal gradient on standardised features."""
    std = x.std(axis=0, ddof=1)
    z = (x - x.mean(axis=0)) / std
    n, k = z.shape
    rate = 1.0 / (0.25 * np.linalg.eigvalsh(z.T @ z / n).max() + 0.25 + reg)
    w, b = np.zeros(k), 0.0
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        off = 1 / (1 + np.exp(-(z @ v + c))) - y
        step = v - rate * (z.T @ off / n + reg * (1 - ratio) * v)
        new_w = np.sign(step) * np.maximum(np.abs(step) - rate * reg * ratio, 0)
        new_b = c - rate * off.mean()
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v = new_w + (t - 1) / new_t * (new_w - w)
        c = new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return w / std, b - (w / std) @ x.mean(axis=0)


def test_training_equals_brute_force(assembled, model):
    rows = assembled.select("label", vector_to_array("features").alias("v")).collect()
    x = np.array([r.v for r in rows])
    y = np.array([r.label for r in rows], dtype=float)
    w, b = _brute_force(x, y, 0.02, 0.8)
    assert np.allclose(model.coefficients.toArray(), w, atol=5e-3)
    assert abs(model.intercept - b) < 2e-2
    margin = x @ model.coefficients.toArray() + model.intercept
    assert np.abs(margin - (x @ w + b)).max() < 2e-2


def test_expression_and_model_predict_alike(labelled, assembled, model):
    by_expression = models.LinearScore.of(model).score(labelled)
    by_model = model.transform(assembled).select(
        "event_id",
        F.col("prediction").alias("p"),
        F.get(vector_to_array("probability"), 1).alias("q"),
    )
    both = by_expression.join(by_model, "event_id")
    worst = both.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("prediction") != F.col("p")).alias("off"),
        F.max(F.abs(F.col("probability") - F.col("q"))).alias("far"),
    ).first()
    assert worst.n == labelled.count() and worst.off == 0 and worst.far < 1e-12


def test_a_saved_model_is_the_same_model(spark, assembled, model, tmp_path):
    path = str(tmp_path / "model")
    models.save(model, path)
    models.save(model, path)
    row = models.parity(assembled, model, models.load(path)).first()
    assert (row.n_scored, row.n_differing) == (assembled.count(), 0)
    assert models.LinearScore.load(path) == models.LinearScore.of(model)


def test_parity_sees_another_model(assembled, model):
    other = models.fit(assembled, models.Training(max_iter=1))
    row = models.parity(assembled, model, other).first()
    assert row.n_differing > 0


def test_coefficient_table(spark, model):
    rows = {r.feature: r.coefficient for r in models.coefficient_table(spark, model).collect()}
    assert list(rows) == [*S.FEATURES, "intercept"]
    assert rows["intercept"] == model.intercept and rows["cat4"] == model.coefficients[4]


def _scored(spark, pairs, partitions=3):
    rows = spark.createDataFrame(pairs, "label int, score double").repartition(partitions)
    return rows.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


def _pairs_auc(pairs):
    ones = [s for label, s in pairs if label == 1]
    zeros = [s for label, s in pairs if label == 0]
    won = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    return won / (len(ones) * len(zeros))


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
@pytest.mark.parametrize("levels", [1, 3, 200])
def test_score_area_equals_all_pairs(spark, levels, buckets):
    random.seed(levels)
    pairs = [(int(random.random() < 0.4), random.randrange(levels) / levels) for _ in range(300)]
    row = evaluate.score_auc(_scored(spark, pairs), "score", buckets).first()
    assert row.n_ones + row.n_zeros == 300
    assert row.auc == pytest.approx(_pairs_auc(pairs), abs=1e-12)


def test_one_score_may_hold_most_rows(spark):
    pairs = [(i % 2, 0.25) for i in range(2000)] + [(1, 0.9), (0, 0.1), (0, 0.25)]
    row = evaluate.score_auc(_scored(spark, pairs), "score").first()
    assert row.auc == pytest.approx(_pairs_auc(pairs), abs=1e-12)


def test_areas_without_one_of_the_labels(spark):
    for pairs in ([(1, 0.2), (1, 0.9)], [(0, 0.2)]):
        scored = _scored(spark, pairs)
        assert evaluate.score_auc(scored, "score").first().auc is None
        assert evaluate.hard_label_auc(scored).first().auc is None


def test_areas_agree_with_the_evaluator(spark, labelled, model, assembled):
    scored = models.LinearScore.of(model).score(labelled)
    by_model = model.transform(assembled)
    hard = evaluate.hard_label_auc(scored).first()
    assert hard.tp + hard.fn + hard.fp + hard.tn == labelled.count()
    assert hard.auc == pytest.approx(evaluate.evaluator_auc(by_model, "prediction"), abs=1e-9)
    exact = evaluate.score_auc(scored, "probability").first().auc
    assert exact == pytest.approx(evaluate.evaluator_auc(by_model, bins=0), abs=1e-9)


def test_random_split_covers_and_is_disjoint(spark):
    rows = spark.range(0, 4000, 1, 5)
    train, test = features.random_split(rows)
    assert train.intersect(test).count() == 0
    assert train.union(test).exceptAll(rows).count() == 0
    assert train.count() + test.count() == 4000
    assert 0.75 < train.count() / 4000 < 0.85


def test_split_part_does_not_depend_on_the_layout(spark):
    part = features.split_part(F.col("id")).alias("part")
    few = spark.range(0, 8000, 1, 2).select("id", part)
    many = spark.range(0, 8000, 1, 7).select("id", part)
    assert few.exceptAll(many).count() == 0
    share = few.where("part = 'train'").count() / 8000
    assert abs(share - 0.8) < 0.02
    other = spark.range(8000).select("id", features.split_part(F.col("id"), seed=1).alias("part"))
    assert few.exceptAll(other).count() > 1000


def test_training_job_from_messages(spark, sf_dir, config, tmp_path):
    messages = er.damage(er.event_messages(er.events(spark, sf_dir), config, noise=True))
    trained = jobs.train(jobs.prepare(messages, config), str(tmp_path / "model"))
    assert 0.9 < trained.metrics["auc_of_predictions"] <= 1
    assert 0.95 < trained.metrics["auc_of_scores"] <= 1
    usable = decode.accepted(decode.decode_messages(messages, config)).count()
    assert trained.train.count() + trained.test.count() == usable
    assert models.load(str(tmp_path / "model")).coefficients == trained.model.coefficients


def test_training_reads_its_part_only(spark, sf_dir, config, plan_of):
    prepared = jobs.prepare(er.event_messages(er.events(spark, sf_dir), config), config)
    staged = session.stage(prepared, "test", "part")
    plan = plan_of(staged.where("part = 'train'").select("label", "cat0"))
    assert "PartitionFilters: [isnotnull(part" in plan.replace("\n", " ")
    assert "ReadSchema: struct<label:int,cat0:int>" in plan


def test_area_leaves_out_rows_without_a_score(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (0, None), (1, float("nan")), (0, 0.9)]
    for buckets in (None, 1, 3, 40):
        row = evaluate.score_auc(_scored(spark, rows), "score", buckets).first()
        assert (row.n_ones, row.n_zeros, row.auc) == (1, 2, 0.75)
    assert evaluate.score_auc(_scored(spark, [(1, None), (0, None)]), "score").first().auc is None


def test_publishing_adds_to_what_is_there(spark, tmp_path):
    path = str(tmp_path / "topics")
    for topic in ("a", "b", "a"):
        rows = spark.range(30).selectExpr(f"'{topic}' AS topic", "'k' AS key", "CAST(id AS STRING) AS value")
        jobs.publish(rows, "parquet", path)
    there = spark.read.parquet(path)
    assert there.count() == 90
    assert there.select("topic", "partition", "offset").distinct().count() == 90


def _told(rows, coefficients, intercept):
    return {r.feature: r for r in models.optimality(rows, coefficients, intercept).collect()}


def test_a_trained_model_is_optimal_and_others_are_not(labelled, model):
    coefficients = [float(c) for c in model.coefficients]
    told = _told(labelled, coefficients, float(model.intercept))
    assert len(told) == 19 and all(r.optimal for r in told.values())
    assert {n: r.sign for n, r in told.items() if n != "intercept"} == {
        n: int(np.sign(c)) for n, c in zip(S.FEATURES, coefficients, strict=True)
    }
    changed = [c + 0.2 if i == 0 else c for i, c in enumerate(coefficients)]
    moved = _told(labelled, changed, float(model.intercept))
    assert not moved["cat0"].optimal and moved["cat0"].loss > told["cat0"].loss
    assert not _told(labelled, coefficients, float(model.intercept) + 0.1)["intercept"].optimal
    absent = next(i for i, c in enumerate(coefficients) if c == 0)
    added = [c + 0.5 if i == absent else c for i, c in enumerate(coefficients)]
    assert not _told(labelled, added, float(model.intercept))[S.FEATURES[absent]].optimal
    dropped = _told(labelled, [0.0] * 18, float(model.intercept))
    assert not dropped["cat0"].optimal


def test_optimality_of_odd_tables(spark, labelled):
    constant = labelled.withColumn("sensor0", F.lit(5.0))
    assert _told(constant, [0.0] * 18, 0.0)["sensor0"].optimal
    assert not any(r.optimal for n, r in _told(labelled.limit(0), [0.0] * 18, 0.0).items() if n == "intercept")


def test_training_parameters_matter_to_optimality(assembled, labelled):
    other = models.Training(reg_param=0.1, elastic_net=0.3)
    fitted = models.fit(assembled, other)
    given = [float(c) for c in fitted.coefficients], float(fitted.intercept)
    assert all(r.optimal for r in models.optimality(labelled, *given, training=other).collect())
    assert not all(r.optimal for r in models.optimality(labelled, *given).collect())
